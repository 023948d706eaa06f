"""Text scalars: entity decoding, normalisation, headline cleaning, predicates."""

from __future__ import annotations

import html.entities
import re
from functools import cache, reduce
from zlib import crc32

from pyspark.sql import Column, functions as F

from broadsheet.config import FIELD_SEPARATOR, QUOTE_CHARS, SITE_SUFFIXES

# Unicode whitespace plus the four ASCII separators that Python also counts.
WHITESPACE = r"(?U)[\s\x1C-\x1F]+"

ENTITY = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _legacy_names() -> list[str]:
    """Entity names that HTML also accepts without a semicolon, longest first."""
    return sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)


def _c1_replacements() -> dict[int, str]:
    """Numeric references in 128..159 mean Windows-1252 characters in HTML."""
    table = {}
    for code in range(0x80, 0xA0):
        try:
            table[code] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            table[code] = chr(code)
    table[0x00] = "�"
    table[0x0D] = "\r"
    return table


def _literal(value: str) -> str:
    """A Python string as a SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _lookup(entries: dict, key: str) -> str:
    """SQL for the value of a key in a constant table, null when missing.

    The table is an array of cells by checksum, folded to a literal: one look-up reads one cell.
    """
    size = len(entries)
    cells: list[list[str]] = [[] for _ in range(size)]
    for k, v in entries.items():
        cells[crc32(str(k).encode()) % size].append(f"{k}\x02{v}")
    table = f"split({_literal('\x03'.join('\x01'.join(c) for c in cells))}, '\x03', -1)"
    cell = f"element_at({table}, int(crc32({key}) % {size}) + 1)"
    return f"try_element_at(str_to_map({cell}, '\x01', '\x02'), {key})"


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


@cache
def _unescape_lambda() -> str:
    """The decoder as a SQL lambda over a text: one expression however often it is used.

    Number references follow HTML's rules for unusable code points. Names are looked
    up whole, or else by the longest legacy name they start with.
    """
    character = f"""CASE
        WHEN code IS NULL OR code > {0x10FFFF} OR code BETWEEN {0xD800} AND {0xDFFF} THEN '\uFFFD'
        WHEN code BETWEEN {0x80} AND {0x9F} OR code IN (0, 13) THEN {_lookup(_c1_replacements(), "string(code)")}
        WHEN code BETWEEN 1 AND 8 OR code = 11 OR code BETWEEN 14 AND 31 OR code = 127
          OR code BETWEEN {0xFDD0} AND {0xFDEF} OR (code & {0xFFFE}) = {0xFFFE} THEN ''
        ELSE decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32') END"""

    def number(digits: str, base: int) -> str:
        # more than eight significant digits cannot be a code point
        value = f"bigint(conv(concat('0', significant), {base}, 10))"
        body = f"CASE WHEN length(significant) <= 8 THEN {value} END"
        return _let("significant", f"regexp_replace({digits}, '^0+', '')", body)

    hexadecimal = "regexp_extract(ref, '^#[xX]([0-9a-fA-F]+)', 1)"
    decimal = "regexp_extract(ref, '^#([0-9]+)', 1)"
    code = f"CASE WHEN ref RLIKE '^#[xX]' THEN {number(hexadecimal, 16)} ELSE {number(decimal, 10)} END"
    prefix = f"regexp_extract(ref, '^(?:{'|'.join(_legacy_names())})', 0)"
    named = f"concat({_lookup(html.entities.html5, 'head')}, substring(ref, length(head) + 1))"
    one = f"""CASE WHEN startswith(ref, '#') THEN {_let("code", code, character)}
        ELSE coalesce({_let("head", f"CASE WHEN endswith(ref, ';') THEN ref ELSE {prefix} END", named)},
                      {_let("head", prefix, named)}, concat('&', ref)) END"""
    # one more piece than references: pair each piece with what follows it
    joined = f"""array_join(zip_with(split(t, {_literal(ENTITY)}, -1),
        transform(regexp_extract_all(t, {_literal(ENTITY)}, 1), ref -> {one}),
        (piece, character) -> concat(piece, coalesce(character, ''))), '')"""
    return f"t -> CASE WHEN contains(t, '&') THEN {joined} ELSE t END"


def unescape_entities(text: Column) -> Column:
    """Decode HTML character references, once. Text without ``&`` passes through."""
    return F.element_at(F.call_function("transform", F.array(text), F.expr(_unescape_lambda())), 1)


def squeeze(text: Column) -> Column:
    """Every whitespace run to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only spaces, from both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def normalise(text: Column) -> Column:
    """Entities decoded, whitespace squeezed."""
    return squeeze(unescape_entities(text))


def strip_site_suffixes(text: Column, suffixes=SITE_SUFFIXES) -> Column:
    """Remove trailing site names: each rule once, in order, any case."""

    def strip_one(value: Column, suffix: str) -> Column:
        separator, site = suffix.split(" ", 1)
        pattern = rf"(?iu)\s*{re.escape(separator)}\s*{re.escape(site)}\s*$"
        return F.trim(F.regexp_replace(value, pattern, ""))

    return reduce(strip_one, suffixes, text)


def clean_headline(text: Column, suffixes=SITE_SUFFIXES) -> Column:
    """Normalise, drop site suffixes, drop wrapping quotes. Not idempotent."""
    return F.btrim(strip_site_suffixes(normalise(text), suffixes), F.lit(QUOTE_CHARS))


def comparison_key(text: Column) -> Column:
    """Case- and spacing-free form used to compare two extractions."""
    return squeeze(F.lower(text))


def dedup_key(text: Column) -> Column:
    """Key of keep-first deduplication."""
    return F.lower(F.trim(text))


def has_alphanumeric(text: Column) -> Column:
    """True when any character is a letter or a number."""
    return text.rlike(r"[\p{L}\p{N}]")


def fields_text(headline: Column, url_text: Column, mode: str) -> Column:
    """The text a model sees: headline, URL words, or both joined by a marker."""
    if mode == "headline_only":
        return headline
    if mode == "url_only":
        return url_text
    if mode == "headline_plus_url":
        return F.concat(headline, F.lit(FIELD_SEPARATOR), url_text)
    raise ValueError(f"unknown text representation: {mode}")
