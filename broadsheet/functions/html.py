"""Headline extraction from stored pages, as Column expressions.

One pass of a pattern over the page lists its ``<meta>`` and ``<h1>`` elements and
steps over comments, scripts and styles, so nothing inside those is mistaken for
markup. Everything after that works on the short list, never on the page again.
Possessive quantifiers keep the matching linear on hostile pages.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from broadsheet.config import META_TITLE_SELECTORS, SITE_RULES, SITE_SUFFIXES
from broadsheet.functions.binding import let
from broadsheet.functions.text import clean_headline, unescape_entities

_QUOTED_OR_BARE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
_TAG_BODY = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""

# An element is listed without its opening angle bracket: with that bracket in front
# of the whole pattern, text between tags is skipped at the speed of a character search.
ELEMENTS = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(?:script|style)\b.*?(?:</(?:script|style)\s*+>|\z)"
    rf"|(meta\b{_TAG_BODY}>|h1\b{_TAG_BODY}>.*?(?:</h1\s*+>|\z)))"
)
INNER_MARKUP = rf"(?is)<!--.*?-->|</?[a-z!?]{_TAG_BODY}>"


def _up_to(tag: str, attribute: str) -> str:
    """Pattern from the tag's start to the value of an attribute, walking whole attributes."""
    name = re.escape(attribute)
    skip = rf"(?:[\s/]++(?!(?i:{name})[\s=])[^\s=/>]++(?:\s*+=\s*+{_QUOTED_OR_BARE})?+)*+"
    return rf"(?s)^(?i:{tag}){skip}[\s/]++(?i:{name})\s*+=\s*+"


def attribute_value(element: Column, tag: str, attribute: str) -> Column:
    """Raw value of an attribute of the element's own tag; empty when absent."""
    quoted = F.regexp_extract(element, _up_to(tag, attribute) + f"({_QUOTED_OR_BARE})", 1)
    return F.regexp_replace(quoted, r"""^["']|["']$""", "")


def _has_value(element: Column, tag: str, attribute: str, value: str) -> Column:
    literal = re.escape(value)
    return element.rlike(
        _up_to(tag, attribute) + rf"""(?:"{literal}"|'{literal}'|{literal}(?=[\s/>]))"""
    )


def inner_text(element: Column) -> Column:
    """Raw text of an ``<h1>`` element, its tags turned into spaces."""
    body = F.regexp_replace(element, rf"(?is)^h1\b{_TAG_BODY}>|</h1\s*+>$", "")
    return F.regexp_replace(body, INNER_MARKUP, " ")


def _is(tag: str):
    return lambda element: element.rlike(rf"(?i)^{tag}\b")


def _h1_match(element: Column, kind: str, attribute: str, value: str) -> Column:
    if kind == "any":
        return F.lit(True)
    if kind == "equals":
        return _has_value(element, "h1", attribute, value)
    found = attribute_value(element, "h1", attribute)
    if kind == "token":
        return F.array_contains(F.split(found, r"\s+"), value)
    if kind == "matches":
        return found.rlike(rf"(?iu){value}")
    raise ValueError(f"unknown selector kind: {kind}")


def extract_headline(
    page: Column,
    source: Column,
    rules=SITE_RULES,
    meta_selectors=META_TITLE_SELECTORS,
    suffixes=SITE_SUFFIXES,
) -> Column:
    """Headline of a page: meta titles, then the site's own node, then the first h1."""

    def first(elements: Column, tag: str, condition) -> Column:
        return F.get(F.filter(elements, lambda e: _is(tag)(e) & condition(e)), F.lit(0))

    def meta(elements: Column, attribute: str, value: str) -> Column:
        hit = first(elements, "meta", lambda e: _has_value(e, "meta", attribute, value))
        return F.struct(F.lit(True).alias("meta"), attribute_value(hit, "meta", "content").alias("raw"))

    def h1(elements: Column, kind: str, attribute: str, value: str, when: Column) -> Column:
        hit = first(elements, "h1", lambda e: when & _h1_match(e, kind, attribute, value))
        return F.struct(F.lit(False).alias("meta"), inner_text(hit).alias("raw"))

    def clean(candidate: Column) -> Column:
        """Null passes the turn on: an empty meta title does, a blank node does, but
        a visible node that cleans to nothing does not."""
        return let(
            unescape_entities(candidate["raw"]),
            lambda text: F.when(text.rlike(r"(?U)[^\s\x1C-\x1F]"), clean_headline(text, suffixes)),
        )

    def accept(candidate: Column) -> Column:
        return let(clean(candidate), lambda text: F.when(~candidate["meta"] | (text != ""), text))

    def choose(elements: Column) -> Column:
        candidates = [meta(elements, a, v) for a, v in meta_selectors]
        for rule in rules:
            candidates += [h1(elements, *s, source == rule.source) for s in rule.h1_selectors]
        candidates.append(h1(elements, "any", "", "", F.lit(True)))
        accepted = F.transform(F.array(*candidates), accept)
        return F.coalesce(F.get(F.filter(accepted, lambda t: t.isNotNull()), F.lit(0)), F.lit(""))

    return let(F.regexp_extract_all(page, F.lit(ELEMENTS), F.lit(1)), choose)


def mirror_title(body: Column, suffixes=SITE_SUFFIXES) -> Column:
    """Headline of a text rendering of a page, from its ``Title:`` line."""
    return clean_headline(F.regexp_extract(body, r"(?mdU)^Title:\s*(.+?)\n", 1), suffixes)


def page_title(page: Column) -> Column:
    """Content of ``<title>``: an independent second reading of a page."""
    return unescape_entities(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title", 1))
