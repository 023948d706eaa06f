"""Word tokens, n-grams and in-row term counts."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from broadsheet.functions.binding import let

TOKEN = r"[\p{L}\p{N}_]{2,}"

# Hangul syllables decompose by rule: lead, vowel and, unless the number is 0, tail.
_SYLLABLES, _VOWELS, _TAILS = 0xAC00, 21, 28
_SYLLABLE_END = _SYLLABLES + 19 * _VOWELS * _TAILS


def _folded(character: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", character) if not unicodedata.combining(c))


@cache
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Single-character folds as two parallel strings, marks to delete, and expansions."""
    source, target, deleted, expanded = [], [], [], {}
    for code in (*range(0x80, _SYLLABLES), *range(_SYLLABLE_END, 0xD800), *range(0xE000, 0x110000)):
        c = chr(code)
        f = _folded(c)
        if f == c:
            continue
        if len(f) == 1:
            source.append(c)
            target.append(f)
        elif not f:
            deleted.append(c)
        elif any(x.isalnum() or x == "_" for x in c + f):  # others end a word either way
            expanded[c] = f
    return "".join(source + deleted), "".join(target), expanded


@cache
def special_class() -> str:
    """A character class of few ranges that holds every character whose fold is not one word
    character for another: characters that vanish, become several, or begin or end a word.

    Beyond the accents of Latin the ranges span gaps of up to ``_GAP`` plain characters.
    """
    source, target, expanded = fold_tables()

    def in_word(c: str) -> bool:
        return c == "_" or unicodedata.category(c)[0] in "LN"

    special = set(map(ord, expanded)) | set(map(ord, source[len(target) :])) | set(range(_SYLLABLES, _SYLLABLE_END))
    special |= {ord(a) for a, b in zip(source, target) if in_word(a) != in_word(b)}
    ranges: list[list[int]] = []
    for code in sorted(special):
        if ranges and code - ranges[-1][1] <= (_GAP if ranges[-1][1] >= _COMBINING else 1):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    listed = "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in ranges)
    # the first half rejects ASCII at once
    return f"[\\x{{{ranges[0][0]:x}}}-\\x{{10ffff}}&&[{listed}]]"


_COMBINING, _GAP = 0x300, 128


def _plain(value: Column) -> Column:
    """As many bytes as characters: ASCII, nothing to fold."""
    return F.octet_length(value) == F.length(value)


def _fold_each(value: Column) -> Column:
    """Folds by one or no character each."""
    source, target, _ = fold_tables()
    return F.translate(value, source, target)


def _fold_walked(value: Column) -> Column:
    """Folds of all kinds, character by character."""
    expanded = fold_tables()[2]
    first, last = chr(_SYLLABLES), chr(_SYLLABLE_END - 1)
    listed, folds = F.lit("".join(expanded)), F.split(F.lit("\x1f".join(expanded.values())), "\x1f")

    def jamo(start: int, number: Column) -> Column:
        return F.substr(F.lit("".join(map(chr, range(start, start + _TAILS)))), number.cast("int"), F.lit(1))

    def expand(c: Column) -> Column:
        n = F.ascii(c) - _SYLLABLES
        tail = F.when(n % _TAILS > 0, jamo(0x11A8, n % _TAILS)).otherwise("")
        syllable = F.concat(
            jamo(0x1100, F.floor(n / (_VOWELS * _TAILS)) + 1), jamo(0x1161, F.floor(n / _TAILS) % _VOWELS + 1), tail
        )
        place = F.position(c, listed)
        return F.when(_plain(c), c).when((c >= first) & (c <= last), syllable).when(place > 0, F.get(folds, place - 1)).otherwise(c)

    return F.array_join(F.transform(F.split(_fold_each(value), ""), expand), "")


def fold_accents(text: Column) -> Column:
    """Letters without their accents, compatibility forms made plain, over all of Unicode.

    Most characters fold to one or none, by a translation. Texts that may hold one that becomes
    several are walked character by character.
    """

    def fold(value: Column) -> Column:
        return F.when(_plain(value), value).when(value.rlike(special_class()), _fold_walked(value)).otherwise(_fold_each(value))

    return let(text, fold)


def tokens(text: Column, strip_accents: bool = True) -> Column:
    """Lower-cased words of two or more word characters, by default without accents.

    Texts without a character of ``special_class`` have their words cut first: only words with
    accents are folded, each by a translation.
    """
    lowered = F.lower(text)

    def words(value: Column) -> Column:
        return F.regexp_extract_all(value, F.lit(TOKEN), F.lit(0))

    if not strip_accents:
        return words(lowered)

    def cut(value: Column) -> Column:
        return F.when(~_plain(value) & value.rlike(special_class()), _fold_walked(value)).otherwise(value)

    return F.transform(words(let(lowered, cut)), lambda w: F.when(_plain(w), w).otherwise(_fold_each(w)))


def ngrams(words: Column, longest: int = 2) -> Column:
    """All runs of one to ``longest`` words, joined by a space."""

    def joined(array: Column, n: int) -> Column:
        # reads words by position: slicing would copy the whole array each time
        def one(i: Column) -> Column:
            return F.concat_ws(" ", *[F.get(array, i + k) for k in range(n)])

        starts = F.sequence(F.lit(0), F.size(array) - n)
        return F.when(F.size(array) >= n, F.transform(starts, one)).otherwise(F.array().cast("array<string>"))

    def runs(array: Column) -> Column:
        return F.concat(array, *[joined(array, n) for n in range(2, longest + 1)])

    return words if longest == 1 else let(words, runs)


def term_counts(terms: Column) -> Column:
    """``ARRAY<STRUCT<term, tf>>``: occurrences of each term, counted inside the row.

    Sorting puts equal terms side by side, so the distance between the starts of two
    runs is a count. Counting here keeps document text and n-grams out of shuffles.
    """

    def count_runs(ordered: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )

        def pair(begin: Column) -> Column:
            ends = F.concat(F.slice(begin, F.lit(2), F.size(begin)), F.array(F.size(ordered)))
            return F.zip_with(
                begin, ends, lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).alias("tf"))
            )

        return F.when(F.size(ordered) > 0, let(starts, pair)).otherwise(
            F.array().cast("array<struct<term:string,tf:int>>")
        )

    return let(F.sort_array(terms), count_runs)
