"""URL scalars, built on the RFC 3986 component pattern.

The built-in URL parser is strict: it raises or yields null for URLs with spaces,
pipes or stray percent signs, which crawled lists contain. A pattern accepts all.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from broadsheet.config import SITE_RULES, UNKNOWN_SOURCE
from broadsheet.functions.binding import let
from broadsheet.functions.text import clean_headline, squeeze, unescape_entities

SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"
AUTHORITY = SCHEME + r"//([^/?#]*)"
PATH = SCHEME + r"(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"
SEGMENT_PARAMS = r";[^/]*$"


def authority(url: Column) -> Column:
    """Lower-cased host with user info and port; empty without ``//``."""
    return F.lower(F.regexp_extract(url, AUTHORITY, 1))


def path(url: Column) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, PATH, 1), SEGMENT_PARAMS, "")


def query(url: Column) -> Column:
    return F.regexp_extract(url, QUERY, 1)


def url_key(url: Column) -> Column:
    """Key of URL deduplication."""
    return F.lower(F.trim(url))


def _by_host(url: Column, rules, value, default: Column) -> Column:
    def choose(host: Column) -> Column:
        chain = F.when(host.contains(rules[0].domain), value(rules[0]))
        for rule in rules[1:]:
            chain = chain.when(host.contains(rule.domain), value(rule))
        return chain.otherwise(default)

    return let(authority(url), choose)


def label_from_host(url: Column, rules=SITE_RULES) -> Column:
    """Label of the first rule whose domain occurs in the host, else null."""
    return _by_host(url, rules, lambda r: F.lit(r.label), F.lit(None).cast("int"))


def source_from_host(url: Column, rules=SITE_RULES) -> Column:
    """Site name of the first rule whose domain occurs in the host."""
    return _by_host(url, rules, lambda r: F.lit(r.source), F.lit(UNKNOWN_SOURCE))


def percent_decode(text: Column) -> Column:
    """Decode ``%XX``; plus signs and malformed escapes stay as they are."""
    guarded = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(guarded)


def url_words(url: Column) -> Column:
    """The whole path read as text."""
    decoded = percent_decode(path(url))
    without_markers = F.regexp_replace(F.regexp_replace(decoded, r"\.print", " "), r"\.html", " ")
    return squeeze(unescape_entities(F.translate(without_markers, "/-_", "   ")))


def slug_headline(url: Column) -> Column:
    """The last path segment read as a headline, without percent-decoding."""
    segment = F.element_at(F.split(F.btrim(path(url), F.lit("/")), "/"), -1)
    bare = F.regexp_replace(F.regexp_replace(segment, r"(?i)\.print$", ""), r"(?i)\.html$", "")
    return clean_headline(F.translate(bare, "-_", "  "))


def url_variants(url: Column, rules=SITE_RULES) -> Column:
    """Ordered, distinct spellings of a URL under which its page may be stored."""

    def spell(host: Column, route: Column, q: Column) -> Column:
        rooted = F.when((route == "") | route.startswith("/"), route).otherwise(F.concat(F.lit("/"), route))
        suffix = F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))
        return F.concat(F.lit("https://"), host, rooted, suffix)

    def variants(parts: Column) -> Column:
        raw, host, route, q = parts["raw"], parts["host"], parts["route"], parts["q"]
        none = F.lit("")
        shortened = F.regexp_replace(route, r"\.print$", "")
        bare = F.regexp_replace(route, "/+$", "")
        is_print = route.endswith(".print")
        closed = (route != "/") & route.endswith("/")
        is_open = (route != "/") & ~route.endswith("/")
        spelled = F.array(
            raw,
            spell(host, route, q),
            spell(host, route, none),
            F.when(is_print, spell(host, shortened, q)),
            F.when(is_print, spell(host, shortened, none)),
            F.when(closed, spell(host, bare, q)),
            F.when(closed, spell(host, bare, none)),
            F.when(is_open, spell(host, F.concat(route, F.lit("/")), q)),
        )
        trimmed = F.transform(spelled, lambda v: F.trim(v))
        return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))

    trimmed_url = F.trim(url)
    host = authority(trimmed_url)
    canonical_host = F.when(
        host.isin(*[r.domain for r in rules]), F.concat(F.lit("www."), host)
    ).otherwise(host)
    route = path(trimmed_url)
    parts = F.struct(
        trimmed_url.alias("raw"),
        canonical_host.alias("host"),
        F.when(route == "", F.lit("/")).otherwise(route).alias("route"),
        query(trimmed_url).alias("q"),
    )
    return let(parts, variants)
