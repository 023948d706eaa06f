"""Rules and options. Everything site-specific is data, so callers can swap it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- fixed values: column-role candidates, label spellings, sites, suffixes ---
LABEL_COLUMNS = ("label", "labels", "source", "outlet", "news_source", "publisher")
TEXT_COLUMNS = ("headline", "title", "text", "content", "news_title")
URL_COLUMNS = ("url", "link", "article_url")
# text fields of a record, in the order in which they are tried
TEXT_FIELDS = ("headline", "title", "text", "content")

LABEL_SYNONYMS = {
    0: ("0", "fox", "foxnews", "fox news"),
    1: ("1", "nbc", "nbcnews", "nbc news"),
}

META_TITLE_SELECTORS = (
    ("property", "og:title"),
    ("name", "twitter:title"),
    ("name", "headline"),
    ("itemprop", "headline"),
)

SITE_SUFFIXES = (
    "| Fox News",
    "- Fox News",
    "| NBC News",
    "- NBC News",
    "| NBC News Select",
)

QUOTE_CHARS = "\"'“”‘’ "

RETRYABLE_STATUS = (403, 406, 408, 409, 425, 429, 500, 502, 503, 504)

METHOD_DIRECT = "direct_html"
METHOD_VARIANT = "direct_html_variant"
METHOD_ARCHIVE = "wayback_html"
METHOD_MIRROR = "jina_mirror"
METHOD_SLUG = "url_slug_fallback"
METHOD_NONE = "none"

UNKNOWN_SOURCE = "Unknown"
FIELD_SEPARATOR = " [SEP] "
CONFLICT_SUFFIX = "#label_conflict_"
# --- end of fixed values ---


@dataclass(frozen=True)
class SiteRule:
    """One site: the domain that identifies it and where its headline lives.

    ``h1_selectors`` is an ordered list of ``(kind, attribute, value)`` with kind
    ``matches`` (case-insensitive search in the attribute), ``token`` (one of the
    space-separated values), ``equals``, or ``any``.
    """

    domain: str
    source: str
    label: int
    h1_selectors: tuple[tuple[str, str, str], ...] = ()


# The two sites, their labels and their headline nodes.
SITE_RULES = (
    SiteRule("foxnews.com", "FoxNews", 0, (("matches", "class", "headline"),)),
    SiteRule(
        "nbcnews.com",
        "NBC",
        1,
        (
            ("token", "class", "article-hero-headline__htag"),
            ("equals", "data-testid", "headline"),
            ("any", "", ""),
        ),
    ),
)


@dataclass(frozen=True)
class RoleNames:
    """Candidate columns of each role, in the order in which they are tried, in lower case."""

    text: tuple[str, ...] = TEXT_COLUMNS
    label: tuple[str, ...] = LABEL_COLUMNS
    url: tuple[str, ...] = URL_COLUMNS


@dataclass(frozen=True)
class CleaningOptions:
    """Switches of the labelled-corpus preparation; the defaults clean nothing."""

    allow_url_fallback: bool = True
    require_text_column: bool = False
    remove_duplicate_urls: bool = False
    remove_duplicate_headlines: bool = False
    min_headline_chars: int = 0
    drop_symbol_only: bool = False
    site_rules: tuple[SiteRule, ...] = field(default=SITE_RULES)
    roles: RoleNames = field(default=RoleNames())
    # spellings of each class id; the label of a site is the id of its rule
    label_synonyms: Mapping[int, tuple[str, ...]] = field(default_factory=lambda: LABEL_SYNONYMS)

    @classmethod
    def strict(cls, **changes) -> "CleaningOptions":
        """The training-time setting: every filter and both dedups on."""
        base = dict(
            allow_url_fallback=False,
            require_text_column=True,
            remove_duplicate_urls=True,
            remove_duplicate_headlines=True,
            min_headline_chars=8,
            drop_symbol_only=True,
        )
        base.update(changes)
        return cls(**base)
