"""The three cleaning jobs. They apply the same filters in different orders, and
the order decides which row survives, so each keeps its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.config import CleaningOptions, SITE_RULES, SITE_SUFFIXES
from broadsheet.functions.binding import computed
from broadsheet.functions.labels import resolve_label
from broadsheet.functions.text import clean_headline, dedup_key, has_alphanumeric, normalise, strip
from broadsheet.functions.urls import url_key, url_words
from broadsheet.operators.dedup import keep_first, keep_first_or_blank, text_digest
from broadsheet.sources.readers import with_roles

FUNNEL_STEPS = (
    "not_success",
    "no_label",
    "empty_headline",
    "short_headline",
    "symbol_only_headline",
    "duplicate_urls",
    "duplicate_headlines",
)


def drop_reason(
    success: Column, label: Column, headline: Column, min_chars: int = 8, drop_symbol_only: bool = True
) -> Column:
    """Name of the first row filter that rejects a row; null when it passes all."""
    reason = (
        F.when(~success, F.lit("not_success"))
        .when(label.isNull(), F.lit("no_label"))
        .when(headline == "", F.lit("empty_headline"))
    )
    if min_chars > 0:
        reason = reason.when(F.length(headline) < min_chars, F.lit("short_headline"))
    if drop_symbol_only:
        reason = reason.when(~has_alphanumeric(headline), F.lit("symbol_only_headline"))
    return reason


def _marked(raw: DataFrame, min_chars: int, drop_symbol_only: bool, suffixes) -> DataFrame:
    """Raw rows with their final headline, trimmed URL and drop reason."""
    prepared = computed(
        raw.withColumnsRenamed({"headline": "__headline", "url": "__url"}),
        clean_headline(F.coalesce("__headline", F.lit("")), suffixes).alias("headline"),
        strip(F.coalesce("__url", F.lit(""))).alias("url"),
    ).drop("__headline", "__url")
    success = F.coalesce("success", F.lit(False))
    reason = drop_reason(success, F.col("label"), F.col("headline"), min_chars, drop_symbol_only)
    return computed(prepared, reason.alias("reason"))


def clean_resolved(
    raw: DataFrame,
    order: tuple[str, ...] = ("url", "ord"),
    *,
    min_chars: int = 8,
    drop_symbol_only: bool = True,
    dedup_urls: bool = True,
    dedup_headlines: bool = True,
    suffixes=SITE_SUFFIXES,
) -> DataFrame:
    """Clean corpus of resolved pages: row filters, then URL, then headline dedup."""
    out = _marked(raw, min_chars, drop_symbol_only, suffixes).filter(F.col("reason").isNull()).drop("reason")
    if dedup_urls:
        out = keep_first(out, url_key(F.col("url")), *order)
    if dedup_headlines:
        out = keep_first(out, text_digest(dedup_key(F.col("headline"))), *order)
    return out


def removal_funnel(
    raw: DataFrame,
    order: tuple[str, ...] = ("url", "ord"),
    *,
    min_chars: int = 8,
    drop_symbol_only: bool = True,
    dedup_urls: bool = True,
    dedup_headlines: bool = True,
    suffixes=SITE_SUFFIXES,
) -> DataFrame:
    """Rows removed at each step of ``clean_resolved``, as one row of counts.

    Counting needs no surviving rows, only how many share each key. Rows are
    folded by URL, then by the headline of each URL's first row, then into one
    row; every step combines before its shuffle, and a rejected row is folded
    under its reason at once.
    """
    marked = _marked(raw, min_chars, drop_symbol_only, suffixes)
    row_key = F.concat_ws("|", *[F.col(c).cast("string") for c in order])
    passed = F.col("reason").isNull()
    by_url = (
        marked.select(
            "reason",
            F.when(passed, url_key(F.col("url")) if dedup_urls else row_key).alias("url_key"),
            F.when(passed, F.sha2(dedup_key(F.col("headline")), 256) if dedup_headlines else row_key).alias("h_key"),
            F.struct(*order).alias("position"),
        )
        .groupBy("reason", "url_key")
        .agg(F.count(F.lit(1)).alias("rows"), F.min_by("h_key", "position").alias("h_key"))
    )
    by_headline = by_url.groupBy("reason", "h_key").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("urls")
    )

    def removed(reason: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("reason") == reason, F.col("rows"))), F.lit(0)).cast("bigint")

    kept = F.col("reason").isNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(kept, value)), F.lit(0)).cast("bigint")

    counts = [F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("input_rows")]
    counts += [removed(r).alias(f"removed_{r}") for r in FUNNEL_STEPS[:5]]
    counts += [
        (total(F.col("rows")) - total(F.col("urls"))).alias("removed_duplicate_urls"),
        (total(F.col("urls")) - total(F.lit(1))).alias("removed_duplicate_headlines"),
        total(F.lit(1)).alias("clean_rows"),
    ]
    return by_headline.agg(*counts)


def prepare_dataset(df: DataFrame, order: str, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Labelled samples ``(ord, url, text, label)`` of a table with any role columns.

    URLs are deduplicated before the label and text filters: a URL whose first row
    is rejected later also suppresses its good rows. Headlines are deduplicated
    among accepted rows only. Rows without a URL are never URL duplicates.
    """
    roles = with_roles(df, order, options.require_text_column, options.roles)
    text = normalise(F.col("raw_text"))
    if options.allow_url_fallback:
        chosen = F.coalesce(
            F.nullif(F.col("text"), F.lit("")), F.when(F.col("url") != "", normalise(url_words(F.col("url"))))
        )
    else:
        chosen = F.nullif(F.col("text"), F.lit(""))
    # a row without text, and without a URL to stand in, is skipped unseen
    rows = computed(computed(roles, text.alias("text")), chosen.alias("chosen")).filter(F.col("chosen").isNotNull())
    rows = rows.select("ord", "url", "raw_label", F.col("chosen").alias("text"))
    if options.remove_duplicate_urls:
        rows = keep_first_or_blank(rows, url_key(F.col("url")), F.col("ord"), "ord")
    label = resolve_label(F.col("raw_label"), F.col("url"), options.site_rules, options.label_synonyms)
    rows = computed(rows, label.alias("label")).drop("raw_label")
    keep = F.col("label").isNotNull() & (F.col("text") != "")
    if options.min_headline_chars > 0:
        keep = keep & (F.length("text") >= options.min_headline_chars)
    if options.drop_symbol_only:
        keep = keep & has_alphanumeric(F.col("text"))
    rows = rows.filter(keep)
    if options.remove_duplicate_headlines:
        rows = keep_first(rows, text_digest(dedup_key(F.col("text"))), "ord")
    return rows.select("ord", "url", "text", "label")


def prepare_data(df: DataFrame, order: str, site_rules=SITE_RULES) -> DataFrame:
    """Evaluation samples: nothing cleaned, URLs stand in for missing text."""
    return prepare_dataset(df, order, CleaningOptions(site_rules=site_rules))


def clean_frame(df: DataFrame, strict: bool, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Experiment cleaning of ``(ord, url, headline, label)``.

    Loose keeps every row with a headline. Strict adds the length and symbol
    filters and both dedups; rows with a blank URL count as one URL.
    """
    out = computed(
        df.withColumnsRenamed({"headline": "__headline", "url": "__url", "label": "__label"}),
        normalise(F.coalesce("__headline", F.lit(""))).alias("headline"),
        strip(F.coalesce("__url", F.lit(""))).alias("url"),
        F.col("__label").cast("int").alias("label"),
    ).filter(F.col("headline") != "")
    out = out.select(*df.columns)
    if not strict:
        return out
    out = out.filter((F.length("headline") >= 8) & has_alphanumeric(F.col("headline")))
    out = keep_first(out, url_key(F.col("url")), *order)
    return keep_first(out, text_digest(dedup_key(F.col("headline"))), *order)


__all__ = [
    "FUNNEL_STEPS",
    "SITE_RULES",
    "clean_frame",
    "clean_resolved",
    "drop_reason",
    "prepare_data",
    "prepare_dataset",
    "removal_funnel",
]
