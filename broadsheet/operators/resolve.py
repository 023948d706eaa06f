"""Headline resolution: stored captures of a URL, tried in a fixed order of trust.

A capture is one fetch of a URL (``sources.schemas.CAPTURES``): stage 1 is the page
itself (variant 0) or another spelling of its URL, stage 2 an archived copy, stage
3 a text rendering. The first acceptable capture gives the headline; when there is
none, the words of the URL's last path segment may stand in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.config import (
    METHOD_ARCHIVE,
    METHOD_DIRECT,
    METHOD_MIRROR,
    METHOD_NONE,
    METHOD_SLUG,
    METHOD_VARIANT,
    RETRYABLE_STATUS,
    SITE_RULES,
    SITE_SUFFIXES,
)
from broadsheet.functions.binding import computed
from broadsheet.functions.html import extract_headline, mirror_title
from broadsheet.functions.urls import label_from_host, slug_headline, source_from_host, url_variants
from broadsheet.sources.schemas import RESOLVED

DIRECT, ARCHIVE, MIRROR = 1, 2, 3

# How each stage words its failures.
HTTP_ERROR = {DIRECT: "HTTP ", ARCHIVE: "Wayback HTTP ", MIRROR: "Jina HTTP "}
EMPTY_ERROR = {
    DIRECT: "Empty headline after parsing",
    ARCHIVE: "Wayback empty headline",
    MIRROR: "Jina empty title",
}
CONTENT_TYPE_ERROR = "Unexpected content type: "


def should_retry(status_code: Column) -> Column:
    """True for statuses worth another fetch."""
    return F.coalesce(status_code.isin(*RETRYABLE_STATUS), F.lit(False))


def per_stage(stage: Column, values: dict[int, str]) -> Column:
    chain = None
    for key, value in values.items():
        chain = F.when(stage == key, F.lit(value)) if chain is None else chain.when(stage == key, F.lit(value))
    return chain


def judge_captures(captures: DataFrame, rules=SITE_RULES, suffixes=SITE_SUFFIXES) -> DataFrame:
    """Headline or failure reason of every capture; the page body goes no further."""
    stage, status = F.col("stage"), F.col("status_code")
    content_type = F.coalesce("content_type", F.lit(""))
    wrong_type = (stage == DIRECT) & ~content_type.contains("text/html")
    headline = (
        F.when(F.coalesce(status != 200, F.lit(True)) | wrong_type, F.lit(""))
        .when(stage == MIRROR, mirror_title(F.col("body"), suffixes))
        .otherwise(extract_headline(F.coalesce("body", F.lit("")), F.col("source"), rules, suffixes=suffixes))
    )
    failure = (
        F.when(status.isNull(), F.coalesce("error", F.lit("")))
        .when(status != 200, F.concat(per_stage(stage, HTTP_ERROR), status.cast("string")))
        .when(wrong_type, F.concat(F.lit(CONTENT_TYPE_ERROR), content_type))
        .otherwise(per_stage(stage, EMPTY_ERROR))
    )
    fetched_at = F.col("fetched_at") if "fetched_at" in captures.columns else F.lit(None).cast("timestamp")
    elapsed_ms = F.col("elapsed_ms") if "elapsed_ms" in captures.columns else F.lit(None).cast("bigint")
    sourced = computed(captures, source_from_host(F.col("url"), rules).alias("source"))
    judged = computed(sourced, headline.alias("headline"))
    return judged.select(
        "url",
        F.struct("stage", "variant", "attempt").alias("turn"),
        "status_code",
        "final_url",
        fetched_at.alias("fetched_at"),
        elapsed_ms.alias("elapsed_ms"),
        "headline",
        F.when(F.col("headline") == "", failure).otherwise(F.lit("")).alias("error"),
    )


def resolve(
    urls: DataFrame,
    captures: DataFrame,
    *,
    allow_url_fallback: bool = False,
    use_archive: bool = True,
    use_mirror: bool = True,
    rules=SITE_RULES,
    suffixes=SITE_SUFFIXES,
) -> DataFrame:
    """One row per distinct listed URL: the ``RESOLVED`` columns and ``listed``.

    ``listed`` is how often the list names the URL; ``expand_listed`` turns it back
    into rows. Both sides are folded to one row per URL before they meet, so a URL
    with a third of all captures, or of all listings, costs its task one row from
    each upstream task.
    """
    stages = [DIRECT] + [ARCHIVE] * use_archive + [MIRROR] * use_mirror
    judged = judge_captures(captures.filter(F.col("stage").isin(*stages)), rules, suffixes)
    turn, accepted = F.col("turn"), F.col("headline") != ""
    win = F.struct("headline", "status_code", "final_url", F.col("turn"))

    def last(value: str) -> Column:
        """Value of the latest turn that has one."""
        present = F.col(value).isNotNull()
        if value != "status_code":
            present = present & (F.col(value) != "")
        return F.max_by(F.when(present, F.col(value)), F.when(present, turn))

    folded = judged.groupBy("url").agg(
        F.min_by(F.when(accepted, win), F.when(accepted, turn)).alias("win"),
        last("status_code").alias("last_status"),
        last("error").alias("last_error"),
        last("final_url").alias("last_final"),
        F.min("fetched_at").alias("fetched_at_utc"),
        F.sum("elapsed_ms").alias("elapsed_ms"),
    )
    listed = urls.groupBy("url").agg(F.count(F.lit(1)).alias("listed"))
    joined = listed.join(folded, "url", "left")
    slug = slug_headline(F.col("url")) if allow_url_fallback else F.lit("")
    stage = F.col("win.turn.stage")
    method = (
        F.when((stage == DIRECT) & (F.col("win.turn.variant") == 0), F.lit(METHOD_DIRECT))
        .when(stage == DIRECT, F.lit(METHOD_VARIANT))
        .when(stage == ARCHIVE, F.lit(METHOD_ARCHIVE))
        .when(stage == MIRROR, F.lit(METHOD_MIRROR))
        .when(F.col("slug") != "", F.lit(METHOD_SLUG))
        .otherwise(F.lit(METHOD_NONE))
    )
    won = F.col("win").isNotNull()
    last_final = F.coalesce("last_final", "url")
    out = computed(joined, F.when(F.col("win").isNull(), slug).alias("slug")).select(
        "url",
        source_from_host(F.col("url"), rules).alias("source"),
        label_from_host(F.col("url"), rules).alias("label"),
        (won | (F.col("slug") != "")).alias("success"),
        F.coalesce("win.headline", "slug", F.lit("")).alias("headline"),
        F.when(won, F.col("win.status_code")).otherwise(F.col("last_status")).alias("status_code"),
        F.when(won, F.lit("")).otherwise(F.coalesce("last_error", F.lit(""))).alias("error"),
        F.when(won, F.coalesce("win.final_url", "url")).otherwise(last_final).alias("final_url"),
        "elapsed_ms",
        "fetched_at_utc",
        method.alias("headline_method"),
        "listed",
    )
    return out.select(*RESOLVED.names, "listed")


def expand_listed(resolved: DataFrame, chunk: int = 10_000) -> DataFrame:
    """One row per listing. Heavy URLs are cut into chunks that spread over tasks."""
    chunks = F.ceil(F.col("listed") / F.lit(chunk)).cast("bigint")
    cut = resolved.withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), chunks)))
    size = F.least(F.lit(chunk).cast("bigint"), F.col("listed") - (F.col("chunk") - 1) * chunk)
    spread = cut.withColumn("size", size).repartition("url", "chunk")
    return spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "size"))).drop(
        "listed", "chunk", "size", "copy"
    )


def resolve_single(pages: DataFrame, *, allow_url_fallback: bool = False, rules=SITE_RULES, suffixes=SITE_SUFFIXES) -> DataFrame:
    """Resolution of a page table that already holds one accepted capture per URL.

    Nothing has to meet, so this is a projection: no shuffle at all. Keeps the
    identifying columns of the input, drops the page itself.
    """
    url, html = F.col("url"), F.coalesce("html", F.lit(""))
    others = [c for c in pages.columns if c not in ("url", "html")]
    sourced = computed(pages, source_from_host(url, rules).alias("source"))
    found = computed(sourced, extract_headline(html, F.col("source"), rules, suffixes=suffixes).alias("extracted"))
    slug = slug_headline(url) if allow_url_fallback else F.lit("")
    slugged = computed(found, F.when(F.col("extracted") == "", slug).otherwise(F.lit("")).alias("slug"))
    headline = F.when(F.col("extracted") != "", F.col("extracted")).otherwise(F.col("slug"))
    return slugged.select(
        *others,
        "url",
        "source",
        label_from_host(url, rules).alias("label"),
        (headline != "").alias("success"),
        headline.alias("headline"),
        F.when(F.col("extracted") != "", F.lit(METHOD_DIRECT))
        .when(F.col("slug") != "", F.lit(METHOD_SLUG))
        .otherwise(F.lit(METHOD_NONE))
        .alias("headline_method"),
    )


def capture_requests(urls: DataFrame, rules=SITE_RULES) -> DataFrame:
    """``(url, variant, request_url)``: the spellings to fetch for each listed URL."""
    return urls.select("url", F.posexplode(url_variants(F.col("url"), rules)).alias("variant", "request_url"))
