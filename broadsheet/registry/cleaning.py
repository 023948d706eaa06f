"""Filters, keep-first deduplication and the cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.config import CleaningOptions
from broadsheet.functions.text import dedup_key, has_alphanumeric, normalise
from broadsheet.functions.urls import url_key
from broadsheet.operators.dedup import keep_first, text_digest
from broadsheet.plans import cleaning
from broadsheet.registry import sql
from broadsheet.registry.base import RULES, experiment_corpus, mixed_corpus, query, resolved_pages, table, with_repeats

_LETTERS = r"[\p{L}\p{N}]"


@query("filter_short", sql=f"SELECT doc_id FROM documents WHERE length({sql.normalise('text')}) >= 8")
def filter_short(spark, sf):
    return table(spark, sf, "documents").filter(F.length(normalise(F.col("text"))) >= 8).select("doc_id")


@query(
    "filter_symbol_only",
    sql=rf"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
SELECT doc_id, count(*) FILTER (WHERE regexp_matches(word, '{_LETTERS}')) AS kept, count(*) FILTER (WHERE NOT regexp_matches(word, '{_LETTERS}')) AS dropped
FROM w GROUP BY 1""",
)
def filter_symbol_only(spark, sf):
    """No given text is symbols only, but words within them are: every word is judged."""
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    keep = has_alphanumeric(F.col("word"))
    return words.groupBy("doc_id").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))


@query(
    "dedup_url",
    sql=f"WITH {sql.RESOLVED}, {sql.REPEATED} SELECT ord, url, label FROM {sql.first_of('repeated', 'lower(url)', 'ord')}",
)
def dedup_url(spark, sf):
    rows = with_repeats(resolved_pages(spark, sf).select("ord", "url", "label"))
    return keep_first(rows, url_key(F.col("url")), "ord")


@query(
    "dedup_headline",
    sql=f"WITH {sql.RESOLVED} SELECT ord, headline, label FROM {sql.first_of('resolved', 'lower(headline)', 'ord')}",
)
def dedup_headline(spark, sf):
    return keep_first(resolved_pages(spark, sf).select("ord", "headline", "label"), dedup_key(F.col("headline")), "ord")


@query(
    "dedup_text",
    sql=f"SELECT doc_id, n_chars FROM {sql.first_of('documents', 'lower(trim(text))', 'doc_id')}",
)
def dedup_text(spark, sf):
    """Long texts are compared by digest."""
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", text_digest(dedup_key(F.col("text"))).alias("key"))
    return keep_first(rows, F.col("key"), "doc_id").drop("key")


@query(
    "clean_pages",
    sql=f"""WITH {sql.RESOLVED}, source_rows AS (SELECT * FROM resolved), {sql.MARKED}, {sql.CLEANED}
SELECT ord AS page_id, url, source, label, h AS headline FROM cleaned""",
)
def clean_pages(spark, sf):
    clean = cleaning.clean_resolved(resolved_pages(spark, sf))
    return clean.select(F.col("ord").alias("page_id"), "url", "source", "label", "headline")


_FUNNEL = "\n".join(
    f"(SELECT count(*) FROM marked WHERE reason = '{r}') AS removed_{r}," for r in cleaning.FUNNEL_STEPS[:5]
)


@query(
    "clean_funnel",
    sql=f"""WITH {sql.RESOLVED}, {sql.REPEATED}, source_rows AS (SELECT * FROM repeated), {sql.MARKED}, {sql.CLEANED}
SELECT (SELECT count(*) FROM marked) AS input_rows, {_FUNNEL}
  (SELECT count(*) FROM marked WHERE reason IS NULL) - (SELECT count(*) FROM by_url) AS removed_duplicate_urls,
  (SELECT count(*) FROM by_url) - (SELECT count(*) FROM cleaned) AS removed_duplicate_headlines,
  (SELECT count(*) FROM cleaned) AS clean_rows""",
)
def clean_funnel(spark, sf):
    return cleaning.removal_funnel(with_repeats(resolved_pages(spark, sf)))


def _prepared_sql(strict: bool) -> str:
    words = f"CASE WHEN link <> '' THEN {sql.url_words('link')} END"
    text = "nullif(t, '')" if strict else f"coalesce(nullif(t, ''), {words})"
    label = f"coalesce(CASE label WHEN '0' THEN 0 WHEN '1' THEN 1 END, {sql.label('link')})"
    rows = f"(SELECT *, {text} AS text FROM (SELECT *, {sql.normalise('title')} AS t FROM mixed))"
    eligible = f"(SELECT * FROM {rows} WHERE text IS NOT NULL)"
    if strict:
        eligible = sql.first_of(eligible, "CASE WHEN link = '' THEN 'row ' || ord ELSE lower(link) END", "ord")
    accepted = f"(SELECT * FROM (SELECT ord, text, {label} AS label FROM {eligible}) WHERE label IS NOT NULL AND text <> ''"
    accepted += f" AND length(text) >= 8 AND regexp_matches(text, '{_LETTERS}'))" if strict else ")"
    if strict:
        accepted = sql.first_of(accepted, "lower(trim(text))", "ord")
    return f"WITH {sql.MIXED} SELECT ord, text, label FROM {accepted}"


@query("prepare_dataset", sql=_prepared_sql(True))
def prepare_dataset(spark, sf):
    options = CleaningOptions.strict(site_rules=RULES)
    return cleaning.prepare_dataset(mixed_corpus(spark, sf), "ord", options).select("ord", "text", "label")


@query("prepare_dataset_default", sql=_prepared_sql(False))
def prepare_dataset_default(spark, sf):
    return cleaning.prepare_data(mixed_corpus(spark, sf), "ord", RULES).select("ord", "text", "label")


@query("clean_loose", sql=f"WITH {sql.EXPERIMENT} SELECT ord, url, headline, label FROM {sql.loose('experiment')}")
def clean_loose(spark, sf):
    return cleaning.clean_frame(experiment_corpus(spark, sf), strict=False)


@query("clean_strict", sql=f"WITH {sql.EXPERIMENT} SELECT ord, url, headline, label FROM {sql.strict('experiment')}")
def clean_strict(spark, sf):
    return cleaning.clean_frame(experiment_corpus(spark, sf), strict=True)
