"""Profiles, audits and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.operators import metrics as M, profile as P
from broadsheet.plans import experiments
from broadsheet.plans.cleaning import clean_resolved
from broadsheet.registry import sql
from broadsheet.registry.base import RULES, labelled_predictions, query, resolved_pages, table, with_repeats

_SLUGGED = f"""slugged AS (
  SELECT page_id, url, {sql.label('url')} AS label, h, s, CASE WHEN h <> '' THEN h ELSE s END AS headline,
         CASE WHEN h <> '' THEN 'direct_html' WHEN s <> '' THEN 'url_slug_fallback' END AS headline_method
  FROM (SELECT page_id, url, CASE WHEN contains(url, '?') THEN '' ELSE {sql.clean(sql.entities(sql.h1('html')))} END AS h,
               CASE WHEN contains(url, 'page') THEN '' ELSE {sql.slug('url')} END AS s FROM pages))"""


def _partly_resolved(spark, sf):
    """Pages with a query lose their content, some of those also their slug."""
    from broadsheet.operators.resolve import resolve_single

    pages = table(spark, sf, "pages").withColumn(
        "html", F.when(F.col("url").contains("?"), F.lit("")).otherwise(F.col("html"))
    )
    out = resolve_single(pages, allow_url_fallback=True, rules=RULES)
    lost = F.col("url").contains("page") & (F.col("headline_method") == "url_slug_fallback")
    return out.withColumn("success", F.col("success") & ~lost).withColumn(
        "headline_method", F.when(~lost, F.col("headline_method"))
    )


@query("method_counts", sql=f"WITH {_SLUGGED} SELECT headline_method, count(*) AS count FROM slugged GROUP BY 1")
def method_counts(spark, sf):
    return P.value_counts(_partly_resolved(spark, sf), "headline_method")


@query(
    "fetch_totals",
    sql=f"""WITH {_SLUGGED} SELECT count(*) AS raw_total, count(headline_method) AS raw_success,
            count(*) - count(headline_method) AS raw_fail FROM slugged""",
)
def fetch_totals(spark, sf):
    return P.fetch_totals(_partly_resolved(spark, sf))


_RAW_AND_CLEAN = f"""{sql.RESOLVED}, {sql.REPEATED}, source_rows AS (SELECT * FROM repeated), {sql.MARKED}, {sql.CLEANED}"""


def _raw_and_clean(spark, sf):
    raw = with_repeats(resolved_pages(spark, sf))
    return raw, clean_resolved(raw)


@query(
    "dataset_profile",
    sql=f"""WITH {_RAW_AND_CLEAN}, c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE h = '') AS empty, count(*) FILTER (WHERE label IS NULL) AS unlabelled,
         count(*) - count(DISTINCT (h, label)) AS dup,
         count(*) FILTER (WHERE label IS DISTINCT FROM {sql.label('url')}) AS mismatch FROM cleaned)
SELECT 2 * (SELECT count(*) FROM pages) AS input_url_rows, count(*) AS raw_rows, count(*) FILTER (WHERE success) AS raw_success,
  count(*) FILTER (WHERE NOT success) AS raw_fail, any_value(n) AS clean_rows, count(*) - any_value(n) AS removed_from_raw_to_clean,
  count(*) FILTER (WHERE success AND label IS NOT NULL AND headline <> '') AS valid_rows_before_dedup, any_value(n) AS rows_after_dedup,
  count(*) FILTER (WHERE success AND label IS NOT NULL AND headline <> '') - any_value(n) AS removed_duplicates_headline_label,
  any_value(empty) AS clean_empty_headline, any_value(unlabelled) AS clean_missing_label, any_value(dup) AS clean_dup_headline_label,
  any_value(mismatch) AS source_label_mismatch_clean
FROM repeated, c""",
)
def dataset_profile(spark, sf):
    raw, clean = _raw_and_clean(spark, sf)
    urls = with_repeats(table(spark, sf, "pages").select(F.col("page_id").alias("ord"), "url"))
    return P.dataset_profile(urls, raw, clean, RULES)


@query(
    "dataset_profile_counts",
    sql=f"""WITH {_RAW_AND_CLEAN}
SELECT 'raw_label_counts' AS name, CAST(label AS VARCHAR) AS key, count(*) AS count FROM repeated GROUP BY 2
UNION ALL SELECT 'clean_label_counts', CAST(label AS VARCHAR), count(*) FROM cleaned GROUP BY 2
UNION ALL SELECT 'raw_source_counts', source, count(*) FROM repeated GROUP BY 2
UNION ALL SELECT 'clean_source_counts', source, count(*) FROM cleaned GROUP BY 2
UNION ALL SELECT 'headline_method_counts_raw', headline_method, count(*) FROM repeated GROUP BY 2""",
)
def dataset_profile_counts(spark, sf):
    return P.profile_counts(*_raw_and_clean(spark, sf))


@query(
    "class_distribution",
    sql=f"""WITH {_RAW_AND_CLEAN}
SELECT dataset, source || '(' || coalesce(CAST(label AS VARCHAR), '') || ')' AS class, count(*) AS count
FROM (SELECT 'raw' AS dataset, source, label FROM repeated UNION ALL SELECT 'clean', source, label FROM cleaned) GROUP BY 1, 2""",
)
def class_distribution(spark, sf):
    return P.class_distribution(*_raw_and_clean(spark, sf))


@query(
    "source_counts_map",
    sql=f"""WITH {sql.RESOLVED}, n AS (SELECT source, count(*) AS n FROM resolved GROUP BY 1)
SELECT string_agg(source || '=' || n, ',' ORDER BY source) AS source_counts FROM n""",
)
def source_counts_map(spark, sf):
    counts = P.count_map(resolved_pages(spark, sf), "source")
    pairs = F.transform(F.map_entries("source_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return counts.select(F.array_join(F.array_sort(pairs), ",").alias("source_counts"))


@query(
    "source_label_mismatch",
    sql=f"""SELECT page_id, url, label FROM (SELECT page_id, url, CASE WHEN url LIKE '%/de/%' THEN 1 ELSE {sql.label('url')} END AS label FROM pages)
            WHERE label IS DISTINCT FROM {sql.label('url')}""",
)
def source_label_mismatch(spark, sf):
    """German pages are all filed under the second site; the audit finds the wrong ones."""
    from broadsheet.functions.urls import label_from_host

    filed = F.when(F.col("url").contains("/de/"), F.lit(1)).otherwise(label_from_host(F.col("url"), RULES))
    rows = table(spark, sf, "pages").select("page_id", "url", filed.alias("label"))
    return P.source_label_mismatch(rows, RULES)


@query(
    "class_weights",
    sql="""SELECT quality AS label, count(*) AS rows, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
           FROM labels GROUP BY 1""",
)
def class_weights(spark, sf):
    rows = table(spark, sf, "labels").select(F.col("quality").alias("label"))
    return P.class_weights(rows).withColumn("weight", F.round("weight", 6))


_PRED = "SELECT doc_id, quality AS label, toxic AS prediction FROM labels"


@query("accuracy", sql=f"SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy, count(*) AS rows FROM ({_PRED})")
def accuracy(spark, sf):
    return M.accuracy(labelled_predictions(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


def _per_class(rows: str, by: str = "") -> str:
    """Per-class rows of ``(label, prediction)`` rows, optionally per group."""
    g = f"{by}, " if by else ""
    return f"""(SELECT *, CASE WHEN called = 0 THEN 0 ELSE tp / called END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
        CASE WHEN called + support = 0 THEN 0 ELSE 2 * tp / (called + support) END AS f1 FROM (
  SELECT {g}cls, CAST(sum(t) AS DOUBLE) AS support, CAST(sum(p) AS DOUBLE) AS called, CAST(sum(tp) AS DOUBLE) AS tp FROM (
    SELECT {g}label AS cls, 1 AS t, 0 AS p, CAST(label = prediction AS INT) AS tp FROM {rows}
    UNION ALL SELECT {g}prediction, 0, 1, 0 FROM {rows}) GROUP BY {g}cls))"""


@query(
    "macro_f1",
    sql=f"""SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1,
            round(sum(f1 * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS rows FROM {_per_class(f'({_PRED})')}""",
)
def macro_f1(spark, sf):
    out = M.summary(labelled_predictions(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")], "rows")


@query(
    "classification_report",
    sql=f"""WITH c AS (SELECT * FROM {_per_class(f'({_PRED})')})
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM (
  SELECT CAST(cls AS VARCHAR) AS class, precision AS p, recall AS r, f1 AS f, CAST(support AS BIGINT) AS support FROM c
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM c
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM c)""",
)
def classification_report(spark, sf):
    report = M.classification_report(labelled_predictions(spark, sf))
    return report.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "accuracy_aligned",
    sql="""
WITH t AS (SELECT quality, toxic, CASE quality WHEN 1 THEN 'alpha' ELSE 'beta' END AS two, l.doc_id % 3 || '' AS three FROM labels l)
SELECT kind, round(accuracy, 6) AS accuracy FROM (
  SELECT 'two names' AS kind, greatest(avg(CAST((toxic = 1) = (two = 'alpha') AS DOUBLE)), avg(CAST((toxic = 0) = (two = 'alpha') AS DOUBLE))) AS accuracy FROM t
  UNION ALL SELECT 'three names', avg(CAST(CAST(toxic AS VARCHAR) = three AS DOUBLE)) FROM t
  UNION ALL SELECT 'same type', avg(CAST(toxic = quality AS DOUBLE)) FROM t
  UNION ALL SELECT 'names predicted', greatest(avg(CAST((quality = 1) = (two = 'alpha') AS DOUBLE)), avg(CAST((quality = 0) = (two = 'alpha') AS DOUBLE))) FROM t
  UNION ALL SELECT 'no rows', 0.0)""",
)
def accuracy_aligned(spark, sf):
    rows = table(spark, sf, "labels").select(
        "quality", "toxic",
        F.when(F.col("quality") == 1, F.lit("alpha")).otherwise(F.lit("beta")).alias("two"),
        (F.col("doc_id") % 3).cast("string").alias("three"),
    )
    cases = {
        "two names": (rows, "toxic", "two"),
        "three names": (rows, "toxic", "three"),
        "same type": (rows, "toxic", "quality"),
        "names predicted": (rows, "two", "quality"),
        "no rows": (rows.filter(F.col("toxic") > F.lit(5)), "toxic", "two"),
    }
    out = None
    for kind, (df, prediction, target) in cases.items():
        one = M.aligned_accuracy(df, prediction, target).select(F.lit(kind).alias("kind"), F.round("accuracy", 6).alias("accuracy"))
        out = one if out is None else out.unionByName(one)
    return out


# The languages of the labelled documents stand in for scenarios: each gives one row of results.
_LANGUAGES = ("en", "xx", "de", "fr", "es")
_BY_LANGUAGE = "(SELECT d.lang AS scenario, l.quality AS label, l.toxic AS prediction FROM labels l JOIN documents d USING (doc_id))"
_RESULTS = f"""results AS (SELECT scenario, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1, CAST(sum(support) AS BIGINT) AS rows
  FROM {_per_class(_BY_LANGUAGE, 'scenario')} GROUP BY 1)"""


def _results(spark, sf):
    rows = (
        table(spark, sf, "labels")
        .join(table(spark, sf, "documents").select("doc_id", F.col("lang").alias("scenario")), "doc_id")
        .select("scenario", F.col("quality").alias("label"), F.col("toxic").alias("prediction"))
    )
    return M.summary(rows, by=("scenario",)).select("scenario", "accuracy", "macro_f1", "rows")


@query(
    "scenario_report",
    sql=f"""WITH {_RESULTS}, wanted(position, scenario) AS (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(_LANGUAGES))})
SELECT position, scenario, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, rows FROM wanted LEFT JOIN results USING (scenario) ORDER BY 1""",
)
def scenario_report(spark, sf):
    report = experiments.ordered_report(_results(spark, sf), _LANGUAGES)
    return report.select("position", "scenario", F.round("accuracy", 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"), "rows")


_PAIRS = (("english_to_german", "en", "de"), ("french_to_spanish", "fr", "es"), ("english_to_missing", "en", "xx"))


@query(
    "scenario_deltas",
    sql=f"""WITH {_RESULTS}, pairs(delta, a, b) AS (VALUES {', '.join(str(p) for p in _PAIRS)})
SELECT delta, round(x.accuracy, 6) AS before, round(y.accuracy, 6) AS after, round(y.accuracy - x.accuracy, 6) AS change
FROM pairs LEFT JOIN results x ON x.scenario = a LEFT JOIN results y ON y.scenario = b""",
)
def scenario_deltas(spark, sf):
    out = experiments.scenario_deltas(_results(spark, sf), _PAIRS)
    return out.select("delta", *[F.round(c, 6).alias(c) for c in ("before", "after", "change")])


@query(
    "baseline_margin",
    sql=f"""WITH {_RESULTS}, b AS (SELECT avg(CAST(quality = 0 AS DOUBLE)) AS v FROM labels)
SELECT scenario, round(accuracy, 6) AS accuracy, round(accuracy - v, 6) AS margin, accuracy > v AS beats_baseline FROM results, b""",
)
def baseline_margin(spark, sf):
    """The baseline always answers 0; its accuracy is read from the same labels."""
    baseline = table(spark, sf, "labels").agg(F.avg((F.col("quality") == 0).cast("double"))).scalar()
    out = experiments.baseline_margin(_results(spark, sf), baseline)
    return out.select("scenario", F.round("accuracy", 6).alias("accuracy"), F.round("margin", 6).alias("margin"), "beats_baseline")
