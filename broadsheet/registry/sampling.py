"""Splits, samples and injected label conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.operators import sampling as S
from broadsheet.plans.cleaning import clean_frame
from broadsheet.registry import sql
from broadsheet.registry.base import experiment_corpus, query, table
from broadsheet.session import materialise


@query(
    "stratified_split",
    sql=f"SELECT doc_id, quality AS label, side AS split FROM {sql.split('labels', 'quality', 'doc_id')}",
)
def stratified_split(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return S.fit_stratified_split(rows, "label", "doc_id", 0.2, 42).transform(rows)


@query(
    "stratified_split_text",
    sql=f"SELECT doc_id, lang, side AS split FROM {sql.split('documents', 'lang', 'doc_id', 0.37, 5)}",
)
def stratified_split_text(spark, sf):
    """More than two classes, named by strings."""
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return S.fit_stratified_split(rows, "lang", "doc_id", 0.37, 5).transform(rows)


@query(
    "stratified_split_many",
    sql=f"SELECT o_orderkey, o_custkey, side AS split FROM {sql.split('orders', 'o_custkey', 'o_orderkey', 0.3, 9)}",
)
def stratified_split_many(spark, sf):
    """A class for each customer: thousands of classes, none of which comes to the driver."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return S.fit_stratified_split(rows, "o_custkey", "o_orderkey", 0.3, 9).transform(rows)


def _draws(rows: str, key: str, fraction: float = 0.5, seed: int = 123) -> str:
    """Rows of a sample with replacement, with the number of each draw."""
    return f"""(
  SELECT r.* EXCLUDE (rank), d.draw FROM
    (SELECT *, row_number() OVER (ORDER BY {sql.digest(seed, key)}, {key}) - 1 AS rank FROM {rows}) r
    JOIN (SELECT draw, {sql.number(f"substr(md5('{seed}|draw|' || draw), 1, 15)")} % n AS rank
          FROM (SELECT n, unnest(range(CAST(round_even({fraction} * n, 0) AS BIGINT))) AS draw FROM (SELECT count(*) AS n FROM {rows}))) d
    USING (rank))"""


@query("sample_with_replacement", sql=f"SELECT doc_id, draw FROM {_draws('labels', 'doc_id')}")
def sample_with_replacement(spark, sf):
    return S.sample_with_replacement(table(spark, sf, "labels").select("doc_id"), "doc_id", 0.5, 123)


@query("sample_n", sql=f"SELECT doc_id FROM documents WHERE source = 'src1' ORDER BY {sql.digest(7, 'doc_id')}, doc_id LIMIT 30")
def sample_n(spark, sf):
    documents = table(spark, sf, "documents").filter(F.col("source") == "src1").select("doc_id")
    return S.sample_fixed(documents, "doc_id", 30, 7)


_STRESS = f"""stress AS (
  SELECT ord, url, headline, label, 0 AS part, CAST(0 AS BIGINT) AS draw FROM experiment
  UNION ALL SELECT ord, coalesce(url, '') || '#label_conflict_' || ord, headline, 1 - label, 1, draw FROM {_draws('experiment', 'ord')}
)"""


def _corpus(spark, sf):
    # drawing passes over the rows several times, so pages are parsed once beforehand
    return materialise(experiment_corpus(spark, sf), "corpus")


@query("label_conflict_stress", sql=f"WITH {sql.EXPERIMENT}, {_STRESS} SELECT * FROM stress")
def label_conflict_stress(spark, sf):
    return S.inject_label_conflicts(_corpus(spark, sf), "ord", 0.5, 123)


@query(
    "label_conflict_cleaned",
    sql=f"WITH {sql.EXPERIMENT}, {_STRESS} SELECT ord, url, headline, label, part, draw FROM {sql.strict('stress', 'part, ord, draw')}",
)
def label_conflict_cleaned(spark, sf):
    """Strict cleaning removes what was injected."""
    stressed = S.inject_label_conflicts(_corpus(spark, sf), "ord", 0.5, 123)
    return clean_frame(stressed, strict=True, order=S.CONFLICT_ORDER)


# The experiment's tables: both sides of the split, and the training side with conflicts.
EXPERIMENT_TABLES = f"""{sql.EXPERIMENT}, sides AS (SELECT * FROM {sql.split('experiment', 'label', 'ord')}),
  train AS (SELECT * EXCLUDE (side) FROM sides WHERE side = 'train'), test AS (SELECT * EXCLUDE (side) FROM sides WHERE side = 'test'),
  stressed AS (SELECT ord, url, headline, label, 0 AS part, CAST(0 AS BIGINT) AS draw FROM train
               UNION ALL SELECT ord, coalesce(url, '') || '#label_conflict_' || ord, headline, 1 - label, 1, draw FROM {_draws('train', 'ord')})"""


@query(
    "run_metadata",
    sql=f"""WITH {EXPERIMENT_TABLES}
SELECT 42 AS random_state, 0.2::DOUBLE AS test_size, 0.5::DOUBLE AS stress_frac,
  (SELECT count(*) FROM train) AS train_rows_raw, (SELECT count(*) FROM test) AS test_rows_raw,
  (SELECT count(*) FROM {sql.strict('train')}) AS train_rows_strict, (SELECT count(*) FROM {sql.strict('test')}) AS test_rows_strict,
  (SELECT count(*) FROM stressed) AS stress_rows_raw, (SELECT count(*) FROM {sql.loose('stressed')}) AS stress_rows_loose,
  (SELECT count(*) FROM {sql.strict('stressed', 'part, ord, draw')}) AS stress_rows_strict""",
)
def run_metadata(spark, sf):
    from broadsheet.plans import experiments
    from broadsheet.sources.writers import metadata_row

    data = experiments.experiment_data(experiment_corpus(spark, sf), seed=42, test_size=0.2, stress_frac=0.5)
    record = experiments.run_metadata(data, sf, seed=42, test_size=0.2, stress_frac=0.5)
    sizes = [k for k in record if k.endswith(("_raw", "_loose", "_strict"))]
    fields = ", ".join(["random_state int", "test_size double", "stress_frac double"] + [f"{k} bigint" for k in sizes])
    return metadata_row(spark, record).select(F.from_json("value", fields).alias("m")).select("m.*")
