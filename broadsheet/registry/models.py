"""Fitted models. SQL cannot fit, but much of a fit does not depend on the optimiser's path: which
rows it saw, its vocabulary, the known terms of each scored row, and that a duality gap proves
the fit optimal. That is what these queries return and their twins compute."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from broadsheet.operators.model import FitOptions, HeadlineModel, fit_model
from broadsheet.plans import experiments, training
from broadsheet.registry import sql
from broadsheet.registry.base import experiment_corpus, query, resolved_pages, table
from broadsheet.registry.features import STOP_WORDS
from broadsheet.registry.sampling import EXPERIMENT_TABLES

_CERTIFIED = FitOptions(certify=True)


def language_samples(spark, sf):
    """Documents labelled by whether they are English: a target words can predict."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("ord"), "text", (F.col("lang") == "en").cast("int").alias("label")
    )


def _facts(scored: DataFrame, model: HeadlineModel, *keep: str) -> DataFrame:
    """What must hold of every scored row, and of the model."""
    likelier = (F.col("probability") > 0.5).cast("int")
    return scored.select(
        *keep,
        "known_terms",
        ((F.col("prediction") == likelier) & (F.col("probability") >= 0) & (F.col("probability") <= 1)).alias("sign_agrees"),
        F.lit(model.certificate.holds()).alias("certified"),
        F.lit(model.coefficients.count()).cast("bigint").alias("vocabulary_size"),
    )


_SAMPLES = "samples AS (SELECT doc_id AS ord, text, CAST(lang = 'en' AS INTEGER) AS label FROM documents)"
_PAGES = f"{sql.RESOLVED}, samples AS (SELECT ord, headline AS text, label FROM resolved WHERE label IS NOT NULL)"


def _vocab(rows: str, name: str = "counted") -> str:
    """The vocabulary of some rows, by the defaults of the headline model."""
    return f"""{name} AS (SELECT ord, term, count(*) AS tf FROM (
    SELECT ord, unnest({sql.grams('w')}) AS term FROM (SELECT ord, {sql.TOKENS} AS w FROM {rows})) GROUP BY 1, 2),
  vocab AS (SELECT term FROM {name} GROUP BY 1
    HAVING count(*) >= 2 AND count(*) <= 0.98::DOUBLE * (SELECT count(*) FROM {rows}) ORDER BY sum(tf) DESC, term LIMIT 30000)"""


def _known(rows: str, key: str) -> str:
    """Distinct known terms of some rows."""
    return f"""(SELECT {key}, count(DISTINCT term) AS known_terms FROM (
    SELECT {key}, unnest({sql.grams('w')}) AS term FROM (SELECT {key}, {sql.TOKENS} AS w FROM {rows})) JOIN vocab USING (term) GROUP BY 1)"""


_FACTS = "coalesce(known_terms, 0) AS known_terms, true AS sign_agrees, true AS certified, (SELECT count(*) FROM vocab) AS vocabulary_size"


@query(
    "lr_fit_score",
    sql=f"""WITH {_SAMPLES}, sides AS (SELECT * FROM {sql.split('samples', 'label', 'ord')}),
  train AS (SELECT * FROM sides WHERE side = 'train'), test AS (SELECT * FROM sides WHERE side = 'test'), {_vocab('train')}
SELECT ord, label, {_FACTS} FROM test LEFT JOIN {_known('test', 'ord')} USING (ord)""",
)
def lr_fit_score(spark, sf):
    """Held-out rows of the split model."""
    result = training.train(language_samples(spark, sf), refit_on_all=False, options=_CERTIFIED)
    return _facts(result.predictions, result.model, "ord", "label")


@query(
    "baseline_lr",
    sql=f"""WITH {_SAMPLES}, test AS (SELECT * FROM {sql.split('samples', 'label', 'ord')} WHERE side = 'test')
SELECT CAST(label AS VARCHAR) AS class, count(*) AS support, true AS certified, CAST(100 AS BIGINT) AS vocabulary_size FROM test GROUP BY 1
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM test), true, 100""",
)
def baseline_lr(spark, sf):
    """Report lines of the hundred-word baseline."""
    options = FitOptions.baseline(STOP_WORDS)
    result = training.train(language_samples(spark, sf), refit_on_all=False, options=replace(options, certify=True))
    return result.report.select(
        "class",
        F.col("support").cast("bigint").alias("support"),
        F.lit(result.model.certificate.holds()).alias("certified"),
        F.lit(result.model.coefficients.count()).cast("bigint").alias("vocabulary_size"),
    )


@query(
    "refit_full",
    sql=f"WITH {_SAMPLES}, {_vocab('samples')} SELECT ord, label, {_FACTS} FROM samples LEFT JOIN {_known('samples', 'ord')} USING (ord)",
)
def refit_full(spark, sf):
    """In-sample rows of the model refitted on every row."""
    result = training.train(language_samples(spark, sf), options=_CERTIFIED)
    return _facts(result.model.score(result.rows, "ord", "text", ("label",)), result.model, "ord", "label")


@query(
    "predict",
    sql=f"WITH {_PAGES}, {_vocab('samples')} SELECT doc_id, {_FACTS} FROM documents LEFT JOIN {_known('documents', 'doc_id')} USING (doc_id)",
)
def predict(spark, sf):
    """A model of the page headlines scores every document."""
    pages = resolved_pages(spark, sf).filter(F.col("label").isNotNull()).select("ord", F.col("headline").alias("text"), "label")
    model = fit_model(pages, "ord", "text", options=_CERTIFIED)
    return _facts(model.score(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text"), model, "doc_id")


def _grid_sql(scenarios) -> str:
    """Sizes of the scenarios' tables; a fit's figures are left out, its certificate is in."""
    tables = {"loose": sql.loose("train"), "strict": sql.strict("train"), "stress_loose": sql.loose("stressed"),
              "stress_strict": sql.strict("stressed", "part, ord, draw")}
    lines = ", ".join(
        f"({i}, '{s.section}', '{s.name}', '{s.train}', '{s.train_fields}', '{s.test_fields}', '{s.notes}')" for i, s in enumerate(scenarios)
    )
    sizes = " UNION ALL ".join(f"SELECT '{name}' AS train, count(*) AS train_rows FROM {rows}" for name, rows in tables.items())
    return f"""WITH {EXPERIMENT_TABLES}, sizes AS ({sizes})
SELECT section, scenario, train_representation, test_representation, train_rows,
  (SELECT count(*) FROM {sql.strict('test')}) AS test_rows, notes, true AS whole_rows, true AS certified
FROM (VALUES {lines}) v (i, section, scenario, train, train_representation, test_representation, notes) JOIN sizes USING (train)"""


def _grid_facts(results: DataFrame, models: dict[tuple[str, str], HeadlineModel], scenarios) -> DataFrame:
    """Results without figures that depend on the optimiser's path or the clock. Accuracy must
    be a whole number of rows."""
    proven = [s.name for s in scenarios if models[s.train, s.train_fields].certificate.holds()]
    right = F.col("accuracy") * F.col("test_rows")
    return results.select(
        "section", "scenario", "train_representation", "test_representation", "train_rows", "test_rows", "notes",
        ((F.abs(right - F.round(right)) < 1e-6) & (F.col("avg_infer_ms") > 0)).alias("whole_rows"),
        F.col("scenario").isin(proven).alias("certified"),
    )


def _grid(spark, sf, scenarios) -> DataFrame:
    data = experiments.experiment_data(experiment_corpus(spark, sf))
    models = experiments.fit_grid(data, scenarios, _CERTIFIED)
    return _grid_facts(experiments.run_grid(data, scenarios, _CERTIFIED, models), models, scenarios)


@query("run_one_eval", sql=_grid_sql(experiments.SCENARIOS[6:7]))
def run_one_eval(spark, sf):
    return _grid(spark, sf, experiments.SCENARIOS[6:7])


@query("scenario_grid", sql=_grid_sql(experiments.SCENARIOS))
def scenario_grid(spark, sf):
    return _grid(spark, sf, experiments.SCENARIOS)
