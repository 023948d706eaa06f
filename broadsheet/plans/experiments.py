"""The scenario grid: what cleaning buys, and what a URL shortcut costs.

Nine scenarios need six fitted models; each is fitted once and reused.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.config import FIELD_SEPARATOR
from broadsheet.functions.text import fields_text, normalise, strip
from broadsheet.functions.urls import url_words
from broadsheet.operators import metrics
from broadsheet.operators.features import TfidfOptions, words_of
from broadsheet.operators.model import FitOptions, HeadlineModel, fit_model
from broadsheet.operators.sampling import CONFLICT_ORDER, fit_stratified_split, inject_label_conflicts
from broadsheet.plans.cleaning import clean_frame
from broadsheet.session import materialise
from broadsheet.sources.readers import experiment_input
from broadsheet.sources.schemas import EVAL_RESULT


@dataclass(frozen=True)
class Scenario:
    section: str
    name: str
    train: str
    train_fields: str
    test_fields: str
    notes: str


H, U, HU = "headline_only", "url_only", "headline_plus_url"

# The scenarios, in report order.
SCENARIOS = (
    Scenario("cleaning_effect", "real_data_loose_clean", "loose", H, H, "Real rows, loosely cleaned."),
    Scenario("cleaning_effect", "real_data_strict_clean", "strict", H, H, "Real rows, strictly cleaned."),
    Scenario("cleaning_effect", "stress_data_loose_clean", "stress_loose", H, H, "Injected conflicts kept."),
    Scenario("cleaning_effect", "stress_data_strict_clean", "stress_strict", H, H, "Injected conflicts cleaned away."),
    Scenario("shortcut_risk", "headline_to_headline", "strict", H, H, "Trained and tested on headlines."),
    Scenario("shortcut_risk", "url_to_headline", "strict", U, H, "Trained on URLs, tested on headlines."),
    Scenario("shortcut_risk", "url_to_url", "strict", U, U, "Trained and tested on URLs."),
    Scenario("shortcut_risk", "headline_plus_url_to_headline_plus_url", "strict", HU, HU, "Both fields, both times."),
    Scenario("shortcut_risk", "headline_plus_url_to_headline_only", "strict", HU, H, "URL missing at test time."),
)

# Fixed values: (report line, from scenario, to scenario).
DELTAS = (
    ("real_cleaning", "real_data_loose_clean", "real_data_strict_clean"),
    ("stress_cleaning", "stress_data_loose_clean", "stress_data_strict_clean"),
    ("url_shortcut", "url_to_url", "url_to_headline"),
    ("combined_shortcut", "headline_plus_url_to_headline_plus_url", "headline_plus_url_to_headline_only"),
)


def representation(mode: str, headline: str = "headline", url: str = "url") -> Column:
    return fields_text(normalise(F.col(headline)), normalise(url_words(F.col(url))), mode)


WORDS = ("headline_words", "url_words")


def with_field_words(rows: DataFrame, tfidf: TfidfOptions) -> DataFrame:
    """Adds both fields' words, as cleaning leaves the fields. A conflict's suffix is a URL's
    fragment, so an injected row has its source's words."""
    headline, url = (F.coalesce(F.col(c), F.lit("")) for c in ("headline", "url"))
    texts = (normalise(headline), normalise(url_words(strip(url))))
    return rows.withColumns({w: words_of(t, tfidf) for w, t in zip(WORDS, texts, strict=True)})


def represented(df: DataFrame, mode: str, tfidf: TfidfOptions) -> DataFrame:
    """Adds ``text``: the words of the fields in ``mode`` if the table brings them, else the text."""
    if not set(WORDS) <= set(df.columns):
        return df.withColumn("text", representation(mode))
    headline, url = map(F.col, WORDS)
    both = F.concat(headline, words_of(F.lit(FIELD_SEPARATOR), tfidf), url)
    return df.withColumn("text", {H: headline, U: url, HU: both}[mode])


@dataclass(frozen=True)
class ExperimentData:
    """Training and test tables by name, written once, and their sizes."""

    train: dict[str, DataFrame]
    test: DataFrame
    train_rows: dict[str, int]
    sizes: dict[str, int]
    tfidf: TfidfOptions


def experiment_data(
    corpus: DataFrame,
    *,
    test_size: float = 0.2,
    seed: int = 42,
    stress_frac: float = 0.5,
    stress_seed: int = 123,
    tfidf: TfidfOptions = TfidfOptions(),
) -> ExperimentData:
    """Split first, then clean each side on its own, then inject conflicts.

    Headlines and URLs are cut into words once, here: all training tables and the test table
    carry the words of the corpus, however many models read them."""
    rows = materialise(with_field_words(experiment_input(corpus, "ord"), tfidf), "corpus")
    split = fit_stratified_split(rows, "label", "ord", test_size, seed)
    train_raw, test_raw = split.train(rows), split.test(rows)
    stress_raw = materialise(inject_label_conflicts(train_raw, "ord", stress_frac, stress_seed), "stress")

    def numbered(df: DataFrame) -> DataFrame:
        # drawn rows repeat their source's number; the three columns together are unique
        return df.withColumn("row_id", F.concat_ws("-", *CONFLICT_ORDER)).select("row_id", "headline", "url", "label", *WORDS)

    def plain(df: DataFrame) -> DataFrame:
        return df.select(F.col("ord").cast("string").alias("row_id"), "headline", "url", "label", *WORDS)

    train = {
        "loose": materialise(plain(clean_frame(train_raw, False)), "loose"),
        "strict": materialise(plain(clean_frame(train_raw, True)), "strict"),
        "stress_loose": materialise(numbered(clean_frame(stress_raw, False, CONFLICT_ORDER)), "stress-loose"),
        "stress_strict": materialise(numbered(clean_frame(stress_raw, True, CONFLICT_ORDER)), "stress-strict"),
    }
    test = materialise(plain(clean_frame(test_raw, True)), "test")
    tested, total = sum(split.test_counts.values()), sum(split.counts.values())
    sizes = {
        "train_rows_raw": total - tested,
        "test_rows_raw": tested,
        "test_rows_strict": test.count(),
        "stress_rows_raw": stress_raw.count(),
    }
    rows_of = {name: table.count() for name, table in train.items()}
    return ExperimentData(train, test, rows_of, sizes, tfidf)


def run_metadata(data: ExperimentData, source: str, *, seed: int, test_size: float, stress_frac: float) -> dict:
    return {
        "run_date_local": datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
        "input_csv": source,
        "random_state": seed,
        "test_size": test_size,
        "stress_frac": stress_frac,
        **data.sizes,
        "train_rows_strict": data.train_rows["strict"],
        "stress_rows_loose": data.train_rows["stress_loose"],
        "stress_rows_strict": data.train_rows["stress_strict"],
    }


def fit_scenario_model(train: DataFrame, fields: str, options: FitOptions = FitOptions()) -> HeadlineModel:
    return fit_model(represented(train, fields, options.tfidf), "row_id", "text", options=options)


def evaluate_scenario(scenario: Scenario, model: HeadlineModel, test: DataFrame, train_rows: int, test_rows: int) -> tuple:
    """One row of the results table; only its numbers come to the driver."""
    items = represented(test, scenario.test_fields, model.options)
    begin = time.perf_counter()
    scores = metrics.summary(model.score(items, "row_id", "text", ("label",))).first()
    seconds = time.perf_counter() - begin
    return (
        scenario.section, scenario.name, scenario.train_fields, scenario.test_fields, train_rows, test_rows,
        scores["accuracy"], scores["macro_f1"], seconds / max(1, test_rows) * 1000.0, scenario.notes,
    )


def run_one_eval(scenario: Scenario, train: DataFrame, test: DataFrame, options: FitOptions = FitOptions()) -> DataFrame:
    """Represent, fit, score and measure a single scenario."""
    model = fit_scenario_model(train, scenario.train_fields, options)
    row = evaluate_scenario(scenario, model, test, train.count(), test.count())
    return train.sparkSession.createDataFrame([row], EVAL_RESULT)


def fit_grid(data: ExperimentData, scenarios=SCENARIOS, options: FitOptions = FitOptions()) -> dict[tuple[str, str], HeadlineModel]:
    """The models that the scenarios need, by training table and fields."""
    if (data.tfidf.strip_accents, data.tfidf.stop_words) != (options.tfidf.strip_accents, options.tfidf.stop_words):
        raise ValueError("the tables' words were cut under other options: pass them to experiment_data as tfidf")
    wanted = dict.fromkeys((s.train, s.train_fields) for s in scenarios)
    return {(name, fields): fit_scenario_model(data.train[name], fields, options) for name, fields in wanted}


def run_grid(
    data: ExperimentData, scenarios=SCENARIOS, options: FitOptions = FitOptions(), models: dict | None = None
) -> DataFrame:
    """The results table, one row per scenario in the given order."""
    models = models or fit_grid(data, scenarios, options)
    rows = [
        evaluate_scenario(s, models[s.train, s.train_fields], data.test, data.train_rows[s.train], data.sizes["test_rows_strict"])
        for s in scenarios
    ]
    return data.test.sparkSession.createDataFrame(rows, EVAL_RESULT)


def ordered_report(results: DataFrame, names, column: str = "scenario") -> DataFrame:
    """Results in a given order; a name without a result keeps an empty row."""
    positions = F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias(column)) for i, n in enumerate(names)]))
    wanted = results.sparkSession.range(1).select(positions.alias("w")).select("w.*")
    return wanted.join(results, column, "left").orderBy("position")


def scenario_deltas(results: DataFrame, deltas=DELTAS, column: str = "scenario", value: str = "accuracy") -> DataFrame:
    """``(delta, before, after, change)`` per line, by one conditional aggregate."""
    names = sorted({n for _, a, b in deltas for n in (a, b)})
    picked = results.agg(*[F.max(F.when(F.col(column) == n, F.col(value))).alias(f"v{i}") for i, n in enumerate(names)])
    at = {n: F.col(f"v{i}") for i, n in enumerate(names)}
    lines = [
        F.struct(F.lit(d).alias("delta"), at[a].alias("before"), at[b].alias("after"), (at[b] - at[a]).alias("change"))
        for d, a, b in deltas
    ]
    return picked.select(F.inline(F.array(*lines)))


def baseline_margin(results: DataFrame, baseline: Column, value: str = "accuracy") -> DataFrame:
    """Adds the margin over a baseline value and whether it is beaten."""
    return results.withColumn("margin", F.col(value) - baseline).withColumn("beats_baseline", F.col(value) > baseline)
