"""Train, validate, refit on everything; evaluate a stored model."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from broadsheet.config import CleaningOptions
from broadsheet.functions.labels import text_of_string
from broadsheet.operators import metrics
from broadsheet.operators.features import frequent_totals, with_words
from broadsheet.operators.model import FitOptions, HeadlineModel, fit_model
from broadsheet.operators.sampling import fit_stratified_split
from broadsheet.plans.cleaning import prepare_data, prepare_dataset
from broadsheet.session import materialise
from broadsheet.sources.readers import require_rows, require_text


@dataclass(frozen=True)
class TrainingResult:
    model: HeadlineModel
    predictions: DataFrame
    report: DataFrame
    metadata: dict
    # the samples, their texts cut into words
    rows: DataFrame


def train(
    samples: DataFrame,
    key: str = "ord",
    *,
    test_size: float = 0.2,
    seed: int = 42,
    refit_on_all: bool = True,
    options: FitOptions = FitOptions(),
    cleaning: CleaningOptions | None = None,
) -> TrainingResult:
    """Samples are ``(key, text, label)``. The reported metrics are those of the split
    model; the returned model has seen every row unless ``refit_on_all`` is off.

    Texts are cut into words once. One aggregate counts the terms of the training side and of
    all rows, for both vocabularies."""
    rows = materialise(with_words(samples.select(key, "text", "label"), "text", options.tfidf), "samples")
    split = fit_stratified_split(rows, "label", key, test_size, seed)
    sets = {"train": ~split.is_test()} | ({"all": F.lit(True)} if refit_on_all else {})
    totals = frequent_totals(rows, "text", options.tfidf, sets, tuple(sets))
    validated = fit_model(split.train(rows), key, "text", options=options, totals=(totals, "train"))
    predictions = materialise(validated.score(split.test(rows), key, "text", ("label",)), "predictions")
    scores = metrics.summary(predictions).first()
    final = fit_model(rows, key, "text", options=options, totals=(totals, "all")) if refit_on_all else validated
    total, held_out = sum(split.counts.values()), sum(split.test_counts.values())
    metadata = {
        "model": "tfidf+logistic_regression",
        "num_samples": total,
        "train_samples": total - held_out,
        "val_samples": held_out,
        "val_accuracy": scores["accuracy"],
        "val_macro_f1": scores["macro_f1"],
        "final_retrain_on_full": refit_on_all,
        "random_state": seed,
        "test_size": test_size,
        "max_features": options.tfidf.max_features,
        "ngram_max": options.tfidf.ngram_max,
    }
    if cleaning is not None:
        metadata |= {
            "remove_duplicate_urls": cleaning.remove_duplicate_urls,
            "remove_duplicate_headlines": cleaning.remove_duplicate_headlines,
            "min_headline_chars": cleaning.min_headline_chars,
            "drop_symbol_only_headlines": cleaning.drop_symbol_only,
            "label_map": {str(r.label): r.source for r in cleaning.site_rules},
        }
    return TrainingResult(
        final.with_metadata(**metadata), predictions, metrics.classification_report(predictions), metadata, rows
    )


def train_from_table(df: DataFrame, order: str, cleaning: CleaningOptions = CleaningOptions.strict(), **settings) -> TrainingResult:
    """Guard, prepare and train a table whose roles are found by column name."""
    require_text(df, cleaning.allow_url_fallback, cleaning.roles)
    samples = prepare_dataset(require_rows(df, "the table is empty"), order, cleaning)
    require_rows(samples, "no row has both a usable text and a label")
    return train(samples, "ord", cleaning=cleaning, **settings)


def evaluate_table(df: DataFrame, order: str, model: HeadlineModel, site_rules=None) -> dict:
    """Score an uncleaned table: accuracy and the time one example takes.

    ``fixed_infer_s`` is the time that a job for a single row takes, whatever the model does;
    ``marginal_infer_ms`` is what each further row adds.
    """
    samples = prepare_data(df, order, site_rules) if site_rules else prepare_data(df, order)
    items = samples.withColumn("item", text_of_string(F.col("text"))).select("ord", "item", "label")
    items = materialise(items, "items")

    def timed(rows: DataFrame) -> tuple[DataFrame, float]:
        begin = time.perf_counter()
        scored = materialise(model.score(rows, "ord", "item", ("label",)), "scored")
        return scored, time.perf_counter() - begin

    _, fixed = timed(items.limit(1))
    scored, seconds = timed(items)
    accuracy = metrics.aligned_accuracy(scored, "prediction", "label").first()["accuracy"]
    n = scored.count()
    return {
        "num_examples": n,
        "avg_infer_ms": seconds / max(n, 1) * 1000.0,
        "total_infer_s": seconds,
        "fixed_infer_s": fixed,
        "marginal_infer_ms": max(seconds - fixed, 0.0) / max(n - 1, 1) * 1000.0,
        "accuracy": accuracy,
    }
