import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from broadsheet.config import CleaningOptions
from broadsheet.operators import model as M
from broadsheet.operators.features import TfidfOptions
from broadsheet.plans import training
from broadsheet.sources.readers import CorpusError

SMALL = M.FitOptions(tfidf=TfidfOptions(min_df=1, max_df=1.0, max_features=200))


def newton(x, y, weight, c, steps=50):
    """Minimise |w|^2/2 + c * sum(weight * loss), intercept free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ w))
        gradient = penalty @ w + c * x1.T @ (weight * (p - y))
        hessian = penalty + c * (x1.T * (weight * p * (1 - p))) @ x1
        w -= np.linalg.solve(hessian, gradient)
    return w


@pytest.mark.parametrize("balanced", [True, False])
def test_fit_agrees_with_newton(spark, balanced):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 6))
    y = (x @ np.array([1.0, -2, 0.5, 0, 0, 1]) + rng.normal(size=200) > 0.8).astype(int)
    df = spark.createDataFrame([(Vectors.dense(r), int(t)) for r, t in zip(x.tolist(), y)], ["features", "label"])
    sizes = M.class_sizes(df, "label")
    weight = np.where(y == 0, 200 / (2 * sizes[0]), 200 / (2 * sizes[1])) if balanced else np.ones(200)
    fitted = M.fit_logistic(df, sizes, M.FitOptions(c=2.0, balanced=balanced, tol=1e-10))
    want = newton(x, y, weight, 2.0)
    assert np.allclose([*fitted.coefficients, fitted.intercept], want, atol=1e-3)


@pytest.mark.parametrize("balanced", [True, False])
def test_certificate_bounds_the_optimum(spark, balanced):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    y = (x @ np.array([1.0, -2, 0.5, 0, 1]) + rng.normal(size=300) > 1.0).astype(int)
    df = spark.createDataFrame([(Vectors.dense(r), int(t)) for r, t in zip(x.tolist(), y)], ["features", "label"]).repartition(5)
    sizes = M.class_sizes(df, "label")
    weight = np.where(y == 0, 300 / (2 * sizes[0]), 300 / (2 * sizes[1])) if balanced else np.ones(300)
    best = newton(x, y, weight, 2.0)
    margins = (2 * y - 1) * (x @ best[:-1] + best[-1])
    optimum = 0.5 * best[:-1] @ best[:-1] + 2.0 * (weight * np.log1p(np.exp(-margins))).sum()
    for steps in (1, 3, 200):
        options = M.FitOptions(c=2.0, balanced=balanced, tol=1e-12, max_iter=steps)
        fitted = M.fit_logistic(df, sizes, options)
        proof = M.certify(df, fitted, sizes, options)
        assert proof.dual <= optimum + 1e-6 and proof.objective >= optimum - 1e-6
        assert np.linalg.norm(fitted.coefficients.toArray() - best[:-1]) <= proof.radius + 1e-6
    assert proof.holds(1e-6) and not M.Certificate(2.0, 1.0).holds() and not M.Certificate(1.0, 2.0).holds()


@pytest.fixture(scope="module")
def samples(spark):
    rows = [
        (i, f"goal match player{i % 9} league cup" if i % 5 < 2 else f"vote senate law{i % 11} budget tax", int(i % 5 >= 2))
        for i in range(200)
    ] + [(1000, "...", 1), (1001, "unseen words only", 0)]
    return spark.createDataFrame(rows, "ord long, text string, label int")


@pytest.fixture(scope="module")
def fitted(samples):
    return M.fit_model(samples, "ord", "text", options=SMALL)


def test_separable_target_is_learnt(samples, fitted):
    scored = fitted.score(samples.filter("ord < 1000"), "ord", "text", ("label",))
    assert scored.filter("label <> prediction").count() == 0
    assert scored.count() == 200


def test_join_scoring_equals_the_classifier(spark, samples, fitted):
    from broadsheet.operators import features as X

    tfidf = X.fit_tfidf(samples, "text", SMALL.tfidf)
    vectors = X.stored_vectors(X.tfidf_vectors(samples, "ord", "text", tfidf.vocabulary, tfidf.size, SMALL.tfidf), "t")
    by_ml = {r.ord: (r.probability[1], int(r.prediction)) for r in fitted.classifier.transform(vectors).collect()}
    by_join = {r.ord: (r.probability, r.prediction) for r in fitted.score(samples, "ord", "text").collect()}
    assert by_ml.keys() == by_join.keys() and 1000 in by_join
    assert all(abs(by_ml[k][0] - by_join[k][0]) < 1e-9 and by_ml[k][1] == by_join[k][1] for k in by_ml)


def test_scoring_shuffles_nothing(samples, fitted):
    plan = fitted.score(samples, "ord", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EvalPython" not in plan


def test_scoring_beyond_a_broadcast(samples, fitted, monkeypatch):
    from broadsheet.operators import features as X

    rounded = lambda: sorted((r.ord, round(r.margin, 9), r.prediction) for r in fitted.score(samples, "ord", "text").collect())
    in_rows = rounded()
    monkeypatch.setattr(X, "BROADCAST_TERMS", 3)
    plan = fitted.score(samples, "ord", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 or "SortMergeJoin" in plan
    assert rounded() == in_rows


def test_model_round_trip(spark, samples, fitted, tmp_path):
    path = str(tmp_path / "model")
    fitted.with_metadata(val_accuracy=0.5).save(path)
    again = M.HeadlineModel.load(spark, path)
    assert again.metadata == {"val_accuracy": 0.5} and again.options == fitted.options
    key = lambda m: sorted((r.ord, round(r.margin, 9)) for r in m.score(samples, "ord", "text").collect())
    assert key(again) == key(fitted)
    assert M.HeadlineModel.load_classifier(path).numFeatures == fitted.classifier.numFeatures


def test_one_class_is_refused(samples):
    with pytest.raises(CorpusError):
        M.fit_model(samples.filter("label = 1"), "ord", "text", options=SMALL)


def test_train_reports_split_model_and_returns_refit(samples):
    result = training.train(samples, options=SMALL)
    assert result.metadata["num_samples"] == 202
    assert result.metadata["train_samples"] + result.metadata["val_samples"] == 202
    assert result.predictions.count() == result.metadata["val_samples"] == 41
    assert result.metadata["val_accuracy"] > 0.9
    assert {r["class"] for r in result.report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    terms = {r.term for r in result.model.coefficients.collect()}
    assert "goal" in terms and result.model.metadata["final_retrain_on_full"]


def test_shared_counting_equals_separate_fits(samples):
    """Split model and refit from one count of the terms are those of their own rows."""
    result = training.train(samples, options=SMALL, refit_on_all=False)
    rows = result.rows
    held_out = {r.ord for r in result.predictions.collect()}
    alone = M.fit_model(samples.filter(~F.col("ord").isin(list(held_out))), "ord", "text", options=SMALL)
    key = lambda m: sorted((r.term, round(r.idf, 9), round(r.coef, 6)) for r in m.coefficients.collect())
    assert key(result.model) == key(alone)
    assert key(training.train(samples, options=SMALL).model) == key(M.fit_model(rows, "ord", "text", options=SMALL))


def test_train_and_evaluate_a_table(spark, samples):
    table = samples.filter("ord < 1000").select(
        F.col("ord").alias("n"),
        F.col("text").alias("Headline"),
        F.concat(F.lit("https://www."), F.when(F.col("label") == 0, "foxnews.com").otherwise("nbcnews.com"), F.lit("/a/"), "ord").alias("url"),
    )
    options = CleaningOptions.strict(remove_duplicate_headlines=False)
    result = training.train_from_table(table, "n", options, options=SMALL)
    assert result.metadata["label_map"] == {"0": "FoxNews", "1": "NBC"}
    out = training.evaluate_table(table, "n", result.model)
    assert out["num_examples"] == 200 and out["accuracy"] == 1.0 and out["avg_infer_ms"] > 0
    assert out["fixed_infer_s"] > 0 and out["marginal_infer_ms"] <= out["avg_infer_ms"] * 200 / 199
    with pytest.raises(CorpusError):
        training.train_from_table(table.select("n", "url"), "n")
    with pytest.raises(CorpusError):
        training.train_from_table(table.withColumn("Headline", F.lit(" ")), "n")


def test_baseline_model(samples):
    options = M.FitOptions.baseline(["cup"])
    result = training.train(samples, options=options, refit_on_all=False)
    terms = {r.term for r in result.model.coefficients.collect()}
    assert "cup" not in terms and all(" " not in t for t in terms) and len(terms) <= 100
