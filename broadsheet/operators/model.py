"""Class-balanced logistic regression on TF-IDF features.

Fitting is Spark ML. Scoring looks coefficients up inside the row and shuffles nothing; for
coefficients too many to broadcast it is a join and one sum per document.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.operators.features import (
    Lookup,
    TfidfModel,
    TfidfOptions,
    document_terms,
    fit_tfidf,
    raw_weight,
    row_weights,
    stored_vectors,
    tfidf_vectors,
    vocabulary_of,
    with_words,
)
from broadsheet.session import materialise
from broadsheet.sources.readers import CorpusError
from broadsheet.sources.writers import read_metadata, write_metadata


@dataclass(frozen=True)
class FitOptions:
    c: float = 2.0
    max_iter: int = 2000
    balanced: bool = True
    tol: float = 1e-6
    certify: bool = False
    tfidf: TfidfOptions = field(default_factory=TfidfOptions)

    @classmethod
    def baseline(cls, stop_words) -> "FitOptions":
        return cls(c=1.0, max_iter=100, balanced=False, tfidf=TfidfOptions.baseline(stop_words))


@dataclass(frozen=True)
class Certificate:
    """How far a fit can be from the best one.

    ``dual`` is a lower bound of the objective over all coefficients, so no fit is better by more
    than ``gap``; and as the penalty curves the objective, the best coefficients are at most
    ``radius`` away, for any intercept.
    """

    objective: float
    dual: float

    @property
    def gap(self) -> float:
        return self.objective - self.dual

    @property
    def relative_gap(self) -> float:
        return self.gap / max(abs(self.objective), 1e-300)

    @property
    def radius(self) -> float:
        return float(np.sqrt(2 * max(self.gap, 0.0)))

    def holds(self, tolerance: float = 1e-3) -> bool:
        """The bound is a bound, and within the tolerance of the objective."""
        return -1e-9 <= self.relative_gap <= tolerance


@dataclass(frozen=True)
class HeadlineModel:
    """Coefficients ``(term, idf, coef)``, an intercept, and how they came about."""

    coefficients: DataFrame
    intercept: float
    options: TfidfOptions
    classifier: LogisticRegressionModel | None = None
    metadata: dict = field(default_factory=dict)
    certificate: Certificate | None = None

    def score(self, df: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
        return score_linear(df, key, text, self.coefficients, self.intercept, self.options, keep)

    def save(self, path: str) -> None:
        """Classifier, coefficients and metadata under one folder."""
        if self.classifier is not None:
            self.classifier.write().overwrite().save(f"{path}/classifier")
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        extra = {"intercept": self.intercept, "tfidf": vars(self.options)}
        write_metadata(self.coefficients.sparkSession, {"model": extra, "meta": self.metadata}, f"{path}/metadata")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "HeadlineModel":
        stored = read_metadata(spark, f"{path}/metadata")
        settings = stored["model"]["tfidf"] | {"stop_words": tuple(stored["model"]["tfidf"]["stop_words"])}
        return HeadlineModel(
            spark.read.parquet(f"{path}/coefficients"),
            stored["model"]["intercept"],
            TfidfOptions(**settings),
            metadata=stored.get("meta", {}),
        )

    @staticmethod
    def load_classifier(path: str) -> LogisticRegressionModel:
        """The bare Spark ML model, without vocabulary or metadata."""
        return LogisticRegressionModel.load(f"{path}/classifier")

    def with_metadata(self, **entries) -> "HeadlineModel":
        return replace(self, metadata=self.metadata | entries)


def score_linear(
    df: DataFrame,
    key: str,
    text: str,
    coefficients: DataFrame,
    intercept: float,
    options: TfidfOptions = TfidfOptions(),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, *keep, margin, probability, prediction, known_terms)`` for every row; a row
    without a known term has the intercept for its margin.

    The coefficients are looked up in the row if their number allows a broadcast. Otherwise a
    document's terms leave one task side by side, so its two sums are complete before the
    shuffle, which then moves one small row per document; keys must be unique then.
    """
    lookup = Lookup.of(coefficients, "idf", "coef")
    if lookup is not None:
        found = row_weights(df, text, lookup, options, key, *keep)
        parts = F.zip_with("indices", "values", lambda i, w: w * F.get(lookup.column("coef"), i))
        sums = found.select(
            key,
            *keep,
            F.aggregate(parts, F.lit(0.0), lambda total, x: total + x).alias("dot"),
            F.aggregate("values", F.lit(0.0), lambda total, w: total + w * w).alias("square"),
            F.size("values").cast("bigint").alias("known_terms"),
        )
    else:
        w = raw_weight(options)
        sums = (
            document_terms(df, text, options, key, *keep)
            .join(coefficients.select("term", "idf", "coef"), "term", "left")
            .groupBy(key, *keep)
            .agg(
                F.coalesce(F.sum(w * F.col("coef")), F.lit(0.0)).alias("dot"),
                F.coalesce(F.sum(w * w), F.lit(0.0)).alias("square"),
                F.count("coef").alias("known_terms"),
            )
        )
    unit = F.when(F.col("square") > 0, F.col("dot") / F.sqrt("square")).otherwise(F.lit(0.0))
    return sums.select(key, *keep, (unit + F.lit(intercept)).alias("margin"), "known_terms").select(
        key,
        *keep,
        "margin",
        (1 / (1 + F.exp(-F.col("margin")))).alias("probability"),
        (F.col("margin") > 0).cast("int").alias("prediction"),
        "known_terms",
    )


def class_sizes(df: DataFrame, label: str) -> dict[int, int]:
    """Rows of the two classes; anything else is an error."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().limit(3).collect()}
    if set(sizes) != {0, 1}:
        raise CorpusError(f"need labels 0 and 1, found {sorted(map(str, sizes))}")
    return sizes


def balanced_weight(label: Column, sizes: dict[int, int]) -> Column:
    total = sum(sizes.values())
    return F.when(label == 0, total / (2 * sizes[0])).otherwise(total / (2 * sizes[1]))


def fit_logistic(vectors: DataFrame, sizes: dict[int, int], options: FitOptions) -> LogisticRegressionModel:
    """Minimises ``|w|^2/2 + C * sum(weight * loss)``; the intercept is not penalised.

    Spark divides the loss by the summed weights, so the penalty is divided too.
    Balanced weights sum to the number of rows, as unit weights do.
    """
    weight = balanced_weight(F.col("label"), sizes) if options.balanced else F.lit(1.0)
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol="target",
        weightCol="weight",
        regParam=1.0 / (options.c * sum(sizes.values())),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=options.max_iter,
        tol=options.tol,
        # gradients are as long as the vocabulary: they meet in stages, not at the driver
        aggregationDepth=3,
    )
    rows = vectors.select("features", F.col("label").cast("double").alias("target"), weight.alias("weight"))
    return estimator.fit(rows)


# Partial sums of gradients meet in so many groups before they meet at all.
_GROUPS = 32


def certify(vectors: DataFrame, fitted: LogisticRegressionModel, sizes: dict[int, int], options: FitOptions) -> Certificate:
    """Bounds the distance of a fit from the optimum, by two passes over its vectors.

    A row's dual variable is its share of the loss's slope. The intercept is free, so the two
    classes' dual variables must sum alike: those of the class with the larger sum are scaled
    down. The weighted sum of the rows, a vector as long as the vocabulary, is summed in groups.
    """
    weight = balanced_weight(F.col("label"), sizes) if options.balanced else F.lit(1.0)
    scored = fitted.transform(vectors.select("features", "label")).select(
        "features",
        "label",
        (F.lit(options.c) * weight).alias("cap"),
        (F.element_at(vector_to_array("rawPrediction"), 2) * (2 * F.col("label") - 1)).alias("margin"),
    )
    small = F.exp(-F.abs("margin"))
    loss = F.log1p(small) + F.when(F.col("margin") < 0, -F.col("margin")).otherwise(0.0)
    share = F.when(F.col("margin") < 0, 1 / (1 + small)).otherwise(small / (1 + small))
    rows = scored.select("features", "label", "cap", loss.alias("loss"), share.alias("share"))
    totals = {
        r["label"]: r for r in rows.groupBy("label").agg(F.sum(F.col("cap") * F.col("loss")).alias("loss"), F.sum(F.col("cap") * F.col("share")).alias("slope")).collect()
    }
    least = min(r["slope"] for r in totals.values())
    scale = F.when(F.col("label") == 0, least / totals[0]["slope"]).otherwise(least / totals[1]["slope"])
    feasible = rows.withColumn("share", F.col("share") * scale)

    def entropy(p: Column) -> Column:
        return F.when(p > 0, -p * F.log(p)).otherwise(0.0)

    dual = feasible.select(
        "features",
        "label",
        (F.spark_partition_id() % _GROUPS).alias("group"),
        (F.col("cap") * F.col("share")).alias("weight"),
        (F.col("cap") * (entropy(F.col("share")) + entropy(1 - F.col("share")))).alias("entropy"),
    )
    grouped = dual.groupBy("label", "group").agg(
        Summarizer.sum(F.col("features"), F.col("weight")).alias("features"), F.sum("entropy").alias("entropy")
    )
    sums = grouped.groupBy("label").agg(Summarizer.sum(F.col("features")).alias("features"), F.sum("entropy").alias("entropy")).collect()
    of = {r["label"]: r["features"].toArray() for r in sums}
    coefficients = fitted.coefficients.toArray()
    objective = 0.5 * float(coefficients @ coefficients) + sum(r["loss"] for r in totals.values())
    pull = of[1] - of[0]
    return Certificate(objective, sum(r["entropy"] for r in sums) - 0.5 * float(pull @ pull))


def fit_model(
    df: DataFrame,
    key: str,
    text: str,
    label: str = "label",
    options: FitOptions = FitOptions(),
    totals: tuple[DataFrame, str] | None = None,
) -> HeadlineModel:
    """Vocabulary, vectors and classifier of the given rows, whose words are cut once.

    A text column of words cut before is taken as it is. ``totals`` names a set of stored
    ``term_totals`` that holds these rows' counts, which are then not counted again.
    """
    rows = df.select(key, text, F.col(label).alias("label"))
    if df.schema[text].dataType.typeName() != "array":
        rows = materialise(with_words(rows, text, options.tfidf), "training_rows")
    sizes = class_sizes(rows, "label")
    vocab = None
    if totals is not None:
        vocab = vocabulary_of(totals[0], totals[1], F.lit(sum(sizes.values())), options.tfidf)
    tfidf: TfidfModel = fit_tfidf(rows, text, options.tfidf, vocab)
    vectors = stored_vectors(
        tfidf_vectors(rows, key, text, tfidf.vocabulary, tfidf.size, options.tfidf, ("label",)), "vectors"
    )
    fitted = fit_logistic(vectors, sizes, options)
    certificate = certify(vectors, fitted, sizes, options) if options.certify else None
    # one number per vocabulary term: bounded by max_features
    spark = df.sparkSession
    weights = spark.createDataFrame(
        [(i, float(c)) for i, c in enumerate(fitted.coefficients.toArray())], "idx int, coef double"
    )
    coefficients = tfidf.vocabulary.join(F.broadcast(weights), "idx").select("term", "idf", "coef")
    return HeadlineModel(coefficients, float(fitted.intercept), options.tfidf, fitted, certificate=certificate)
