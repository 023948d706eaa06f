"""TF-IDF over word n-grams.

Terms are counted inside each row. Term totals are the only shuffle: a vocabulary whose
measured size allows it is broadcast, and lookup, weights and length of a document are
computed in its row. Text is never shuffled.

Wherever a text column is taken, an array column of words cut before (``with_words``) does too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from broadsheet.functions.binding import let
from broadsheet.functions.tokens import ngrams, term_counts, tokens
from broadsheet.operators.counting import cell_totals, ngram_totals
from broadsheet.session import materialise

# Vocabularies of up to this many rows, as counted, travel to every executor.
BROADCAST_TERMS = 500_000


@dataclass(frozen=True)
class TfidfOptions:
    """Defaults of the headline model; ``baseline`` gives the 100-word one."""

    ngram_max: int = 2
    min_df: int = 2
    max_df: float = 0.98
    max_features: int | None = 30_000
    sublinear_tf: bool = True
    stop_words: tuple[str, ...] = ()
    strip_accents: bool = True

    @classmethod
    def baseline(cls, stop_words) -> "TfidfOptions":
        return cls(1, 1, 1.0, 100, False, tuple(stop_words), False)


def words_of(text: Column, options: TfidfOptions) -> Column:
    """Words of a text without stop words."""
    words = tokens(text, options.strip_accents)
    if options.stop_words:
        # array_except would also drop repetitions, which are counts here
        words = F.filter(words, lambda w: ~w.isin(*options.stop_words))
    return words


def terms_of(text: Column, options: TfidfOptions) -> Column:
    """Terms of a text, stop words taken out before n-grams are formed."""
    return ngrams(words_of(text, options), options.ngram_max)


def with_words(df: DataFrame, text: str, options: TfidfOptions) -> DataFrame:
    """The text column replaced by its words: written once, it is never cut again."""
    return df.withColumn(text, words_of(F.col(text), options))


def _terms(df: DataFrame, text: str, options: TfidfOptions) -> Column:
    cut = isinstance(df.schema[text].dataType, T.ArrayType)
    return ngrams(F.col(text), options.ngram_max) if cut else terms_of(F.col(text), options)


def document_terms(df: DataFrame, text: str, options: TfidfOptions, *keep: str) -> DataFrame:
    """``(*keep, term, tf)``: a row per distinct term; a null term if there is none."""
    counted = term_counts(_terms(df, text, options))
    return df.select(*keep, counted.alias("__terms")).select(*keep, F.inline_outer("__terms"))


def _most_frequent(counted: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` rows with the highest ``tf``, ties by term.

    A histogram of at most about a thousand logarithmic bins tells which counts can
    be among the top, so the final sort sees little more than ``limit`` rows.
    """
    bin_of = F.floor(F.log2("tf") * 16)
    bins = counted.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("bin"))) - F.col("n")
    lowest = bins.withColumn("above", above).filter(F.col("above") < limit).agg(F.min("bin"))
    return counted.filter(bin_of >= lowest.scalar()).orderBy(F.desc("tf"), "term").limit(limit)


def _with_sets(df: DataFrame, text: str, options: TfidfOptions, sets: dict[str, Column]) -> DataFrame:
    """Words, and for each set whether a row is in it."""
    flagged = df.select(text, *[F.coalesce(c, F.lit(False)).alias(name) for name, c in sets.items()])
    return flagged if isinstance(df.schema[text].dataType, T.ArrayType) else with_words(flagged, text, options)


def term_totals(df: DataFrame, text: str, options: TfidfOptions, sets: dict[str, Column]) -> DataFrame:
    """``(term, tf_<set>, df_<set>, ...)`` for several sets of rows in one pass: a set is a
    condition on the rows."""
    return ngram_totals(_with_sets(df, text, options, sets), text, options.ngram_max, list(sets))


def _kept(totals: DataFrame, name: str, n_docs: Column, options: TfidfOptions, *keep: str) -> DataFrame:
    """``(term, tf, df, *keep)`` of the terms within the limits of document frequency."""
    return totals.select("term", F.col(f"tf_{name}").alias("tf"), F.col(f"df_{name}").alias("df"), *keep).filter(
        (F.col("df") >= max(options.min_df, 1)) & (F.col("df") <= F.lit(options.max_df) * n_docs)
    )


def vocabulary_of(totals: DataFrame, name: str, n_docs: Column, options: TfidfOptions, *keep: str) -> DataFrame:
    """``(term, tf, df, *keep)`` of the terms that a set of ``term_totals`` keeps."""
    counted = _kept(totals, name, n_docs, options, *keep)
    return counted if options.max_features is None else _most_frequent(counted, options.max_features)


# Cells of the counting sketch; each is one number for each set. At most all come to the driver.
SKETCH_CELLS = 1 << 20


def frequent_totals(
    df: DataFrame, text: str, options: TfidfOptions, sets: dict[str, Column], of: tuple[str, ...]
) -> DataFrame:
    """``term_totals``, written, of the terms that the vocabularies of the sets ``of`` can hold, and some more.

    A first pass adds terms up in hashed cells: a cell's sum bounds the occurrences of each of its terms, and
    cells are all that it shuffles. The second counts exactly, and shuffles only, terms of cells that
    reach ``min_df`` and a number of occurrences. If enough counted terms reach that number, none
    outside the cells can be among the most frequent; otherwise the number is quartered.
    """
    rows = _with_sets(df, text, options, sets)
    if not isinstance(df.schema[text].dataType, T.ArrayType):
        rows = materialise(rows, "words")
    spark, limit, floor = df.sparkSession, options.max_features, max(options.min_df, 1)
    n_docs = rows.agg(*[F.count_if(name).alias(name) for name in of]).first()
    cells = materialise(cell_totals(rows, text, options.ngram_max, list(of), SKETCH_CELLS), "cells")
    least = dict.fromkeys(of, floor)
    if limit is not None:
        for name in of:
            # as many cells as may hold the terms wanted, and their like
            tf = F.col(f"tf_{name}")
            upto = F.sum("cells").over(Window.orderBy(F.desc("tf")))
            sizes = cells.groupBy(tf.alias("tf")).agg(F.count(F.lit(1)).alias("cells")).withColumn("upto", upto)
            least[name] = max(sizes.filter(F.col("upto") >= 2 * limit).agg(F.max("tf")).first()[0] or 0, floor)
    while True:
        reach = F.lit(False)
        for name in of:
            reach = reach | (F.col(f"tf_{name}") >= least[name])
        heavy = np.zeros(SKETCH_CELLS, bool)
        heavy[cells.filter(reach).select("cell").toArrow().column("cell").to_numpy()] = True
        sent = spark.sparkContext.broadcast(heavy)
        counted = materialise(ngram_totals(rows, text, options.ngram_max, list(sets), sent), "counted_terms")
        sent.destroy()
        short = []
        for name in of:
            kept = _kept(counted, name, F.lit(n_docs[name]), options).filter(F.col("tf") >= least[name])
            if least[name] > floor and kept.limit(limit).count() < limit:
                short.append(name)
        if not short:
            return counted
        for name in short:
            least[name] = max(least[name] // 4, floor)


def vocabulary(df: DataFrame, text: str, options: TfidfOptions = TfidfOptions()) -> DataFrame:
    """``(term, tf, df)`` of the kept terms of a corpus."""
    n_docs = df.agg(F.count(F.lit(1)))
    return vocabulary_of(frequent_totals(df, text, options, {"all": F.lit(True)}, ("all",)), "all", n_docs.scalar(), options)


def pruned_vocabulary(df: DataFrame, text: str, options: TfidfOptions = TfidfOptions()) -> DataFrame:
    """``vocabulary``, which counts exactly only what a sketch leaves."""
    return vocabulary(df, text, options)


def with_idf(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the smoothed inverse document frequency ``ln((1+N)/(1+df)) + 1``."""
    n_docs = docs.agg(F.count(F.lit(1)))
    return vocab.withColumn("idf", F.log((1 + n_docs.scalar()) / (1 + F.col("df"))) + 1)


def raw_weight(options: TfidfOptions) -> Column:
    tf = (1 + F.log("tf")) if options.sublinear_tf else F.col("tf").cast("double")
    return tf * F.col("idf")


@dataclass(frozen=True)
class Lookup:
    """The rows of a vocabulary that was counted and found small enough to be broadcast."""

    terms: list[str]
    numbers: dict[str, list[float]]

    @staticmethod
    def of(vocab: DataFrame, *numbers: str) -> "Lookup | None":
        """Rows in the order of their terms; None if there are more than may be broadcast."""
        rows = vocab.select("term", *numbers).limit(BROADCAST_TERMS + 1).collect()
        if len(rows) > BROADCAST_TERMS:
            return None
        rows.sort(key=lambda r: r["term"])
        return Lookup([r["term"] for r in rows], {n: [float(r[n]) for r in rows] for n in numbers})

    def column(self, name: str) -> Column:
        """The numbers as one constant array."""
        return F.split(F.lit(" ".join(map(repr, self.numbers[name]))), " ").cast("array<double>")

    def term_column(self) -> Column:
        return F.split(F.lit("\x1f".join(self.terms)), "\x1f")


def _counter(spark: SparkSession, terms: list[str], source: str, target: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, which hands the terms over one call each, in one."""
    java_terms = spark._jvm.java.util.regex.Pattern.compile("\x1f").split("\x1f".join(terms))
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", java_terms)
    return model.setInputCol(source).setOutputCol(target)


def row_weights(df: DataFrame, text: str, lookup: Lookup, options: TfidfOptions, *keep: str) -> DataFrame:
    """``(*keep, indices, values)``: positions in the lookup, rising, and raw weights; arrays
    without elements for a row without a known term. Nothing is shuffled."""
    terms = F.coalesce(_terms(df, text, options), F.array().cast("array<string>"))
    if not lookup.terms:
        return df.select(*keep, F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values"))
    counter = _counter(df.sparkSession, lookup.terms, "__terms", "__counts")
    counted = counter.transform(df.select(*keep, terms.alias("__terms"))).select(*keep, F.unwrap_udt("__counts").alias("__counts"))

    def weight(index: Column, count: Column) -> Column:
        tf = 1 + F.log(count) if options.sublinear_tf else count
        return tf * F.get(lookup.column("idf"), index)

    weights = F.zip_with("__counts.indices", "__counts.values", weight)
    return counted.select(*keep, F.col("__counts.indices").alias("indices"), weights.alias("values"))


def _square(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, w: total + w * w)


def tfidf_weights(df: DataFrame, key: str, text: str, vocab: DataFrame, options: TfidfOptions = TfidfOptions()) -> DataFrame:
    """``(key, term, weight)`` with unit-length rows; documents without terms have none."""
    lookup = Lookup.of(vocab, "idf")
    if lookup is not None:
        rows = row_weights(df, text, lookup, options, key).withColumn("norm", F.sqrt(_square(F.col("values"))))
        pairs = F.arrays_zip("indices", "values")
        return rows.select(key, "norm", F.inline(pairs)).select(
            key, F.get(lookup.term_column(), F.col("indices")).alias("term"), (F.col("values") / F.col("norm")).alias("weight")
        )
    terms = document_terms(df, text, options, key).filter(F.col("term").isNotNull())
    weighted = terms.join(vocab.select("term", "idf"), "term").select(key, "term", raw_weight(options).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", (F.col("w") / norm).alias("weight"))


# A sparse vector column as Parquet stores it, and as Spark ML reads it back.
_SPARSE = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def tfidf_vectors(
    df: DataFrame, key: str, text: str, vocab: DataFrame, size: int, options: TfidfOptions, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(key, *keep, features)`` with ``features`` in the stored form of a sparse vector.

    ``vocab`` has ``(term, idx, idf)`` with ``idx`` from 0 in the order of the terms; it is
    bounded as the coefficients are. Documents without a known term keep an empty vector.
    """
    lookup = Lookup.of(vocab, "idx", "idf")
    if lookup is None or lookup.numbers["idx"] != list(range(size)):
        raise ValueError(f"vectors need terms numbered in order, at most {BROADCAST_TERMS}")
    weighted = row_weights(df, text, lookup, options, key, *keep)

    # bound to a variable: a length in a column would be folded into the lambda, once for every weight
    def unit(values: Column) -> Column:
        return let(F.sqrt(_square(values)), lambda norm: F.transform(values, lambda w: w / norm))

    return weighted.select(
        key,
        *keep,
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(size).alias("size"),
            F.col("indices"),
            let(F.col("values"), unit).alias("values"),
        ).cast(_SPARSE).alias("features"),
    )


def stored_vectors(vectors: DataFrame, name: str) -> DataFrame:
    """Write vectors to the shared folder and read them as Spark ML vectors.

    The optimiser passes over this table many times; a lost executor re-reads its
    part of it instead of tokenising again.
    """
    fields = [f for f in vectors.schema.fields if f.name != "features"]
    schema = T.StructType([*fields, T.StructField("features", VectorUDT(), True)])
    return materialise(vectors, name, schema, many_passes=True)


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary ``(term, idx, tf, df, idf)`` and its size."""

    vocabulary: DataFrame
    size: int
    options: TfidfOptions


def fit_tfidf(
    df: DataFrame, text: str, options: TfidfOptions = TfidfOptions(), counted: DataFrame | None = None
) -> TfidfModel:
    """Fit on the given rows only; indices follow the terms' alphabetical order. ``counted`` is
    their vocabulary, if it is known already."""
    if options.max_features is None:
        raise ValueError("a model needs max_features: its vocabulary bounds the coefficient vector")
    vocab = with_idf(counted if counted is not None else vocabulary(df, text, options), df)
    # at most max_features rows, so numbering them in one task is bounded
    numbered = vocab.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    table = materialise(numbered, "vocabulary")
    size = table.count()
    if size == 0:
        raise ValueError("no term survives the document-frequency limits")
    return TfidfModel(table, size, options)
