"""From raw documents to packed training sequences, in five stages.

Every stage reads all that the one before it kept and is written as Parquet. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.llm.common import row_key, shared_table, small_batches, text_of
from broadsheet.llm.decontaminate import template_matches
from broadsheet.llm.exact_dedup import exact_duplicates
from broadsheet.llm.language_id import UNKNOWN, fit, identify, share
from broadsheet.llm.ngram_join import near_duplicates
from broadsheet.llm.packing import pack

# Bits of a byte that nothing is known of.
RAW_BITS = 8.0


def _plain(docs: DataFrame) -> DataFrame:
    """The columns under names that cannot clash with those of an operator."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def _at(docs: DataFrame, name: str) -> str:
    return f"c{docs.columns.index(name)}"


def _chosen(docs: DataFrame, fingerprint: Callable[[Column], Column], chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``chosen(doc_id, mark)``. ``fingerprint`` makes a row's mark
    from its text. Of rows that agree in id and text the least by all columns stays."""
    plain = _plain(docs)
    mark = fingerprint(text_of(_at(docs, "text"))).cast("string")
    named = plain.select(
        F.concat_ws("|", F.col(_at(docs, "doc_id")).cast("string"), mark).alias("row"), F.struct(*plain.columns).alias("all")
    )
    wanted = chosen.select(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("mark").cast("string")).alias("row"))
    found = named.join(shared_table(wanted, "chosen"), "row", "left_semi")
    return found.groupBy("row").agg(F.min("all").alias("all")).select("all.*").toDF(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no known language: those without letters or text, and those that the
    best language's model codes in no fewer bits than their bytes have."""
    with small_batches(spark):
        return _known_language(spark, docs)


def _known_language(spark: SparkSession, docs: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text", "lang"))
    if model is None:  # no row teaches; what has letters is in some language
        return docs.filter(text_of().rlike(r"\p{L}"))
    sent = share(spark, model)
    del model
    plain = _plain(docs).withColumnRenamed(_at(docs, "text"), "text")
    found = identify(plain, sent, plain.columns)
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < RAW_BITS))
    kept = shared_table(kept.select(plain.columns).toDF(*docs.columns), "known_language")
    for piece in sent:
        piece.destroy()
    return kept


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    kept = exact_duplicates(docs.select("doc_id", "text")).filter("kept").select("doc_id", F.col("text_sha256").alias("mark"))
    return _chosen(docs, lambda text: F.sha2(text.cast("binary"), 256), kept)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays: the smallest id."""
    kept = near_duplicates(docs.select("doc_id", "text")).filter("kept").select("doc_id", F.col("body").alias("mark"))
    return _chosen(docs, F.xxhash64, kept)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item's words, under any figures and names."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = template_matches(docs.select("doc_id", "text"), benchmark).select(F.struct("key1", "key2").alias("row")).distinct()
    leaked = shared_table(found, "leaked")
    plain = _plain(docs)
    named = plain.select("*", F.struct(*row_key(_at(docs, "doc_id"), _at(docs, "text"))).alias("row"))
    return named.join(leaked, "row", "left_anti").drop("row").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return pack(docs)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", clean_of_benchmarks),
    ("best-fit packing", packed),
]

# Language identification is a trained model, and packing a search: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, (_, last) = STAGES
    for name, stage in earlier:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return last(spark, docs, sf_dir)
