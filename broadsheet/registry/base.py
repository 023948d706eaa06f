"""The query table and the inputs that several queries share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.config import SiteRule
from broadsheet.operators.resolve import resolve_single
from broadsheet.session import spread

# The given pages come from three example hosts; two of them stand for the two sites.
RULES = (
    SiteRule("example.com", "SiteA", 0, (("matches", "class", "headline"),)),
    SiteRule("example.net", "SiteB", 1, (("equals", "data-testid", "headline"), ("any", "", ""))),
)


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        QUERIES[name] = Query(build, sql)
        return build

    return register


# Tables whose rows are expensive to work on; the others are cheap per row.
TEXT_TABLES = ("pages", "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan) if name in TEXT_TABLES else scan


def resolved_pages(spark: SparkSession, sf_dir: str, slug: bool = False) -> DataFrame:
    """``(ord, url, source, label, success, headline, headline_method)`` per page."""
    pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "ord")
    return resolve_single(pages, allow_url_fallback=slug, rules=RULES)


def with_repeats(df: DataFrame) -> DataFrame:
    """Every row twice, the second time with its URL in capitals: work for URL dedup."""
    first = df.withColumn("ord", F.col("ord") * 2)
    again = df.withColumn("ord", F.col("ord") * 2 + 1).withColumn("url", F.upper("url"))
    return first.unionByName(again)


def mixed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ord, title, label, link)``: pages twice, then documents without a URL.

    Pages bring no label and every repeat brings no title; documents bring labels
    where the label table has them.
    """
    pages = resolved_pages(spark, sf_dir).select("ord", F.col("headline").alias("title"), "url")
    paged = with_repeats(pages).select(
        "ord",
        F.when(F.col("ord") % 2 == 0, F.col("title")).alias("title"),
        F.lit(None).cast("string").alias("label"),
        F.col("url").alias("link"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    documents = (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select(
            (F.col("doc_id") + 1_000_000_000_000).alias("ord"),
            F.col("text").alias("title"),
            "label",
            F.lit("").alias("link"),
        )
    )
    return paged.unionByName(documents)


def experiment_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(ord, url, headline, label)``: labelled pages twice, then labelled documents
    with a blank URL."""
    pages = resolved_pages(spark, sf_dir).filter(F.col("label").isNotNull())
    paged = with_repeats(pages.select("ord", "url", "headline", "label"))
    documents = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .select(
            (F.col("doc_id") + 1_000_000_000_000).alias("ord"),
            F.lit(None).cast("string").alias("url"),
            F.col("text").alias("headline"),
            F.col("quality").alias("label"),
        )
    )
    return paged.unionByName(documents)


def labelled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label table read as an evaluation: ``quality`` is truth, ``toxic`` the guess."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )
