"""Incremental corpus building.

Extraction and row filters are projections and run on a stream unchanged. Keep-first
deduplication has to look back at everything accepted so far: each micro-batch is
cleaned on its own and then checked against the keys of earlier batches. A batch
writes only its own folder, so a replay after a failure replaces what it had written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from broadsheet.config import SITE_RULES
from broadsheet.functions.text import dedup_key
from broadsheet.functions.urls import url_key
from broadsheet.operators.dedup import keep_first, text_digest
from broadsheet.operators.model import HeadlineModel
from broadsheet.operators.resolve import resolve_single
from broadsheet.plans.cleaning import clean_resolved
from broadsheet.sources.schemas import CLEAN_CORPUS

_KEYS = "key string, batch bigint"


def stream_pages(spark: SparkSession, path: str, schema: StructType, form: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(form).load(path)


def resolved_stream(pages: DataFrame, rules=SITE_RULES, allow_url_fallback: bool = False) -> DataFrame:
    """Headlines of arriving pages; stateless."""
    return resolve_single(pages, allow_url_fallback=allow_url_fallback, rules=rules)


def _earlier(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Keys of batches before this one; partition pruning skips the others."""
    try:
        known = spark.read.schema(_KEYS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        # nothing written yet
        return spark.createDataFrame([], _KEYS).select("key")
    return known.filter(F.col("batch") < batch).select("key")


def append_clean(batch: DataFrame, batch_id: int, target: str, order: tuple[str, ...] = ("url", "ord")) -> None:
    """Clean one micro-batch and add what earlier batches do not already hold.

    A URL counts as seen from its first accepted row on, also when that row then
    loses to an earlier headline; both key sets are kept for that.
    """
    spark = batch.sparkSession
    rows = clean_resolved(batch, order, dedup_headlines=False).withColumn("key", url_key(F.col("url")))
    rows = rows.join(_earlier(spark, f"{target}/urls", batch_id), "key", "left_anti")
    rows.write.mode("overwrite").parquet(f"{target}/accepted/batch={batch_id}")
    rows = spark.read.parquet(f"{target}/accepted/batch={batch_id}")
    rows.select("key").write.mode("overwrite").parquet(f"{target}/urls/batch={batch_id}")
    fresh = keep_first(rows.drop("key").withColumn("key", text_digest(dedup_key(F.col("headline")))), F.col("key"), *order)
    fresh = fresh.join(_earlier(spark, f"{target}/headlines", batch_id), "key", "left_anti")
    fresh.select(*CLEAN_CORPUS.names, "key").write.mode("overwrite").parquet(f"{target}/corpus/batch={batch_id}")
    spark.read.parquet(f"{target}/corpus/batch={batch_id}").select("key").write.mode("overwrite").parquet(
        f"{target}/headlines/batch={batch_id}"
    )


def build_corpus(resolved: DataFrame, target: str, checkpoint: str, order: tuple[str, ...] = ("url", "ord"), **trigger) -> StreamingQuery:
    """Start the incremental corpus; ``read_corpus`` reads it at any time."""
    return (
        resolved.writeStream.foreachBatch(lambda df, i: append_clean(df, i, target, order))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_corpus(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/corpus").drop("key")


def score_stream(items: DataFrame, model: HeadlineModel, key: str, text: str, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Predictions of arriving items, a folder per micro-batch."""

    def score(df: DataFrame, i: int) -> None:
        model.score(df, key, text).write.mode("overwrite").parquet(f"{target}/batch={i}")

    return (
        items.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
