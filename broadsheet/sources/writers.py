"""Sinks. Order is global only where a reader needs it; files stay splittable."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.sources.schemas import CLEAN_CORPUS, EVAL_RESULT


def _write(df: DataFrame, path: str, form: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if form == "csv":
        writer = writer.options(header=True, escape='"', emptyValue="")
    writer.format(form).save(path)


def write_raw(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    """Resolved rows, range-partitioned and sorted by URL.

    Ranges make the files globally ordered without one task seeing every row; a
    repeated URL is spread by the second key.
    """
    keys = ["url"] + [c for c in ("ord", "fetched_at_utc") if c in df.columns]
    _write(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path, form, mode)


def write_clean(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    _write(df.select(*CLEAN_CORPUS.names), path, form, mode)


def write_results(df: DataFrame, path: str, form: str = "csv", mode: str = "overwrite") -> None:
    """Scenario table, in report order; a handful of rows, so one file."""
    columns = [c for c in EVAL_RESULT.names if c in df.columns]
    _write(df.select(*columns).coalesce(1), path, form, mode)


def metadata_row(spark: SparkSession, metadata: dict) -> DataFrame:
    """Run parameters and counts as one row holding one JSON document."""
    return spark.range(1).select(F.lit(json.dumps(metadata, ensure_ascii=False, sort_keys=True)).alias("value"))


def write_metadata(spark: SparkSession, metadata: dict, path: str, mode: str = "overwrite") -> None:
    metadata_row(spark, metadata).write.mode(mode).text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
