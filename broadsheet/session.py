"""Session defaults and durable cut points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def build_session(app: str = "broadsheet", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs here rely on.

    Partition counts are left to adaptive execution: start from many shuffle
    partitions on a cluster and let AQE coalesce and split them at run time.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    fresh = tempfile.mkdtemp(prefix="broadsheet-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


SPREAD_BYTES = 256 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Use every core on a small table that is one row group, hence one task.

    Text work is bound by the processor. Only tables of at most ``SPREAD_BYTES`` are
    moved; a larger one is read as it is split, however many cores there are. The
    rows are the same either way. Call it on scans only.
    """
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    cores = scan.sparkSession.sparkContext.defaultParallelism
    small = size <= SPREAD_BYTES and scan.rdd.getNumPartitions() < cores
    return scan.repartition(cores) if small else scan


# Less than this is not worth a task of its own where a table is read in hundreds of passes.
PASS_BYTES = 8 << 20


def materialise(df: DataFrame, name: str, read_schema: StructType | None = None, many_passes: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Later stages re-read the table instead of recomputing the lineage, and a lost
    executor costs only the tasks it was running. A table for ``many_passes`` is read by
    tasks of at least ``PASS_BYTES``, as each pass pays for every task.
    """
    spark = df.sparkSession
    path = f"{working_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(read_schema or df.schema).parquet(path)
    if many_passes:
        size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return table.coalesce(max(1, -(-int(str(size)) // PASS_BYTES)))
    return spread(table)
