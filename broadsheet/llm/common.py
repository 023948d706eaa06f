"""What the operators of this subpackage share: shared tables, row keys, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.session import working_dir

# Where the tables written by ``shared_table`` are.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "8m"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """Within the block, a setting of the session has this value."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession):
    """Within the block, executions hand rows to Python at most ``BATCH`` bytes at a time, and a row."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and continue from the written table.

    Cuts lineage: a lost executor costs its running tasks only, and the shuffle files
    behind the table are dropped. The table is removed when the application ends.
    """
    return shared_parts([df], name)


def shared_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """``shared_table`` of the rows of one or more frames of the same columns. Each is planned and
    written before the next is taken: however many there are, the driver holds one plan at a time."""
    path = schema = None
    for df in parts:
        spark = df.sparkSession
        if path is None:
            path, schema = f"{working_dir(spark)}/{name}-{uuid.uuid4().hex}", df.schema
        with _setting(spark, _CLEANUP, "true"):  # a finished execution drops its shuffle files at once
            df.write.mode("append").option("compression", "zstd").parquet(path)
    files, target = _located(spark, path)
    files.deleteOnExit(target)
    table = spark.read.schema(schema).parquet(path)
    _PATHS[table] = path
    return table


def release(*tables: DataFrame) -> None:
    """Remove shared tables that nothing will read again."""
    for table in tables:
        files, target = _located(table.sparkSession, _PATHS.pop(table))
        files.delete(target, True)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def text_of(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """128 bits that name a row by its id and text: rows that agree in both are copies
    of one row and always share one fate."""
    doc, body = F.col(doc_id).cast("string"), text_of(text)
    return [
        F.xxhash64(F.lit(1), doc, body).alias("key1"),
        F.xxhash64(F.lit(2), body, doc).alias("key2"),
    ]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: label is the smallest node reachable.

    Alternates two star contractions until nothing changes. Every node's neighbours are
    reduced by a map-side minimum, so a node with very many edges is no hot spot, and no
    list of neighbours is ever gathered.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs = shared_table(pairs.distinct(), "edges")
    if pairs.isEmpty():
        return pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    last = None
    for _ in range(max_rounds):
        # larger neighbours move to the smallest neighbour
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("v_min")).select("u", F.least("v_min", "u").alias("m"))
        moved = (
            both.filter("v > u")
            .join(smallest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v")
            .distinct()
        )
        # smaller neighbours, and the node itself, move to the smallest of them
        least = moved.groupBy("u").agg(F.min("v").alias("m"))
        settled = (
            moved.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u != v")
            .distinct()
        )
        before, pairs = pairs, shared_table(settled, "edges")
        release(before)
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
