"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted
and numbered; then adjacent pairs of numbers are numbered in the same way, again and
again, until one number is left for each document. Two texts end with the same number
at the same level exactly if they are equal byte for byte: numbers are given to contents
(first level) and to pairs of numbers (further levels), never to digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.common import shared_table, text_of

BLOCK_BYTES = 4096


def _blocks(block_bytes: int):
    last = F.greatest(F.ceil(F.length("bytes") / block_bytes) - 1, F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes))
    )


def name_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(row, doc_id, text_sha256, n_bytes, level, name)``, one row per input row.

    Equal texts, and no others, share ``(level, name)``. Null text counts as empty; an
    empty text is one empty block. An empty table gives an empty table; other columns
    are not read.
    """
    if block_bytes < 1:
        raise ValueError("block_bytes must be positive")
    texts = docs.select("doc_id", text_of().cast("binary").alias("bytes"))
    # Level 0: sorted distinct blocks get integers. Each partition holds its own range of
    # contents in order, so a retried task numbers them alike.
    contents = texts.select(F.explode(_blocks(block_bytes)).alias("block")).distinct()
    names = shared_table(
        contents.sortWithinPartitions("block").select(
            F.unhex(F.sha2("block", 256)).alias("content"), F.monotonically_increasing_id().alias("name")
        ),
        "block_names",
    )
    pieces = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2("bytes", 256).alias("text_sha256"),
        F.length("bytes").cast("long").alias("n_bytes"),
        F.transform(_blocks(block_bytes), lambda b: F.unhex(F.sha2(b, 256))).alias("contents"),
    ).select("*", F.size("contents").alias("n"), F.posexplode("contents").alias("idx", "content"))
    placed = shared_table(
        pieces.select(
            "row",
            F.when(F.col("idx") == 0, F.col("doc_id")).alias("doc_id"),
            F.when(F.col("idx") == 0, F.col("text_sha256")).alias("text_sha256"),
            F.when(F.col("idx") == 0, F.col("n_bytes")).alias("n_bytes"),
            "n",
            "idx",
            "content",
        )
        .join(names, "content")
        .drop("content"),
        "named_blocks",
    )
    longest = placed.agg(F.max("n")).first()[0] or 1
    current = placed.select("row", "n", "idx", "name")
    finished = current.filter("n = 1").select("row", F.lit(0).alias("level"), "name")
    level = 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        # the odd block at an end pairs with -1, which names nothing
        pairs = (
            current.filter("n > 1")
            .groupBy("row", F.expr("cast((n + 1) div 2 as int)").alias("n"), F.shiftright("idx", 1).alias("idx"))
            .agg(
                F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        pair_names = (
            pairs.select("left", "right")
            .distinct()
            .sortWithinPartitions("left", "right")
            .select("left", "right", F.monotonically_increasing_id().alias("name"))
        )
        current = shared_table(
            pairs.join(pair_names, ["left", "right"]).select("row", "n", "idx", "name"), f"named_pairs_{level}"
        )
        finished = finished.unionByName(current.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return placed.filter("idx = 0").select("row", "doc_id", "text_sha256", "n_bytes").join(finished, "row")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, n_bytes)``, one row per input row.

    Of equal texts the row with the largest ``doc_id`` stays; a null id is smaller than
    any other. If that row itself is repeated, exactly one of its copies is kept.
    """
    named = shared_table(name_documents(docs, block_bytes), "identities")
    groups = shared_table(
        named.groupBy("level", "name").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
        ),
        "identity_groups",
    )
    return named.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
        "n_bytes",
    )
