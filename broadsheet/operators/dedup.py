"""Keep-first deduplication.

``row_number() = 1`` lets Spark prune each key to one row inside every map task
before the shuffle, so a key that holds a third of all rows reaches its reducer
with one row per map task. ``dropDuplicates`` would keep an arbitrary row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__keep_first_rank"


def keep_first(df: DataFrame, key: Column, *order: Column | str) -> DataFrame:
    """First row of every key in the given order; the order must be total."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_first_or_blank(df: DataFrame, key: Column, unique: Column, *order: Column | str) -> DataFrame:
    """As ``keep_first``, but rows with an empty key are all kept.

    Each blank row gets a key of its own, so blanks spread over all partitions
    instead of meeting in one.
    """
    marked = F.when(key == "", F.struct(F.lit(""), unique.cast("string"))).otherwise(
        F.struct(key, F.lit(""))
    )
    return keep_first(df, marked, *order)


def text_digest(text: Column) -> Column:
    """Fixed-size stand-in for a long dedup key, so texts are not shuffled twice."""
    return F.sha2(text, 256)
