"""Small Column helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed(df: DataFrame, *columns: Column) -> DataFrame:
    """Append columns that are evaluated exactly once per row.

    A plain projection is folded into whatever reads it, so a filter on an extracted
    headline would extract it again for every mention. A generated row is not folded:
    what follows reads finished values. It stays within the same code-generated stage.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def seeded_digest(seed: int | str, *keys: Column) -> Column:
    """Hex digest of seed and key: a shuffle order no partitioning can change."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def digest_number(digest: Column, hex_digits: int = 8) -> Column:
    """Leading hex digits of a digest as a BIGINT."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")
