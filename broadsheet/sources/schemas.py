"""Explicit schemas of every table that is read or written."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

URL_LIST = _table(("url", _S, True))

CAPTURES = _table(
    ("url", _S, False),
    ("stage", _I, False),
    ("variant", _I, False),
    ("attempt", _I, False),
    ("status_code", _I, True),
    ("content_type", _S, True),
    ("final_url", _S, True),
    ("body", _S, True),
    ("error", _S, True),
    ("fetched_at", T.TimestampType(), True),
    ("elapsed_ms", _L, True),
)

RESOLVED = _table(
    ("url", _S, False),
    ("source", _S, False),
    ("label", _I, True),
    ("success", _B, False),
    ("headline", _S, False),
    ("status_code", _I, True),
    ("error", _S, False),
    ("final_url", _S, False),
    ("elapsed_ms", _L, True),
    ("fetched_at_utc", T.TimestampType(), True),
    ("headline_method", _S, False),
)

CLEAN_CORPUS = _table(("url", _S, False), ("source", _S, False), ("label", _I, False), ("headline", _S, False))

EVAL_RESULT = _table(
    ("section", _S, False),
    ("scenario", _S, False),
    ("train_representation", _S, False),
    ("test_representation", _S, False),
    ("train_rows", _L, False),
    ("test_rows", _L, False),
    ("accuracy", _D, True),
    ("macro_f1", _D, True),
    ("avg_infer_ms", _D, True),
    ("notes", _S, False),
)
