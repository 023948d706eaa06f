"""Taking spans out of documents, and what is left."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.common import row_key, text_of

_CUT = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept_text", pa.binary()),
    ]
)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as maximal ones, in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > ends[:-1]
    return starts[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)] if len(ends) else ends


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("bytes"), batch.column("spans"), strict=True):
                data = text.as_py()
                if spans.is_valid and len(spans):
                    flat = spans.values.to_numpy(zero_copy_only=False)
                    starts, ends = merged(flat[0::2], flat[1::2])
                    edges = [0, *np.ravel(np.column_stack([starts, ends])).tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                else:
                    starts, kept = (), data
                rows.append(
                    (len(data), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept if with_text else None)
                )
            new = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), _CUT, strict=True)] if rows else [
                pa.array([], type=f.type) for f in _CUT
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *new], names=["doc_id", *_CUT.names])

    return run


def without(docs: DataFrame, spans: DataFrame, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text)``, one row per input row.

    ``spans(key1, key2, start, end)`` are byte spans of the rows named by ``row_key``; they may
    overlap. ``n_spans`` counts the maximal removed runs. ``kept_text`` holds the bytes left if
    asked for, else it is null.
    """
    own = spans.groupBy("key1", "key2").agg(F.flatten(F.collect_set(F.array(F.col("start").cast("long"), F.col("end").cast("long")))).alias("spans"))
    texts = docs.select("doc_id", *row_key(), text_of().cast("binary").alias("bytes"))
    joined = texts.join(own, ["key1", "key2"], "left").select("doc_id", "bytes", "spans")
    schema = docs.select("doc_id").schema
    for name, kind in zip(_CUT.names, ("long", "long", "long", "string", "binary"), strict=True):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_cut(with_text), schema)
