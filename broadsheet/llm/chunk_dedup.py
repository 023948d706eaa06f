"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes: every byte shifts it by one bit and adds the byte's random
number, so 32 bytes decide it. A chunk ends where the hash's top bits are zero, hence
chunks move along with the text when something is put in before them. Chunks are
compared by digest; the first copy (smallest id, then place) stays, later ones go. A copy
counts only within a run of copied chunks of ``min_run`` bytes or more, so that a stray short
chunk in common is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from broadsheet.llm.common import release, row_key, shared_table, text_of
from broadsheet.llm.spans import without

# A chunk ends after each byte with a probability of 1 in 2 ** BITS, but not before MIN_CHUNK bytes.
BITS, MIN_CHUNK, MAX_CHUNK = 5, 16, 1024
MIN_RUN = 64
_BLOCK = 1 << 20

_GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, 256, np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after every byte: the sum of the last 32 bytes' numbers, each shifted by its age."""
    h = _GEAR[data]
    age = 1
    while age < 32:
        h[age:] += h[:-age] << np.uint32(age) if len(h) > age else 0
        age *= 2
    return h


def chunk_ends(data: bytes, bits: int = BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> list[int]:
    """Where the chunks of ``data`` end; the last end is its length."""
    view = np.frombuffer(data, np.uint8)
    found = []
    for at in range(0, len(view), _BLOCK):  # 31 bytes before a block decide its first hashes
        lead = min(at, 31)
        h = gear_hashes(view[at - lead : at + _BLOCK])[lead:]
        found.append(np.flatnonzero(h >> np.uint32(32 - bits) == 0) + at + 1)
    ends, last = [], 0
    for end in np.concatenate(found).tolist() if found else []:
        while end - last > most:
            last += most
            ends.append(last)
        if end - last >= least:
            ends.append(end)
            last = end
    while len(data) - last > most:
        last += most
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


_CHUNK = [
    ("key1", pa.int64()),
    ("key2", pa.int64()),
    ("start", pa.int64()),
    ("end", pa.int64()),
    ("digest1", pa.int64()),
    ("digest2", pa.int64()),
]


def chunks(docs: DataFrame, bits: int = BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``(doc_id, key1, key2, start, end, digest1, digest2)``, a row per chunk of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                owner, starts, ends, digests = [], [], [], []
                for i, text in enumerate(part.column("bytes")):
                    data = text.as_py()
                    own = chunk_ends(data, bits, least, most)
                    begin = [0, *own[:-1]] if own else []
                    owner += [i] * len(own)
                    starts += begin
                    ends += own
                    digests += [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begin, own, strict=True)]
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(take) for c in ("doc_id", "key1", "key2")),
                        pa.array(starts, pa.int64()),
                        pa.array(ends, pa.int64()),
                        pa.array(both[:, 0]),
                        pa.array(both[:, 1]),
                    ],
                    names=["doc_id", *(c[0] for c in _CHUNK)],
                )

    schema = docs.select("doc_id").schema
    for name, _ in _CHUNK:
        schema = schema.add(name, T.LongType())
    return docs.select("doc_id", *row_key(), text_of().cast("binary").alias("bytes")).mapInArrow(run, schema)


def repeated_spans(
    docs: DataFrame, bits: int = BITS, least: int = MIN_CHUNK, most: int = MAX_CHUNK, min_run: int = MIN_RUN
) -> DataFrame:
    """``(key1, key2, start, end)``: runs of chunks whose first copy stands elsewhere.

    The first copy is that of the smallest ``doc_id`` (null last), then place. Repeated rows,
    equal in id and text, count as one document.
    """
    all_chunks = shared_table(chunks(docs, bits, least, most), "chunks")
    twice = all_chunks.groupBy("digest1").agg(F.count("*").alias("n")).filter("n > 1").select("digest1")
    twice = shared_table(twice, "common_digests")
    common = shared_table(all_chunks.join(twice, "digest1", "left_semi"), "common_chunks")
    release(all_chunks, twice)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start", "key1", "key2")
    firsts = common.groupBy("digest1", "digest2").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    firsts = shared_table(firsts.filter("n > 1"), "first_chunks")
    copies = common.join(firsts, ["digest1", "digest2"]).filter(
        "not (first.key1 = key1 and first.key2 = key2 and first.start = start)"
    )
    copies = shared_table(copies.select("key1", "key2", "start", "end").distinct(), "chunk_copies")
    release(common, firsts)
    order = Window.partitionBy("key1", "key2").orderBy("start")
    begins = (F.col("start") != F.coalesce(F.lag("end").over(order), F.lit(-1))).cast("int")
    runs = copies.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order))
    runs = runs.groupBy("key1", "key2", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.filter(F.col("end") - F.col("start") >= min_run).drop("run")


def dedup_substrings(docs: DataFrame, with_text: bool = False, **chunking) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text)``, one row per input row:
    the texts without the runs of chunks that are copies. Null texts count as empty."""
    return without(docs, shared_table(repeated_spans(docs, **chunking), "copied_spans"), with_text)
