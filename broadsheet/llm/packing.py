"""Packing token sequences by minimum bin slack.

Every bin starts with the longest piece left; a subset-sum bitset over the lengths left finds
the fullest feasible rest, which is taken out. As pieces of one length are alike, a
combination found once fills as many bins as the counts allow. Pieces are dealt at random
into pools of bounded size, and every pool is packed in a task of its own: only its last bins
can be slack, so the loss is about one bin in ten thousand.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import shared_table, text_of
from broadsheet.llm.vocabularies import byte_level, content_of, vocabulary_path

CAPACITY = 2048
SEPARATOR = 0
POOL_PIECES = 20_000


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: all whole but perhaps the first."""
    head = length % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, length, capacity))]


def token_pieces(
    docs: DataFrame, vocabulary: bytes, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the documents' tokens, each ended
    by the separator, in pieces of at most ``capacity``. A null text counts as empty and is
    the separator alone."""
    columns = [
        ("piece", pa.int32(), T.IntegerType()),
        ("start", pa.int64(), T.LongType()),
        ("length", pa.int64(), T.LongType()),
        ("ids_crc32", pa.int64(), T.LongType()),
    ]
    if with_ids:
        columns.append(("ids", pa.list_(pa.int32()), T.ArrayType(T.IntegerType())))
    end = np.array([separator], "<u4").tobytes()
    content = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level(content.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                owner, rows = [], []
                for i, text in enumerate(part.column("text")):
                    ids = encode(text.as_py()).tobytes() + end
                    for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        own = ids[4 * start : 4 * (start + length)]
                        row = (n, start, length, zlib.crc32(own))
                        rows.append((*row, np.frombuffer(own, "<i4")) if with_ids else row)
                        owner.append(i)
                new = [pa.array(list(c), type=f[1]) for c, f in zip(zip(*rows, strict=True), columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), *new], names=["doc_id", *(f[0] for f in columns)]
                )

    schema = docs.select("doc_id").schema
    for name, _, kind in columns:
        schema = schema.add(name, kind)
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def fill_bins(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """``(pieces by length in a bin, number of such bins)``, by minimum bin slack."""
    left = dict(counts)
    lengths = sorted(left)
    while lengths:
        seed = lengths[-1]
        room = capacity - seed
        left[seed] -= 1
        mask = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for length in reversed(lengths[: bisect_right(lengths, room)]):
            usable, many = min(left[length], room // length), 1
            while usable > 0:  # multiples in powers of two
                take = min(many, usable)
                steps.append((length, take, reach))
                reach |= (reach << (length * take)) & mask
                usable, many = usable - take, many * 2
            if reach >> room & 1:
                break
        left[seed] += 1
        total = reach.bit_length() - 1
        used = defaultdict(int)
        used[seed] = 1
        for length, take, before in reversed(steps):
            if not before >> total & 1:
                used[length] += take
                total -= length * take
        times = min(left[length] // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
            if not left[length]:
                lengths.remove(length)
        yield dict(used), times


def _pack_pool(capacity: int, names: list[str]):
    def run(table: pa.Table) -> pa.Table:
        length = table.column("length").to_numpy()
        waiting: dict[int, list[int]] = defaultdict(list)
        for i, n in enumerate(length.tolist()):
            waiting[n].append(i)
        pool = table.column("pool")[0].as_py()
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        number = pool << 40
        for used, times in fill_bins({n: len(w) for n, w in waiting.items()}, capacity):
            for _ in range(times):
                at = 0
                for n, many in used.items():
                    for _ in range(many):
                        i = waiting[n].pop()
                        sequence[i], offset[i] = number, at
                        at += n
                number += 1
        return table.select(names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
    with_ids: bool = False,
    pool_pieces: int = POOL_PIECES,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``, a row per piece.

    Pieces of one sequence lie side by side from offset 0. A document longer than
    ``capacity`` is cut, all pieces but perhaps the first whole; no other is cut. Repeated
    rows are packed as often as they occur. An empty table gives an empty table. Strings of
    special tokens inside a text are special tokens, as the vocabulary's own library reads them.
    """
    pieces = token_pieces(docs, content_of(vocabulary or vocabulary_path()), capacity, separator, with_ids)
    names = pieces.columns
    pieces = shared_table(pieces.withColumn("at", F.monotonically_increasing_id()), "token_pieces")
    pools = -(-pieces.count() // pool_pieces) or 1
    dealt = pieces.withColumn("pool", F.pmod(F.xxhash64("at"), F.lit(pools))).drop("at")
    schema = pieces.select(names).schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("pool").applyInArrow(_pack_pool(capacity, names), schema)
