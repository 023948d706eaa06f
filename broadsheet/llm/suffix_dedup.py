"""Repeated strings by bucket-pointer refinement over sampled suffixes.

A string of ``length`` bytes is removed where it also starts anywhere else. Sorting every
suffix would move the corpus several times over, so suffixes are sampled: in every window of
``length`` bytes the position with the least hash (the leftmost of equals) is its anchor. Equal
windows have equal anchors, at the same distance l from their start, so the sample loses nothing.

* Initial buckets: anchors whose next q bytes are equal, q being what all windows of an anchor share.
  Anchors alone in their bucket are done.
* Within a bucket, suffixes are told apart by a name of what follows (and goes before) up to
  the end of every window. Those with the same name repeat with all their windows, and one
  stands for them all from then on; a bucket with one name is done.
* A bucket with several names is refined: its windows are divided by l, each part shares a
  longer string, the anchors get new bucket names from it, and the next round reuses them. With parts
  of one window, bucket and name are one and the answer is exact.

Buckets are compared by counting names, never by listing pairs, and all members of one name
weigh as one after a round, so large groups of copies are no hot spots.
Names are 128-bit digests of the strings; bucket names of 64 bits only group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import release, row_key, shared_table, text_of
from broadsheet.llm.spans import without

LENGTH = 200
# Windows of an anchor in a part, round by round. The first leaves q = LENGTH - 159 bytes in common.
PARTS = (160, 40, 10, 1)
_GRAM = 8
_PLACE_BITS = 20


def _least(h: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` neighbouring values."""
    rows = -(-len(h) // window)
    padded = np.full(rows * window, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    grid = padded.reshape(rows, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: len(h) - window + 1], ahead[window - 1 : len(h)])


def anchors(data: bytes, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor, nearest, farthest)``: positions, and their distances from the starts of
    their windows. Every window of ``length`` bytes has one anchor."""
    count = len(data) - length + 1
    if count <= 0:
        return (np.empty(0, np.int64),) * 3
    words = np.ndarray((len(data) - _GRAM + 1,), "<u8", data, strides=(1,))
    block = (1 << _PLACE_BITS) - window
    place, first, last = [], [], []
    for at in range(0, count, block):
        many = min(block, count - at)
        h = words[at : at + many + window - 1] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h &= np.uint64(~((1 << _PLACE_BITS) - 1) & 0xFFFFFFFFFFFFFFFF)
        h |= np.arange(len(h), dtype=np.uint64)
        chosen = (_least(h, window) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + at
        turn = np.flatnonzero(np.diff(chosen)) + 1
        begin = np.concatenate([[0], turn])
        place.append(chosen[begin])
        first.append(begin + at)
        last.append(np.append(turn, many) - 1 + at)
    place, first, last = map(np.concatenate, (place, first, last))
    # an anchor met on both sides of a block's edge is one
    fresh = np.append(True, np.diff(place) != 0)
    last = last[np.append(np.flatnonzero(fresh)[1:] - 1, len(place) - 1)]
    place, first = place[fresh], first[fresh]
    return place, place - last, place - first


def _names(data: bytes, anchor: int, low: int, high: int, length: int) -> tuple[int, bytes]:
    """Bucket of the bytes that all windows of the part share, and name of those they cover."""
    bucket = xxhash.xxh3_64_intdigest(data[anchor - low : anchor + length - high], low)
    left = min(anchor, high)
    return bucket, xxhash.xxh3_128_digest(data[anchor - left : anchor + length - low], left)


_FIELDS = ("pos", "nearest", "farthest", "low", "bucket", "name1", "name2")
_CONTEXT = T.StructType([T.StructField(c, T.LongType()) for c in ("key1", "key2", "pos", "nearest", "farthest", "left")]).add(
    "context", T.BinaryType()
)


def _batch(part: pa.RecordBatch, owner, columns, buckets, names) -> pa.RecordBatch:
    both = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
    take = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            part.column("key1").take(take),
            part.column("key2").take(take),
            *(pa.array(c, pa.int64()) for c in columns),
            pa.array(np.array(buckets, np.uint64).view(np.int64)),
            pa.array(both[:, 0]),
            pa.array(both[:, 1]),
        ],
        names=["key1", "key2", *_FIELDS],
    )


def _schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType()) for c in ("key1", "key2", *_FIELDS)])


def _first_round(texts: DataFrame, length: int, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                owner, columns, buckets, names = [], ([], [], [], []), [], []
                for i, text in enumerate(part.column("bytes")):
                    data = text.as_py()
                    found = anchors(data, length, window)
                    owner += [i] * len(found[0])
                    for column, values in zip(columns, found, strict=False):
                        column.append(values)
                    for anchor in found[0].tolist():
                        bucket, name = _names(data, anchor, 0, window - 1, length)
                        buckets.append(bucket)
                        names.append(name)
                flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns[:3]]
                yield _batch(part, owner, [*flat, np.zeros(len(owner), np.int64)], buckets, names)

    return texts.mapInArrow(run, _schema())


def _next_round(contexts: DataFrame, length: int, part_size: int, wider: int) -> DataFrame:
    """Names of the smaller parts within ``low .. low + wider - 1`` of every row's anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                owner, columns, buckets, names = [], ([], [], [], []), [], []
                rows = zip(*(part.column(c).to_pylist() for c in ("pos", "nearest", "farthest", "low", "left", "context")), strict=True)
                for i, (pos, nearest, farthest, low, left, context) in enumerate(rows):
                    for begin in range(low, low + wider, part_size):
                        if begin > farthest or begin + part_size <= nearest:
                            continue
                        bucket, name = _names(context, left, begin, begin + part_size - 1, length)
                        owner.append(i)
                        for column, value in zip(columns, (pos, nearest, farthest, begin), strict=True):
                            column.append(value)
                        buckets.append(bucket)
                        names.append(name)
                yield _batch(part, owner, columns, buckets, names)

    return contexts.mapInArrow(run, _schema())


def _contexts(texts: DataFrame, anchors_of: DataFrame, length: int, window: int) -> DataFrame:
    """The bytes around the anchors still to be told apart."""
    wanted = anchors_of.groupBy("key1", "key2").agg(F.collect_set(F.struct("pos", "nearest", "farthest")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                rows = []
                for i, (text, found) in enumerate(zip(part.column("bytes"), part.column("found"), strict=True)):
                    data = text.as_py()
                    for f in found.as_py():
                        left = min(f["pos"], window - 1)
                        rows.append((i, f["pos"], f["nearest"], f["farthest"], left, data[f["pos"] - left : f["pos"] + length]))
                owner, *columns, context = map(list, zip(*rows, strict=True))
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key1").take(take),
                        part.column("key2").take(take),
                        *(pa.array(c, pa.int64()) for c in columns),
                        pa.array(context, pa.binary()),
                    ],
                    names=_CONTEXT.names,
                )

    joined = texts.join(wanted, ["key1", "key2"]).dropDuplicates(["key1", "key2"])
    return joined.mapInArrow(run, _CONTEXT)


def repeated_strings(docs: DataFrame, length: int = LENGTH, parts: tuple[int, ...] = PARTS) -> DataFrame:
    """``(key1, key2, start, end)``: byte spans covered by strings of ``length`` bytes that also
    start elsewhere, in the same text or another; a repeated row is another text. Spans may
    overlap. Texts shorter than ``length`` have none; null texts count as empty."""
    if parts[-1] != 1 or parts[0] + _GRAM - 1 > length or any(a % b for a, b in zip(parts, parts[1:], strict=False)):
        raise ValueError("parts must divide one another down to 1, and the first leave a common string")
    texts = docs.select(*row_key(), text_of().cast("binary").alias("bytes"))
    long_enough = texts.filter(F.length("bytes") >= length)
    named = _first_round(long_enough, length, parts[0])
    spans, contexts = None, None
    for round_, size in enumerate(parts):
        named = shared_table(named, f"suffix_names_{round_}")
        shared = named.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
        shared = shared_table(shared, "buckets")
        alive = shared_table(named.join(shared, "bucket", "left_semi"), "alive")
        release(named, shared)
        member = F.struct("key1", "key2", "pos")
        groups = alive.groupBy("bucket", "name1", "name2").agg(F.count("*").alias("n"), F.min(member).alias("first"))
        groups = shared_table(groups, "names")
        low = F.greatest("low", "nearest")
        high = F.least(F.col("low") + size - 1, F.col("farthest"))
        repeated = alive.join(groups.filter("n > 1").select("bucket", "name1", "name2"), ["bucket", "name1", "name2"])
        repeated = repeated.select(
            "key1", "key2", (F.col("pos") - high).alias("start"), (F.col("pos") - low + length).alias("end")
        )
        repeated = shared_table(repeated, "repeated_spans")
        spans = repeated if spans is None else spans.unionByName(repeated)
        if round_ + 1 == len(parts):
            return spans
        mixed = groups.groupBy("bucket").agg(F.count("*").alias("k")).filter("k > 1").select("bucket")
        firsts = groups.join(mixed, "bucket").select("bucket", "name1", "name2", "first")
        firsts = alive.join(firsts, ["bucket", "name1", "name2"]).filter(member == F.col("first"))
        firsts = shared_table(firsts.select("key1", "key2", "pos", "nearest", "farthest", "low").distinct(), "open_suffixes")
        if contexts is None:
            contexts = shared_table(_contexts(texts, firsts, length, parts[0]), "contexts")
        open_ = contexts.join(firsts.select("key1", "key2", "pos", "low"), ["key1", "key2", "pos"])
        named = _next_round(open_, length, parts[round_ + 1], size)
        release(alive, groups)
    raise AssertionError("the last part has one window")


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text)``, one row per input row:
    the texts without the bytes of repeated strings."""
    return without(docs, repeated_strings(docs, length), with_text)
