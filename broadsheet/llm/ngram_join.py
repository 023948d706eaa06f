"""Jaccard self-join on word n-grams by a size-aware heavy-light split, and its components.

A document's set holds its distinct word n-grams. Two sets of sizes n and m link when
their overlap is at least c(n, m), the smallest integer that meets the threshold.

* Small sets enumerate all their subsets of the fixed size c(n, m), once for each size m a
  partner can have. Two small sets link exactly if they share such a subset.
* Large sets go through inverted lists over a prefix of their n-grams, the rarest first, so that
  common lines and passages stand in few lists. Any one order of all n-grams loses no link; this one goes by the
  counts of all documents in a table of ``CELLS`` cells (n-grams that share a cell share a count), then by hash.
  The prefix is longer than need be, so that linked sets share not one but at least
  ``_shared`` n-grams of it. That gives three filters which lose no link: sets with too few
  listed n-grams found elsewhere leave; a set's most frequent listed n-grams leave
  (what is still common leaves its lists then); sizes must fit.
* Within a list, members meet a few leaders first (among them, in the first turn, the one whose n-grams are in
  the longest lists: the text that the others are copies of). What is linked then shares a component, and
  only pairs from different components still meet, if they meet often enough, so large groups of near copies cost a
  few comparisons a member, and a frequent n-gram costs nothing.
* A set's signature has one bit for each residue of its hashes, telling whether an odd number of n-grams has it.
  Signatures differ in no more bits than the sets differ in n-grams, so pairs whose signatures differ in too many
  are no links and leave before they are made; every other pair is checked on the whole sets.

The boundary is where enumerating subsets gets dearer than listing and checking.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from broadsheet.llm.common import components, release, shared_table, text_of

WORDS = 5
THRESHOLD = (75, 100)
# What one listed and checked n-gram costs, in enumerated subsets.
CHECK_COST = 4
# Listed beyond the least prefix: one n-gram in so many.
SLACK = 20
STAR_ROUNDS = 6
LEADERS = 6
# Cells of the table of counts, at any input size: 8 MB in the driver and each worker.
CELLS = 1 << 20
# 64-bit words of a signature.
SIGNATURE = 16


def needed(n: int, m: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Smallest overlap with which sets of ``n`` and ``m`` elements link."""
    num, den = threshold
    return -(-num * (n + m) // (num + den))


def _partners(n: int, threshold) -> range:
    num, den = threshold
    return range(-(-num * n // den), den * n // num + 1)


def subset_count(n: int, threshold=THRESHOLD) -> int:
    return sum(comb(n, needed(n, m, threshold)) for m in _partners(n, threshold))


def _extra(n: int) -> int:
    return 1 + n // SLACK


def prefix_size(n: int, threshold=THRESHOLD) -> int:
    num, den = threshold
    return min(n, n + num * n // -den + _extra(n))


def boundary(threshold=THRESHOLD, check_cost: int = CHECK_COST) -> int:
    """Largest size up to which enumerating subsets is the cheaper way."""
    n = 1
    while subset_count(n + 1, threshold) <= check_cost * (prefix_size(n + 1, threshold) + n + 1):
        n += 1
    return n


_UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Odd multipliers of the sequence hash, fixed so that all workers agree.
_STEP, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    tokens = text.encode().translate(_UPPER_TO_LOWER).split()
    if not tokens:
        return np.empty(0, np.int64)
    size = min(words, len(tokens))
    single = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    count = len(tokens) - size + 1
    found = np.full(count, size, np.uint64)
    for i in range(size):
        found ^= found >> np.uint64(29)
        found = found * _STEP + single[i : i + count]
    for _ in range(2):
        found ^= found >> np.uint64(32)
        found = found * _LAST
    found ^= found >> np.uint64(29)
    return np.unique(found.view(np.int64))


def _cells(values: np.ndarray) -> np.ndarray:
    return values & (CELLS - 1)


def _document_counts(texts: DataFrame, words: int) -> np.ndarray:
    """For each cell, how often the documents of ``texts(text)`` have an n-gram of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(total, _cells(shingle_hashes(text.as_py(), words)), 1)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "k"])

    counted = texts.mapInArrow(run, "cell int, k long").groupBy("cell").agg(F.sum("k").alias("k")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[counted.column("cell").to_numpy()] = counted.column("k").to_numpy()
    return counts


def signature(values: np.ndarray) -> np.ndarray:
    """``SIGNATURE`` words: bit ``b`` tells whether an odd number of hashes is ``b`` modulo their bits."""
    bits = (values >> 40) & (64 * SIGNATURE - 1)
    odd = np.bincount(bits, minlength=64 * SIGNATURE).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _subset_keys(values: np.ndarray, threshold, limit: int) -> list[int]:
    """Keys of the fixed-size subsets; the low two bits tell the side of a pair of sizes."""
    n = len(values)
    items = [v.tobytes() for v in values]
    keys = []
    for m in _partners(n, threshold):
        if m > limit:
            continue
        low, high = min(n, m), max(n, m)
        side = 2 if n == m else int(n == high)
        for subset in combinations(items, needed(n, m, threshold)):
            key = xxhash.xxh3_64_intdigest(b"%d,%d:" % (low, high) + b"".join(subset))
            keys.append((key & ~3 & 0xFFFFFFFFFFFFFFFF | side) - (1 << 64 if key >> 63 else 0))
    return keys


_FOUND = [
    ("n", pa.int32(), T.IntegerType()),
    ("set1", pa.int64(), T.LongType()),
    ("set2", pa.int64(), T.LongType()),
    ("prefix", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    ("subsets", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
    ("bits", pa.list_(pa.int64()), T.ArrayType(T.LongType())),
]


def _with_sets(texts: DataFrame, words: int, threshold, small: int) -> DataFrame:
    """Replaces ``text`` by the size of its set, a name of the set, its prefix, its subsets and its signature."""
    counts = texts.sparkSession.sparkContext.broadcast(_document_counts(texts.select("text"), words))
    kept = [c for c in texts.columns if c != "text"]

    def described(text: str):
        values = shingle_hashes(text, words)
        n = len(values)
        one, two = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), np.int64).tolist()
        listed = n > small or threshold[0] * (small + 1) <= threshold[1] * n
        rarest = np.lexsort((values, counts.value[_cells(values)])) if listed else []
        return (
            n,
            one,
            two,
            values[rarest[: prefix_size(n, threshold)]] if listed else values[:0],
            _subset_keys(values, threshold, small) if 0 < n <= small else [],
            signature(values) if listed else values[:0],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows = [described(t.as_py()) for t in part.column("text")]
                new = [pa.array(list(c), type=f[1]) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *new], names=[*kept, *(f[0] for f in _FOUND)]
                )

    schema = texts.select(kept).schema
    for name, _, kind in _FOUND:
        schema = schema.add(name, kind)
    return texts.mapInArrow(run, schema)


_FULL = pa.schema([("row", pa.int64()), ("n", pa.int32()), ("members", pa.list_(pa.int64()))])


def _whole_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [shingle_hashes(t.as_py(), words) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(sets, type=_FULL.field(2).type)],
                    schema=_FULL,
                )

    return run


def _shared(num: int, den: int) -> str:
    """SQL for the least number of n-grams that linked sets of ``n`` and ``m`` share in the lists:
    those their prefixes must share, less those that either left out as frequent."""

    def listed(size: str) -> str:
        return f"least({size}, {size} - ceil({num} * {size} / {den}) + 1 + {size} div {SLACK})"

    def dropped(size: str) -> str:
        return f"ceil({num} * {size} / {den}) div {SLACK}"

    overlap = f"ceil({num} * (n + m) / {num + den})"
    both = f"least({overlap} - n + {listed('n')}, {overlap} - m + {listed('m')})"
    return f"greatest(1, {both} - {dropped('n')} - {dropped('m')})"


def _live(postings: DataFrame, at_least: str) -> DataFrame:
    """Postings whose n-gram another row lists too, of rows that have enough of them."""
    lists = shared_table(postings.groupBy("tok").agg(F.count("*").alias("k")).filter("k > 1"), "lists")
    shared = shared_table(postings.join(lists, "tok"), "listed")
    release(lists)
    enough = shared.groupBy("row", "n").agg(F.count("*").alias("live")).filter(f"live >= {at_least}")
    enough = shared_table(enough.select("row", "live"), "enough")
    live = shared_table(shared.join(enough, "row"), "live")
    release(shared, enough)
    return live


def _close(n: str, m: str, bits: str, others: str, threshold) -> str:
    """SQL that holds for all linked sets: how far their signatures may differ."""
    num, den = threshold
    differ = " + ".join(f"bit_count({bits}[{i}] ^ {others}[{i}])" for i in range(SIGNATURE))
    return f"{differ} <= {n} + {m} - 2 * ceil({num} * ({n} + {m}) / {num + den})"


def _checked(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, threshold) -> DataFrame:
    """The pairs ``(a, b)`` that link, compared by signature, then on whole sets."""
    num, den = threshold
    near = (
        pairs.join(signatures.toDF("a", "n_a", "bits_a"), "a")
        .join(signatures.toDF("b", "n_b", "bits_b"), "b")
        .filter(_close("n_a", "n_b", "bits_a", "bits_b", threshold))
        .select("a", "b")
    )
    near = shared_table(near, "near_pairs")
    left = sets.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("members").alias("set_b"))
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    links = (
        near.join(left, "a")
        .join(right, "b")
        .filter(overlap * (num + den) >= (F.col("n_a") + F.col("n_b")) * num)
        .select("a", "b")
    )
    links = shared_table(links, "links")
    release(near)
    return links


def near_duplicates(
    docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, small: int | None = None
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, body)``, one row per input row.

    ``component_id`` is the smallest ``doc_id`` reachable by links, the row's own included;
    null ids count only if a component has no other. A text with fewer than ``words`` words
    is one n-gram; null or empty texts, and those of white space, have none and link with
    nothing. Repeated rows have equal sets and link. One row of each component is ``kept``, one
    with its smallest id; ``body`` is ``xxhash64`` of the text. An empty table gives an empty table.
    """
    small = boundary(threshold) if small is None else small
    num, den = threshold
    texts = docs.select("doc_id", text_of().alias("text")).select("*", F.xxhash64("text").alias("body"))
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "body", "text")
    listing = shared_table(_with_sets(numbered, words, threshold, small), "ngram_sets")
    base = shared_table(listing.select("row", "doc_id", "body", "n", "set1", "set2", "bits"), "set_names")
    classes = shared_table(
        base.filter("n > 0").groupBy("set1", "set2").agg(F.min("row").alias("rep")), "ngram_classes"
    )

    # small sets: shared subsets
    first = classes.select(F.col("rep").alias("row"))
    subsets = (
        listing.filter(f"n > 0 and n <= {small}")
        .join(first, "row", "left_semi")
        .select("row", F.explode("subsets").alias("s"))
        .select("row", F.shiftright("s", 2).alias("subset"), F.col("s").bitwiseAND(3).alias("side"))
    )
    ends = shared_table(
        subsets.groupBy("subset")
        .agg(*[F.min(F.when(F.col("side") == i, F.col("row"))).alias(f"side{i}") for i in range(3)], F.count("*").alias("k"))
        .filter("k > 1"),
        "subsets",
    )
    other = F.when(F.col("side") == 0, F.col("side1")).when(F.col("side") == 1, F.col("side0")).otherwise(F.col("side2"))
    edges = subsets.join(ends, "subset").select(F.col("row").alias("a"), other.alias("b")).filter("a != b").distinct()
    edges = shared_table(edges, "small_links")

    # large sets: inverted lists, of rows with enough listed n-grams in common with others
    least = f"1 + ceil({num} * n / {den}) div {SLACK}"
    found = _live(listing.select("row", "n", F.explode("prefix").alias("tok")), least)
    release(listing)
    reps = shared_table(found.select("row", "n", "tok").join(first, "row", "left_semi"), "listed_sets")
    release(found)
    live = _live(reps, least)
    own = Window.partitionBy("row")
    rare = F.row_number().over(own.orderBy("k", "tok"))
    # the text that others are copies of has its n-grams in the longest lists
    listed = shared_table(
        live.select("row", "n", "tok", "live", rare.alias("rank"), F.avg("k").over(own).alias("central"))
        .filter(f"rank <= live - ({least}) + 1")
        .select("row", "n", "tok", "central"),
        "rare_listed",
    )
    release(reps, live)
    chosen = listed.select("row").distinct().join(base.select("row", F.col("doc_id").alias("id"), F.col("body").alias("b")), "row")
    sets = (
        texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("b")))
        .select("row", "text")
        .mapInArrow(_whole_sets(words), "row long, n int, members array<long>")
    )
    sets = shared_table(sets, "whole_sets")
    signatures = shared_table(base.join(listed.select("row").distinct(), "row", "left_semi").select("row", "n", "bits"), "signatures")

    labels, before = None, None
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            grouped = listed.withColumn("label", F.col("row"))
        else:
            grouped = listed.join(labels.withColumnRenamed("node", "row"), "row", "left")
            grouped = grouped.withColumn("label", F.coalesce("label", "row"))
        draws = [F.xxhash64(F.lit(turn * LEADERS + i), "row").cast("double") for i in range(LEADERS)]
        if turn == 0:
            draws[0] = -F.col("central")
        heads = [F.min(F.struct(draw.alias("draw"), "row", "n", "label")) for draw in draws]
        lists = grouped.groupBy("tok").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("k"), F.array(*heads).alias("heads")
        )
        lists = shared_table(lists.filter("low != high"), "open_lists")
        size = lists.agg(F.count("*"), F.sum("k"), F.sum(F.col("k") * F.col("k"))).first()
        if not size[0]:
            break
        fits = f"n * {den} >= m * {num} and m * {den} >= n * {num}"
        # leaders help as long as the pairs left get fewer
        few = size[2] <= 4 * size[1] or size[2] > 0.7 * (before or float("inf"))
        last = turn == STAR_ROUNDS or (turn > 0 and few)
        before = size[2]
        if last:  # all that is left: pairs from different components
            open_rows = grouped.join(lists.select("tok"), "tok").join(signatures.select("row", "bits"), "row")
            mates = open_rows.select(
                "tok", F.col("row").alias("b"), F.col("n").alias("m"), F.col("label").alias("label_b"), F.col("bits").alias("bits_b")
            )
            close = _close("n", "m", "bits", "bits_b", threshold)
            pairs = open_rows.join(mates, "tok").filter(f"row < b and label != label_b and {fits} and {close}")
            pairs = pairs.groupBy("row", "n", "b", "m").agg(F.count("*").alias("met")).filter(f"met >= {_shared(num, den)}")
        else:
            pairs = (
                grouped.join(lists.select("tok", F.array_distinct("heads").alias("heads")), "tok")
                .select("row", "n", "label", F.explode("heads").alias("head"))
                .select("row", "n", "label", F.col("head.row").alias("b"), F.col("head.n").alias("m"), F.col("head.label").alias("label_b"))
                .filter(f"row != b and label != label_b and {fits}")
            )
        pairs = shared_table(pairs.select(F.col("row").alias("a"), "b").distinct(), "meeting")
        found = _checked(pairs, signatures, sets, threshold)
        release(lists, pairs)
        edges = edges.unionByName(found)
        if found.isEmpty():
            if last:
                break
            continue
        labels = shared_table(components(edges), "labels")
        if last:
            break
    if labels is None:
        labels = shared_table(components(edges), "labels")

    placed = shared_table(
        base.select("row", "doc_id", "body", "n", "set1", "set2")
        .join(classes, ["set1", "set2"], "left")
        .withColumn("node", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("row"))),
        "placed",
    )
    placed = placed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = shared_table(placed.select("row", "doc_id", "body", "n", "label"), "labelled")
    first_id = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    smallest = shared_table(placed.groupBy("label").agg(first_id.alias("least")), "component_ids")
    return placed.join(smallest, "label").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("kept"),
        "body",
    )
