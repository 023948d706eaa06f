"""Hard negatives by inner product, with length buckets and coordinate pruning.

Rows are sorted by label and falling length and cut into buckets. A bucket keeps, per
coordinate, its unit vectors' values in order. An anchor that looks for inner products of
``theta`` or more needs rows at a cosine of ``theta / (its length * the bucket's longest)``:
beyond 1 the bucket is left out; otherwise that cosine bounds each coordinate of the row to a
range around the anchor's own. The ranges of the anchor's largest (*focus*) coordinates are
found in the sorted lists and intersected; what is left is verified by exact products.

Anchors are searched in blocks, against buckets dealt to shards: a task sees one block and a
few buckets, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.llm.common import shared_table

BUCKET_ROWS, SHARD_ROWS, BLOCK_ANCHORS = 4096, 4096, 4096
# A bucket's shortest vector has at least this share of the length of its longest.
SAME_LENGTH = 0.9
FOCUS = 8
# If the narrowest range still holds this share of a bucket, all of it is verified at once.
WIDE = 0.3
# Widens cosines and ranges, against rounding of unit vectors.
SLACK = 1e-9

_LONG = np.iinfo(np.int64)


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Lists of numbers as rows, shorter ones followed by zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), int(sizes.max(initial=0))))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _lengths(values: np.ndarray) -> np.ndarray:
    """Euclidean lengths, also where squares would overflow."""
    largest = np.abs(values).max(axis=1, initial=0)
    scale = np.where(largest > 0, largest, 1)
    return scale * np.sqrt(((values / scale[:, None]) ** 2).sum(axis=1))


def products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: as doubles if none can need over 53 bits."""
    wide = max(rows.shape[1], others.shape[1])
    left, right = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (rows, others))
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * wide < 2.0**53:
        return left @ right.T
    whole = [np.array([[int(v) for v in r] for r in x], object).reshape(x.shape) for x in (left, right)]
    return whole[0] @ whole[1].T


class Bucket:
    """Rows of one label and similar lengths, by id, and the sorted list of each coordinate."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, order: np.ndarray | None = None):
        self.ids, self.values = ids, values
        lengths = _lengths(values)
        self.longest = float(lengths.max(initial=0))
        self.unit = values / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable").T.astype("<u2") if order is None else order
        self.lists = np.take_along_axis(self.unit.T, self.order.astype(np.int64), axis=1)

    def search(self, values: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(anchor, rows, products)``: all rows at a product of ``least`` or more, among others."""
        lengths = _lengths(values)
        reach = lengths * self.longest
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(least > 0, least / reach - SLACK, -1.0)
        open_ = np.flatnonzero(~(cosine > 1))
        if not len(open_) or not len(self.ids):
            return
        narrow: dict[int, np.ndarray] = {}
        pruned = open_[cosine[open_] > 0]
        if len(pruned) and values.shape[1] and self.values.shape[1]:
            narrow = dict(self._ranges(pruned, values[pruned] / lengths[pruned, None], cosine[pruned]))
        whole = np.array([i for i in open_.tolist() if i not in narrow], np.int64)
        everyone = np.arange(len(self.ids))
        for at in range(0, len(whole), 256):
            part = whole[at : at + 256]
            for i, scores in zip(part.tolist(), products(values[part], self.values), strict=True):
                yield i, everyone, scores
        for i, rows in narrow.items():
            yield i, rows, products(values[i : i + 1], self.values[rows])[0]

    def _ranges(self, which: np.ndarray, unit: np.ndarray, cosine: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Rows in all feasible ranges, for anchors with a narrow one."""
        shared = min(unit.shape[1], self.unit.shape[1])
        focus = np.argsort(-np.abs(unit[:, :shared]), axis=1)[:, :FOCUS]
        own, t = np.take_along_axis(unit, focus, axis=1), cosine[:, None]
        middle, half = own * t, np.sqrt(np.maximum(0, 1 - own**2) * np.maximum(0, 1 - t**2))
        low = np.where(own <= -t, -1.0, middle - half) - SLACK
        high = np.where(own >= t, 1.0, middle + half) + SLACK
        first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(self.lists[f], low[at], "left")
            last[at] = np.searchsorted(self.lists[f], high[at], "right")
        narrowest = (last - first).argmin(axis=1)
        for i, j in enumerate(narrowest.tolist()):
            if last[i, j] - first[i, j] > WIDE * len(self.ids):
                continue
            rows = self.order[focus[i, j], first[i, j] : last[i, j]].astype(np.int64)
            for k in range(focus.shape[1]):
                if k != j and len(rows):
                    value = self.unit[rows, focus[i, k]]
                    rows = rows[(value >= low[i, k]) & (value <= high[i, k])]
            yield int(which[i]), np.sort(rows)


def _best(scores: np.ndarray, rows: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores and their rows, ties in the rows' order."""
    if len(scores) > 4 * many:
        keep = scores >= np.partition(scores, len(scores) - many)[len(scores) - many]
        scores, rows = scores[keep], rows[keep]
    first = np.argsort(-scores, kind="stable")[:many]
    return scores[first], rows[first]


def _joined(kept: tuple, scores: np.ndarray, ids: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges two best lists, ties by id."""
    scores, ids = np.concatenate([kept[0], scores]), np.concatenate([kept[1], ids])
    order = np.lexsort((ids, -scores))[:many]
    return scores[order], ids[order]


def _long(value) -> int:
    return max(_LONG.min, min(_LONG.max, int(value)))


_INDEX = (
    "bucket long, label long, n long, longest double, ids binary, width long, kind string, vals binary, lists binary, "
    "vec_id long, vector array<double>, seed double"
)


def _buckets(positives: int):
    """Rows of two kinds: buckets, and (``vec_id`` set) the anchors among their rows, with the
    score of the last positive in their own bucket."""
    schema = pa.schema(
        [("bucket", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()),
         ("width", pa.int64()), ("kind", pa.string()), ("vals", pa.binary()), ("lists", pa.binary()),
         ("vec_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("seed", pa.float64())]
    )

    def finished(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks().sort_by("vec_id")
        ids, label = table.column("vec_id").to_numpy(), table.column("label")[0].as_py()
        values = _matrix(table.column("vector").combine_chunks())
        one = Bucket(ids, values)
        kind = "<i2" if np.abs(values).max(initial=0) < 2**15 else "<f8"
        out = [
            dict(bucket=int(ids[0]), label=label, n=len(ids), longest=one.longest, ids=ids.astype("<i8").tobytes(), width=values.shape[1],
                 kind=kind, vals=values.astype(kind).tobytes(), lists=one.order.tobytes())
        ]
        anchors = np.flatnonzero(table.column("anchor").to_numpy())
        for at in range(0, len(anchors), 256):
            for i, scores in zip(anchors[at : at + 256].tolist(), products(values[anchors[at : at + 256]], values), strict=True):
                others = np.delete(scores, i)
                seed = float(_best(others, others, positives)[0][-1]) if len(others) >= positives else None
                out.append(dict(label=label, vec_id=int(ids[i]), vector=values[i].tolist(), seed=seed))
        return pa.RecordBatch.from_pylist(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, label, longest = [], 0, None, 0.0
        for batch in batches:
            labels, lengths = batch.column("label").to_numpy(), batch.column("len").to_numpy()
            at = 0
            while at < batch.num_rows:
                if rows and (labels[at] != label or lengths[at] < SAME_LENGTH * longest or rows >= BUCKET_ROWS):
                    yield finished(held)
                    held, rows = [], 0
                if not rows:
                    label, longest = labels[at], lengths[at]
                fits = (labels[at:] == label) & (lengths[at:] >= SAME_LENGTH * longest)
                end = at + min(BUCKET_ROWS - rows, len(fits) if fits.all() else int(fits.argmin()))
                held.append(batch.slice(at, end - at))
                rows, at = rows + end - at, end
        if rows:
            yield finished(held)

    return run


def _restored(row: dict) -> Bucket:
    n, width = row["n"], row["width"]
    values = np.frombuffer(row["vals"], row["kind"]).reshape(n, width).astype(np.float64)
    return Bucket(np.frombuffer(row["ids"], "<i8"), values, np.frombuffer(row["lists"], "<u2").reshape(width, n))


def _group(buckets: pa.Table, blocks: pa.Table):
    """Buckets by falling length, and the block's anchors as a table with their matrix."""
    anchors = pa.Table.from_struct_array(blocks.column("anchors").combine_chunks().flatten())
    rows = sorted(buckets.drop_columns(["shard", "block"]).to_pylist(), key=lambda r: -r["longest"])
    return [(r["label"], _restored(r)) for r in rows], anchors, _matrix(anchors.column("vector").combine_chunks())


_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_NEGATIVES = _POSITIVES + ", negative_id long, negative_score long"


def _find_positives(many: int):
    def run(buckets: pa.Table, blocks: pa.Table) -> pa.Table:
        found, anchors, values = _group(buckets, blocks)
        ids, labels = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
        # rounded down, as a seed of over 53 bits may have been rounded
        least = np.nan_to_num(np.nextafter(anchors.column("seed").to_numpy(), -np.inf), nan=-np.inf)
        kept = {}
        for label, bucket in found:
            own = np.flatnonzero(labels == label)
            for i, rows, scores in bucket.search(values[own], least[own]):
                i = own[i]
                others = bucket.ids[rows] != ids[i]
                scores, rows = _best(scores[others], rows[others], many)
                kept[i] = scores, near = _joined(kept.get(i, _NO), scores, bucket.ids[rows], many)
                if len(near) == many:
                    least[i] = max(least[i], np.nextafter(float(scores[-1]), -np.inf))
        lines = [(ids[i], p, _long(s)) for i, (scores, near) in kept.items() for s, p in zip(scores, near, strict=True)]
        return _table(lines, ("anchor_id", "positive_id", "positive_score"))

    return run


_NO = np.zeros(0), np.zeros(0, np.int64)


def _table(lines: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*lines, strict=True) if lines else [()] * len(names)
    return pa.table({n: pa.array([int(v) for v in c], pa.int64()) for n, c in zip(names, columns, strict=True)})


def _find_negatives(many: int, low: int, high: int):
    def run(buckets: pa.Table, blocks: pa.Table) -> pa.Table:
        found, anchors, values = _group(buckets, blocks)
        ids, labels = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
        positives = [[(p["positive_id"], p["positive_score"]) for p in own] for own in anchors.column("positives").to_pylist()]
        # an integer n has low * p <= 100 * n <= high * p
        windows = [[(-(-low * score // 100), high * score // 100) for _, score in own] for own in positives]
        floor = [[lo for lo, _ in own] for own in windows]
        kept = [[_NO] * len(own) for own in windows]
        least = np.array([min((lo for lo, hi in own if lo <= hi), default=np.inf) for own in windows], np.float64)
        for label, bucket in found:
            other = np.flatnonzero((labels != label) & (least < np.inf))
            for i, rows, scores in bucket.search(values[other], np.nextafter(least[other], -np.inf)):
                i = other[i]
                for k, (_, hi) in enumerate(windows[i]):
                    inside = (scores >= floor[i][k]) & (scores <= hi)
                    if inside.any():
                        best, near = _best(scores[inside], rows[inside], many)
                        kept[i][k] = _joined(kept[i][k], best, bucket.ids[near], many)
                        if len(kept[i][k][0]) == many:  # ties with the last are still wanted
                            floor[i][k] = max(floor[i][k], int(kept[i][k][0][-1]))
                least[i] = min((f for f, (lo, hi) in zip(floor[i], windows[i], strict=True) if lo <= hi), default=np.inf)
        lines = [
            (ids[i], p, score, near, _long(s))
            for i, own in enumerate(kept)
            for (p, score), (scores, nears) in zip(positives[i], own, strict=True)
            for s, near in zip(scores, nears, strict=True)
        ]
        return _table(lines, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    return run


def _quantised(vector: Column, scale: int) -> Column:
    """Whole numbers, kept as doubles: they may be beyond 64 bits."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    # floor() of a double is a 64-bit integer; doubles beyond 2^53 are whole already
    return F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from
    ``rows(vec_id, embedding, label)``.

    Components become ``floor(scale * x)``; a score is the exact inner product of two rows.
    Higher scores come first, ties by smaller ``vec_id``. The rows of ``is_anchor`` are searched
    against all: an anchor's positives are its first other rows of its label; its negatives for
    a positive the first rows of other labels whose score is between ``low`` and ``high``
    percent of the positive's.

    Rows with a null id, label, vector or component or a component that is not finite take no
    part. A shorter vector counts as followed by zeros. Of rows with one ``vec_id`` the first by
    label and vector counts, so repeated rows count once. Scores beyond 64 bits are compared
    exactly and returned as the nearest 64-bit number. An empty table gives an empty table.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    one = rows.filter(F.when(sound, finite).otherwise(False)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.struct(F.col("label").cast("long").alias("label"), F.col("embedding").alias("raw"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")).alias("row"),
    )
    one = one.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.anchor", _quantised(F.col("row.raw"), scale).alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    dealt = one.withColumn("len", F.sqrt(squares)).repartitionByRange("label", F.desc("len"), "vec_id")
    ordered = dealt.sortWithinPartitions("label", F.desc("len"), "vec_id").select("vec_id", "label", "anchor", "vector", "len")
    index = shared_table(ordered.mapInArrow(_buckets(positives), _INDEX), "length_buckets")
    buckets = index.filter(F.col("bucket").isNotNull()).select("bucket", "label", "n", "longest", "ids", "width", "kind", "vals", "lists")
    anchors = index.filter(F.col("vec_id").isNotNull()).select("vec_id", "label", "vector", "seed")
    # by rows: small buckets, of rare lengths or at the ends of partitions, share a shard
    shards = -(-(buckets.agg(F.sum("n")).first()[0] or 0) // SHARD_ROWS) or 1
    blocks = -(-anchors.count() // BLOCK_ANCHORS) or 1

    def searched(block_of: DataFrame, find, schema: str) -> DataFrame:
        """Each block of anchors with each shard of buckets, in a task of its own."""
        packed = block_of.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).agg(
            F.collect_list(F.struct(*block_of.columns)).alias("anchors")
        )
        offered = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        spread = buckets.withColumn("shard", F.pmod(F.xxhash64("bucket"), F.lit(shards)).cast("long")).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        )
        key = ["shard", "block"]
        offered = offered.withColumn("block", F.col("block").cast("long"))
        return spread.groupBy(*key).cogroup(offered.groupBy(*key)).applyInArrow(_either(find, schema), schema)

    def first(found: DataFrame, many: int, score: str, near: str, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc(score), near)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= many)

    own = first(searched(anchors, _find_positives(positives), _POSITIVES), positives, "positive_score", "positive_id", "anchor_id")
    lists = own.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    wanted = anchors.drop("seed").join(shared_table(lists, "positives"), "vec_id")
    pairs = searched(wanted, _find_negatives(negatives, low, high), _NEGATIVES)
    found = first(pairs, negatives, "negative_score", "negative_id", "anchor_id", "positive_id")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _either(find, schema: str):
    """A shard without buckets, or a block without anchors, finds nothing."""
    names = tuple(f.split()[0] for f in schema.split(", "))

    def run(buckets: pa.Table, blocks: pa.Table) -> pa.Table:
        return find(buckets, blocks) if buckets.num_rows and blocks.num_rows else _table([], names)

    return run
