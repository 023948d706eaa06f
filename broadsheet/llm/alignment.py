"""Which tokens of two vocabularies cover the same bytes, and how often in the corpus.

1. Every document is encoded twice and aligned; its ids are stored, and every task adds, per
   bucket of A ids, the distinct id pairs it met and in how many documents.
2. The buckets' distinct pairs are merged in a tree and get a minimal perfect hash: pairs
   alone in their cell of a bit array take it, the others go on to the next, smaller array;
   a pair's number is the rank of its bit.
3. The tasks' counts become dense vectors indexed by that hash and are summed in a tree.
4. The stored ids are aligned again; each link looks its pair up, checks the stored key and
   reads the count. Hashes and counts are broadcast in slabs of at most ``SLAB_BYTES``
   (or one bucket), with a pass over the stored ids for each slab.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from broadsheet.llm.common import shared_table, text_of
from broadsheet.llm.vocabularies import byte_level, content_of, pieces, vocabulary_path

# Pairs are dealt to buckets by their A id.
BUCKETS = 256
# Broadcast at once: hash, keys and counts of so many bytes, some 17 a pair.
SLAB_BYTES = 64 << 20
# Text aligned at once in a task, and distinct pairs that a task holds before it writes them.
CHUNK_BYTES, HELD_PAIRS = 1 << 20, 1 << 20
# Rows merged by a node of the trees.
FAN_IN = 16

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well mixed bits of each key."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _MIX[0] * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers ``0 .. n - 1`` of ``n`` distinct keys, by bit arrays of twice the keys left."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes, self.bits, self.levels = sizes, bits, []
        at = base = 0
        for size in sizes:
            cells = np.frombuffer(bits, np.uint8, -(-size // 8), at)
            before = np.concatenate([[0], np.cumsum(_ONES[cells], dtype=np.int64)]) + base
            self.levels.append((size, cells, before))
            at, base = at + len(cells), int(before[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, bits, left = [], [], keys
        while len(left):
            size = max(8, 2 * len(left))
            cell = mixed(left, len(sizes)) % np.uint64(size)
            alone = np.bincount(cell.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little").tobytes())
            left = left[~alone[cell.astype(np.int64)]]
        return cls(sizes, b"".join(bits))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 for some of the keys that it was not built of."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, cells, before) in enumerate(self.levels):
            if not len(open_):
                break
            cell = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            byte = cells[cell >> 3]
            has = (byte >> (cell & 7).astype(np.uint8)) & 1 == 1
            below = _ONES[byte & ((1 << (cell & 7)) - 1).astype(np.uint8)]
            found[open_[has]] = (before[cell >> 3] + below)[has]
            open_ = open_[~has]
        return found


class Aligned:
    """Tokens of documents side by side: ``a`` and ``b`` cover the same bytes.

    A *segment* ends where a token of either side ends; it lies in one token of each, and no
    two segments lie in the same two, so segments are the links.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray):
        ends_a, ends_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
        mark = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        self.ends = np.flatnonzero(mark)
        kind = mark[self.ends]
        self.is_a, self.is_b, self.shared = kind & 1 == 1, kind >> 1 == 1, kind == 3
        self.through_a, self.through_b = np.cumsum(self.is_a), np.cumsum(self.is_b)
        self.a, self.b = a, b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The two ids of each segment."""
        return self.a[self.through_a - self.is_a], self.b[self.through_b - self.is_b]

    def written(self, count_a: int, count_b: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens in the order in which groups are written, as indices into ``_written_tokens``,
        and how many are written up to each shared end."""
        group = np.cumsum(self.shared) - self.shared
        last_a, last_b = self.through_a[self.shared], self.through_b[self.shared]
        out = np.empty(len(self.a) + len(self.b), np.int64)
        seg_a, seg_b = np.flatnonzero(self.is_a), np.flatnonzero(self.is_b)
        before_b = np.concatenate([[0], last_b])[group[seg_a]]
        out[np.arange(len(self.a)) + before_b] = self.a + np.where(self.shared[seg_a], count_a, 0)
        out[np.arange(len(self.b)) + last_a[group[seg_b]]] = 2 * count_a + self.b + np.where(self.shared[seg_b], count_b, 0)
        return out, last_a + last_b


def _written_tokens(count_a: int, count_b: int) -> list[bytes]:
    """A ids followed by a comma, by a bar; B ids followed by a comma, by a semicolon."""
    return [b"%d%s" % (i, end) for n, ends in ((count_a, b",|"), (count_b, b",;")) for end in (ends[:1], ends[1:]) for i in range(n)]


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``CHUNK_BYTES``, or of one larger row."""
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CHUNK_BYTES, "right")))
        yield at, end
        at = end


class _Held:
    """Distinct pairs of a task and the number of documents that have them linked."""

    def __init__(self):
        self.codes, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.size = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes.append(codes)
        self.counts.append(counts)
        self.size += len(codes)
        if self.size > HELD_PAIRS:
            self.merge()

    def merge(self) -> None:
        codes, counts = _summed(np.concatenate(self.codes), np.concatenate(self.counts))
        self.codes, self.counts, self.size = [codes], [counts], len(codes)


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(codes, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, counts)
    return distinct, total


def _bucket_of(codes: np.ndarray, count_b: int) -> np.ndarray:
    return (mixed(codes // np.uint64(count_b), 1_000) % np.uint64(BUCKETS)).astype(np.int64)


def _by_bucket(codes: np.ndarray, count_b: int) -> list[tuple[int, np.ndarray]]:
    """Buckets met, and where their codes are."""
    bucket = _bucket_of(codes, count_b)
    order = np.argsort(bucket, kind="stable")
    present, starts = np.unique(bucket[order], return_index=True)
    return list(zip(present.tolist(), np.split(order, starts[1:]), strict=True)) if len(codes) else []


_STORED = "doc_id {}, at long, n_bytes long, a binary, b binary, bucket int, part long, codes binary, counts binary"


def _encode(contents, id_type: pa.DataType):
    """Rows of two kinds: a document's ids, and (``bucket`` set) a task's pairs of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, encode_b = byte_level(contents.value[0], True), pieces(contents.value[1])
        sizes_a, sizes_b = encode_a.lengths, encode_b.lengths
        kind_a, kind_b = _stored_as(len(sizes_a)), _stored_as(len(sizes_b))
        names = ["doc_id", "at", "n_bytes", "a", "b", "bucket", "part", "codes", "counts"]
        types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        part = TaskContext.get().partitionId()
        held = _Held()

        def pairs() -> pa.RecordBatch:
            held.merge()
            codes, counts = held.codes[0], held.counts[0]
            own = _by_bucket(codes, len(sizes_b))
            n = len(own)
            columns = [[None] * n] * 5 + [[k for k, _ in own], [part] * n]
            columns += [[x[o].tobytes() for _, o in own] for x in (codes, counts)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        row = part << 33
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for start, end in _chunks(sizes):
                a, b, ok = [], [], []
                for text in texts.slice(start, end - start).to_pylist():
                    ids_a, ids_b = (encode_a(" " + text), encode_b(text)) if text else (_NONE, _NONE)
                    # neither vocabulary loses bytes, but pieces read one character as a space
                    good = len(ids_a) > 0 and sizes_a[ids_a].sum() == sizes_b[ids_b].sum()
                    a.append(ids_a if good else _NONE)
                    b.append(ids_b if good else _NONE)
                    ok.append(good)
                both = Aligned(np.concatenate([_NONE, *a]), np.concatenate([_NONE, *b]), sizes_a, sizes_b)
                if len(both.a):
                    covered = np.where(ok, sizes[start:end] + 1, 0)
                    owner = np.searchsorted(np.cumsum(covered), both.ends, "left").astype(np.uint64)
                    left, right = both.links()
                    span = np.uint64(len(sizes_a) * len(sizes_b))
                    code = left.astype(np.uint64) * np.uint64(len(sizes_b)) + right
                    once = np.unique(owner * span + code)
                    held.add(*np.unique(once % span, return_counts=True))
                n = end - start
                nothing = [None] * n
                columns = [np.arange(row, row + n), np.where(ok, sizes[start:end] + 1, 0), [x.astype(kind_a).tobytes() for x in a], [x.astype(kind_b).tobytes() for x in b]]
                columns += [nothing] * 4
                arrays = [pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, n), *arrays], names=names)
                row += n
                if held.size > HELD_PAIRS // 2:
                    yield pairs()
                    held = _Held()
        yield pairs()

    return run


_NONE = np.zeros(0, "<u4")


def _stored_as(count: int) -> str:
    """The type that ids of a vocabulary are stored in."""
    return "<u2" if count <= 1 << 16 else "<u4"


def _merged_keys(table: pa.Table) -> pa.Table:
    codes = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("codes").to_pylist()]))
    return pa.table({"bucket": table.column("bucket")[:1], "part": table.column("part")[:1], "codes": pa.array([codes.tobytes()], pa.binary())})


def _numbered(table: pa.Table) -> pa.Table:
    """A bucket's hash, and its keys in the order of their numbers."""
    codes = np.frombuffer(table.column("codes")[0].as_py(), np.uint64)
    number = PerfectHash.of(codes)
    keys = np.empty_like(codes)
    keys[number(codes)] = codes
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "n": pa.array([len(codes)], pa.int64()),
            "sizes": pa.array([number.sizes], pa.list_(pa.int64())),
            "bits": pa.array([number.bits], pa.binary()),
            "keys": pa.array([keys.tobytes()], pa.binary()),
        }
    )


def _dense(rows: pa.Table, index: pa.Table) -> pa.Table:
    """Counts of some tasks as one vector over a bucket's numbers."""
    number = PerfectHash(index.column("sizes")[0].as_py(), index.column("bits")[0].as_py())
    total = np.zeros(index.column("n")[0].as_py(), np.int64)
    for codes, counts in zip(rows.column("codes").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        total[number(np.frombuffer(codes, np.uint64))] += np.frombuffer(counts, np.int64)
    return _vector(rows, total)


def _vector(rows: pa.Table, total: np.ndarray) -> pa.Table:
    return pa.table({"bucket": rows.column("bucket")[:1], "part": rows.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def _added(table: pa.Table) -> pa.Table:
    return _vector(table, np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0, dtype=np.int64))


def _tree(rows: DataFrame, parts: int, merge, schema: str) -> DataFrame:
    """Merges rows ``(bucket, part)`` with ``part`` below ``parts``, some at a time, until a bucket has one."""
    while parts > 1:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("bucket", "part").applyInArrow(merge, schema)
        parts = -(-parts // FAN_IN)
    return rows


def _looked_up(slab, count_a: int, count_b: int, sizes_of, first: bool):
    """Realigns stored ids and reads the counts of the pairs in this slab of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {
            r["bucket"]: (PerfectHash(r["sizes"], r["bits"]), np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["counts"], np.int64))
            for r in slab.value
        }
        highest = np.zeros(count_a, np.int64)
        for _, keys, counts in index.values():
            np.maximum.at(highest, (keys // np.uint64(count_b)).astype(np.int64), counts)
        sizes_a, sizes_b = sizes_of.value
        written = _written_tokens(count_a, count_b) if first else []
        for batch in batches:
            covered_all = batch.column("n_bytes").to_numpy()
            for start, end in _chunks(covered_all):
                a, b = (
                    [np.frombuffer(x, _stored_as(count)) for x in batch.column(c).slice(start, end - start).to_pylist()]
                    for c, count in (("a", count_a), ("b", count_b))
                )
                both = Aligned(np.concatenate([_NONE, *a]), np.concatenate([_NONE, *b]), sizes_a, sizes_b)
                n, covered = end - start, covered_all[start:end]
                stop = np.searchsorted(both.ends, np.cumsum(covered), "right")
                begin = np.concatenate([[0], stop[:-1]])
                left, right = both.links()
                codes, at = np.unique(left.astype(np.uint64) * np.uint64(count_b) + right, return_inverse=True)
                count, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
                for bucket, own in _by_bucket(codes, count_b):
                    if bucket in index:
                        number, keys, counts = index[bucket]
                        mine = codes[own]
                        slot = number(mine)
                        if (slot < 0).any() or (keys[slot] != mine).any():
                            raise RuntimeError("a pair of the second pass was not met in the first")
                        count[own] = counts[slot]
                        best[own] = counts[slot] == highest[(mine // np.uint64(count_b)).astype(np.int64)]

                def per_document(values: np.ndarray) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                    return total[stop] - total[begin]

                columns = [per_document(best[at]), per_document(count[at])]
                names = ["n_best", "count_sum"]
                if first:
                    tokens, through = both.written(count_a, count_b)
                    groups = per_document(both.shared)
                    last = np.concatenate([[0], through])[np.cumsum(groups)].tolist()
                    digests, from_ = [], 0
                    for to, some in zip(last, groups.tolist(), strict=True):
                        line = b"".join(map(written.__getitem__, tokens[from_:to].tolist()))
                        digests.append(hashlib.sha256(line[:-1]).hexdigest() if some else "")
                        from_ = to
                    columns += [np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64), groups, stop - begin]
                    columns.append(pa.array(digests, pa.string()))
                    names += ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
                arrays = [c if isinstance(c, pa.Array) else pa.array(np.asarray(c, np.int64)) for c in columns]
                keep = [batch.column(c).slice(start, n) for c in (["doc_id", "at"] if first else ["at"])]
                yield pa.RecordBatch.from_arrays([*keep, *arrays], names=[*(["doc_id", "at"] if first else ["at"]), *names])

    return run


_COUNTS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def align(
    docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None, slab_bytes: int = SLAB_BYTES
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    ``vocabulary_a`` is a byte-level BPE file, ``vocabulary_b`` a sentence-piece BPE file that
    adds a space. Byte ends that both tokenizations share cut a document into groups; a link is
    a pair of tokens that overlap; its count is the number of rows that have the two ids linked.
    ``n_best`` counts the links whose count is the highest of their A id, ties included.

    Null and empty texts, and texts whose ids do not give their bytes back, have zeros and an
    empty digest. Repeated rows are documents of their own. Ids may be null or repeated; other
    columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    contents = (
        content_of(vocabulary_a or vocabulary_path()),
        content_of(vocabulary_b or vocabulary_path("piece_bpe_32k.model")),
    )
    sizes = byte_level(contents[0], True).lengths, pieces(contents[1]).lengths
    count_a, count_b = map(len, sizes)
    files, lengths = spark.sparkContext.broadcast(contents), spark.sparkContext.broadcast(sizes)
    id_field = docs.schema["doc_id"]
    arrow_id = _arrow_type(docs)
    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(
        _encode(files, arrow_id), _STORED.format(id_field.dataType.simpleString())
    )
    stored = shared_table(rows, "aligned_ids")
    sparse = stored.filter(F.col("bucket").isNotNull()).select("bucket", "part", "codes", "counts")
    parts = (sparse.agg(F.max("part")).first()[0] or 0) + 1
    # several rows of one task, if any, meet at the first node
    keys = sparse.select("bucket", "part", "codes")
    keys = _tree(keys, max(parts, 2), _merged_keys, "bucket int, part long, codes binary")
    index = shared_table(
        keys.groupBy("bucket").applyInArrow(_numbered, "bucket int, n long, sizes array<long>, bits binary, keys binary"),
        "pair_numbers",
    )
    nodes = -(-parts // FAN_IN)
    grouped = sparse.withColumn("part", F.floor(F.col("part") / FAN_IN))
    offered = index.drop("keys").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))))
    # nodes without rows of a bucket are left out
    offered = offered.join(grouped.select("bucket", "part").distinct(), ["bucket", "part"], "left_semi")
    vector = "bucket int, part long, counts binary"
    dense = grouped.groupBy("bucket", "part").cogroup(offered.groupBy("bucket", "part")).applyInArrow(_dense, vector)
    summed = _tree(dense, nodes, _added, vector).select("bucket", "counts")
    table = shared_table(index.join(summed, "bucket"), "pair_counts")

    texts = stored.filter(F.col("bucket").isNull()).select("doc_id", "at", "n_bytes", "a", "b")
    slabs: list[list[int]] = [[]]
    room = slab_bytes
    for r in table.select("bucket", "n").orderBy("bucket").collect():  # at most BUCKETS rows
        if slabs[-1] and 17 * r.n > room:
            slabs.append([])
            room = slab_bytes
        slabs[-1].append(r.bucket)
        room -= 17 * r.n
    found = None
    for i, buckets in enumerate(slabs):
        slab = spark.sparkContext.broadcast([r.asDict() for r in table.filter(F.col("bucket").isin(buckets)).collect()])
        schema = T.StructType([id_field, T.StructField("at", T.LongType())]) if not i else T.StructType([T.StructField("at", T.LongType())])
        for name in ["n_best", "count_sum", *(["n_a", "n_b", "n_groups", "n_links"] if not i else [])]:
            schema = schema.add(name, "long")
        if not i:
            schema = schema.add("groups_sha256", "string")
        part = texts.mapInArrow(_looked_up(slab, count_a, count_b, lengths, not i), schema)
        if len(slabs) == 1:
            return part.select(_COUNTS)
        if not i:
            found = shared_table(part, "aligned")
            sums = found.select("at", "n_best", "count_sum")
        else:
            sums = sums.unionByName(shared_table(part, "aligned"))
    totals = sums.groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.drop("n_best", "count_sum").join(totals, "at").select(_COUNTS)


def _arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)
