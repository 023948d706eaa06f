"""Splits and samples that no partitioning can change.

Rows are put in the order of ``md5(seed|key)``. Exact sizes need exact ranks, and a
window over one label would sort half of a binary table in one task. Instead a
counting pass over digest prefixes narrows each class down to the row on its
boundary; the split itself is then a comparison against that row, with no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.config import CONFLICT_SUFFIX
from broadsheet.functions.binding import digest_number, seeded_digest
from broadsheet.session import materialise
from broadsheet.sources.readers import CorpusError

PREFIX_DIGITS = 3  # 4,096 prefixes per counting pass
BOUNDARY_ROWS = 200_000  # rows one task may sort to find a boundary
RANKED_ROWS = 50_000  # rows one task may sort to rank them
# Up to so many classes the driver finds the boundaries, beyond that Spark does: same split.
DRIVER_CLASSES = 100
# Up to so many classes, as counted, their boundaries are broadcast.
BROADCAST_CLASSES = 200_000
REMAINDER_BINS = 1024


def allocate_test_rows(counts: dict, fraction: float) -> dict:
    """Test rows per class: the total is rounded up, classes share it in proportion.

    The training side gets the largest remainders; the test side gets the rest.
    """
    total = sum(counts.values())
    train_total = total - math.ceil(fraction * total)
    exact = {c: n / total * train_total for c, n in counts.items()}
    train = {c: math.floor(v) for c, v in exact.items()}
    spare = train_total - sum(train.values())
    for c in sorted(counts, key=lambda c: (-(exact[c] - train[c]), c))[:spare]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


@dataclass(frozen=True)
class StratifiedSplit:
    """A fitted split: per class, the last digest and key of the test side."""

    label: str
    key: str
    seed: int
    bounds: tuple[tuple[object, str, object], ...]
    counts: dict
    test_counts: dict

    def is_test(self) -> Column:
        digest, key, label = seeded_digest(self.seed, F.col(self.key)), F.col(self.key), F.col(self.label)
        sides = [
            (label == F.lit(c)) & ((digest < F.lit(d)) | ((digest == F.lit(d)) & (key <= F.lit(k))))
            for c, d, k in self.bounds
        ]
        return reduce(lambda a, b: a | b, sides, F.lit(False))

    def transform(self, df: DataFrame, column: str = "split") -> DataFrame:
        return df.withColumn(column, F.when(self.is_test(), F.lit("test")).otherwise(F.lit("train")))

    def train(self, df: DataFrame) -> DataFrame:
        return df.filter(~self.is_test())

    def test(self, df: DataFrame) -> DataFrame:
        return df.filter(self.is_test())


@dataclass(frozen=True)
class ManyClassSplit:
    """A fitted split of any number of classes: tables ``bounds(c, d, k)``, the last digest and key
    of each class's test side, and ``sizes(c, n, test)``."""

    label: str
    key: str
    seed: int
    bounds: DataFrame
    sizes: DataFrame
    few: bool

    def transform(self, df: DataFrame, column: str = "split") -> DataFrame:
        """Keeps a row whose class was not there when the split was fitted for training."""
        bounds = self.bounds.withColumnsRenamed({"c": "__c", "d": "__d", "k": "__k"})
        found = df.join(F.broadcast(bounds) if self.few else bounds, F.col(self.label) == F.col("__c"), "left")
        digest = seeded_digest(self.seed, F.col(self.key))
        is_test = (digest < F.col("__d")) | ((digest == F.col("__d")) & (F.col(self.key) <= F.col("__k")))
        return found.withColumn(column, F.when(is_test, "test").otherwise("train")).drop("__c", "__d", "__k")

    def train(self, df: DataFrame) -> DataFrame:
        return self.transform(df, "__side").filter(F.col("__side") == "train").drop("__side")

    def test(self, df: DataFrame) -> DataFrame:
        return self.transform(df, "__side").filter(F.col("__side") == "test").drop("__side")


def allocated(counts: DataFrame, fraction: float) -> DataFrame:
    """``(c, n, test)`` of ``counts(c, n)``, by ``allocate_test_rows``' rule.

    Largest remainders are ranked within bins of remainders, and bins by running totals, so no
    task ranks all classes.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train_total = total - math.ceil(fraction * total)
    exact = F.col("n") / F.lit(max(total, 1)) * F.lit(train_total)
    floored = counts.select("c", "n", F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("rest"))
    floored = floored.withColumn("bin", F.floor(F.col("rest") * REMAINDER_BINS))
    bins = floored.groupBy("bin").agg(F.count(F.lit(1)).alias("classes"), F.sum("whole").alias("whole"))
    spare = F.lit(train_total) - bins.agg(F.coalesce(F.sum("whole"), F.lit(0))).scalar()
    # one row per bin: at most REMAINDER_BINS + 1
    above = bins.select("bin", (F.sum("classes").over(Window.orderBy(F.desc("bin"))) - F.col("classes")).alias("above"))
    rank = F.row_number().over(Window.partitionBy("bin").orderBy(F.desc("rest"), "c")) + F.col("above")
    ranked = floored.join(F.broadcast(above), "bin").withColumn("rank", rank)
    return ranked.select("c", "n", (F.col("n") - F.col("whole") - (F.col("rank") <= spare).cast("long")).alias("test"))


def fit_many_class_split(df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42) -> ManyClassSplit:
    """``fit_stratified_split`` without anything per class in the driver."""
    rows = df.select(F.col(label).alias("c"), F.col(key).alias("k"), seeded_digest(seed, F.col(key)).alias("d"))

    def counted(frame: DataFrame, digits: int) -> DataFrame:
        return frame.groupBy("c", F.substring("d", 1, digits).alias("prefix")).agg(F.count(F.lit(1)).alias("held"))

    def boundary(prefixes: DataFrame, wanted: DataFrame) -> DataFrame:
        """The prefix in which each class's ``wanted(c, need)`` rows end."""
        upto = F.sum("held").over(Window.partitionBy("c").orderBy("prefix"))
        found = prefixes.join(wanted, "c").withColumn("upto", upto)
        ends = (F.col("need") <= F.col("upto")) & (F.col("need") > F.col("upto") - F.col("held"))
        return found.filter(ends).select("c", "prefix", (F.col("need") - F.col("upto") + F.col("held")).alias("need"), "held")

    prefixes = materialise(counted(rows, PREFIX_DIGITS), "class_prefixes")
    if not prefixes.filter(F.col("c").isNull()).isEmpty():
        raise CorpusError(f"null in {label!r}: every row of a split needs a class")
    sizes = materialise(allocated(prefixes.groupBy("c").agg(F.sum("held").alias("n")), fraction), "class_sizes")
    few = sizes.count() <= BROADCAST_CLASSES
    small = F.broadcast if few else (lambda table: table)
    ends = materialise(boundary(prefixes, sizes.filter("test > 0").select("c", F.col("test").alias("need"))), "class_ends")
    digits = PREFIX_DIGITS
    while digits < 30 and not ends.filter(F.col("held") > BOUNDARY_ROWS).isEmpty():
        wide = ends.filter(F.col("held") > BOUNDARY_ROWS)
        inside = rows.join(small(wide.select("c", "prefix")), "c").filter(F.col("d").startswith(F.col("prefix"))).drop("prefix")
        digits += PREFIX_DIGITS
        finer = boundary(counted(inside, digits), wide.select("c", "need"))
        ends = materialise(ends.filter(F.col("held") <= BOUNDARY_ROWS).unionByName(finer), "class_ends")
    inside = rows.join(small(ends), "c").filter(F.col("d").startswith(F.col("prefix")))
    rank = F.row_number().over(Window.partitionBy("c").orderBy("d", "k"))
    bounds = inside.withColumn("rank", rank).filter(F.col("rank") == F.col("need")).select("c", "d", "k")
    return ManyClassSplit(label, key, seed, materialise(bounds, "class_bounds"), sizes, few)


def fit_stratified_split(
    df: DataFrame, label: str, key: str, fraction: float = 0.2, seed: int = 42
) -> StratifiedSplit | ManyClassSplit:
    """Find the split boundary of every class of a non-null label and a unique key."""
    if df.select(label).distinct().limit(DRIVER_CLASSES + 1).count() > DRIVER_CLASSES:
        return fit_many_class_split(df, label, key, fraction, seed)
    rows = df.select(F.col(label).alias("c"), F.col(key).alias("k"), seeded_digest(seed, F.col(key)).alias("d"))

    def prefix_counts(frame: DataFrame, start: int) -> dict:
        counted = (
            frame.groupBy("c", F.substring("d", start + 1, PREFIX_DIGITS).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        by_class: dict = {}
        for r in counted:
            by_class.setdefault(r["c"], {})[r["p"]] = r["n"]
        return by_class

    def of_class(classes: dict) -> Column:
        return reduce(
            lambda a, b: a | b,
            [(F.col("c") == F.lit(c)) & F.col("d").startswith(p) for c, (p, _, _) in classes.items()],
        )

    # per class: digest prefix of the boundary, rows still needed in it, rows it holds
    first = prefix_counts(rows, 0)
    if None in first:
        raise CorpusError(f"null in {label!r}: every row of a split needs a class")
    counts = {c: sum(p.values()) for c, p in first.items()}
    quota = allocate_test_rows(counts, fraction) if counts else {}
    open_classes = {c: ("", n, counts[c]) for c, n in quota.items() if n > 0}
    settled: dict = {}
    level = first
    while open_classes:
        for c, (prefix, need, _) in list(open_classes.items()):
            for p, n in sorted(level[c].items()):
                if need <= n:
                    open_classes[c] = (prefix + p, need, n)
                    break
                need -= n
        for c, state in list(open_classes.items()):
            if state[2] <= BOUNDARY_ROWS or len(state[0]) >= 30:
                settled[c] = open_classes.pop(c)
        if open_classes:
            level = prefix_counts(rows.filter(of_class(open_classes)), len(next(iter(open_classes.values()))[0]))
    bounds = ()
    if settled:
        order = Window.partitionBy("c").orderBy("d", "k")
        needed = reduce(
            lambda a, b: a | b,
            [(F.col("c") == F.lit(c)) & (F.col("rank") == need) for c, (_, need, _) in settled.items()],
        )
        found = rows.filter(of_class(settled)).withColumn("rank", F.row_number().over(order)).filter(needed)
        bounds = tuple((r["c"], r["d"], r["k"]) for r in found.collect())
    return StratifiedSplit(label, key, seed, bounds, counts, quota)


def sample_fixed(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """Exactly ``n`` rows (fewer if there are fewer), without replacement: a top-k."""
    return df.orderBy(seeded_digest(seed, F.col(key)), F.col(key)).limit(n)


def _ranked(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, int]:
    """Rows with their zero-based rank in digest order, and their number.

    Ranks are counted within digest prefixes of as many digits as keep a prefix at about
    ``RANKED_ROWS`` rows or fewer. Offsets are running totals on two levels: over the leading
    digits, of which there are few, and within each of them.
    """
    total = df.count()
    digits = PREFIX_DIGITS
    while total > RANKED_ROWS * 16**digits and digits < 30:
        digits += 1
    rows = df.withColumn("__digest", seeded_digest(seed, F.col(key))).withColumn(
        "__prefix", F.substring("__digest", 1, digits)
    )
    counts = rows.groupBy("__prefix").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("lead", F.substring("__prefix", 1, max(digits - PREFIX_DIGITS, 1)))
    leads = counts.groupBy("lead").agg(F.sum("n").alias("all"))
    before = leads.select("lead", (F.sum("all").over(Window.orderBy("lead")) - F.col("all")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("lead").orderBy("__prefix")) - F.col("n")
    offsets = counts.withColumn("inside", inside).join(F.broadcast(before), "lead")
    offsets = offsets.select("__prefix", (F.col("before") + F.col("inside")).alias("__offset"))
    within = Window.partitionBy("__prefix").orderBy("__digest", key)
    ranked = (
        rows.join(F.broadcast(offsets) if digits <= PREFIX_DIGITS else offsets, "__prefix")
        .withColumn("__rank", F.col("__offset") + F.row_number().over(within) - 1)
        .drop("__prefix", "__offset", "__digest")
    )
    return ranked, total


def sample_with_replacement(df: DataFrame, key: str, fraction: float, seed: int = 123) -> DataFrame:
    """``round(fraction * n)`` draws; column ``draw`` numbers them from zero."""
    ranked, total = _ranked(df, key, seed)
    if total == 0:
        return df.withColumn("draw", F.lit(0).cast("bigint")).limit(0)
    draws = df.sparkSession.range(round(fraction * total)).select(
        F.col("id").alias("draw"),
        F.pmod(digest_number(seeded_digest(f"{seed}|draw", F.col("id")), 15), F.lit(total).cast("bigint")).alias("__rank"),
    )
    return ranked.join(draws, "__rank").drop("__rank")


def inject_label_conflicts(df: DataFrame, order: str, fraction: float = 0.5, seed: int = 123) -> DataFrame:
    """Append drawn rows with the other label and a URL of their own.

    Adds ``part`` (0 original, 1 injected) and ``draw``; ordering by ``(part,
    order, draw)`` puts originals first, as keep-first deduplication needs.
    """
    flipped = (
        sample_with_replacement(df, order, fraction, seed)
        .withColumn("label", (F.lit(1) - F.col("label")).cast("int"))
        .withColumn("url", F.concat(F.coalesce(F.col("url"), F.lit("")), F.lit(CONFLICT_SUFFIX), F.col(order).cast("string")))
        .withColumn("part", F.lit(1))
    )
    originals = df.withColumn("draw", F.lit(0).cast("bigint")).withColumn("part", F.lit(0))
    return originals.unionByName(flipped)


CONFLICT_ORDER = ("part", "ord", "draw")
