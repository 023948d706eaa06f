"""Hard negatives against a plain search over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import hard_negatives
from broadsheet.llm.hard_negatives import Bucket, mine, products

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, seed int"


def brute_force(rows, is_anchor, positives, negatives, low=30, high=90):
    import math

    sound = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound[i] = (label, [math.floor(256 * x) for x in vector])
    found = []
    for a in filter(is_anchor, sound):
        scores = sorted((-sum(x * y for x, y in zip(sound[a][1], v)), i, label) for i, (label, v) in sound.items() if i != a)
        same = [(i, -s) for s, i, label in scores if label == sound[a][0]][:positives]
        for p, ps in same:
            other = [(i, -s) for s, i, label in scores if label != sound[a][0] and low * ps <= -100 * s <= high * ps][:negatives]
            found += [(a, p, k, n, ps, ns) for k, (n, ns) in enumerate(other, 1)]
    return sorted(found)


def some_rows(n, seed, dims=6, labels=3):
    """Vectors of mixed lengths around a few centres, so that there is something to prune."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        centre, size = draw.choice(centres), draw.choice([0.2, 1, 1, 4])
        vector = [float(int(64 * size * (c + draw.gauss(0, 0.15)))) / 64 for c in centre]
        rows.append((i, vector if draw.random() > 0.05 else rows[-1][1] if rows else vector, draw.randrange(labels)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("bucket, block", [(4096, 4096), (17, 5)])
def test_equals_brute_force(spark, bucket, block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 60)
    rows = some_rows(600, bucket)
    rows += [(601, None, 1), (602, [1.0, None], 1), (603, [float("nan")] * 6, 1), (604, [float("inf")] * 6, 2), (605, [1.0] * 6, None)]
    rows += [(None, [1.0] * 6, 1), (606, [], 1), (612, [0.0] * 6, 2), (613, [1.0, 2.0], 0), (618, [1.0] * 9, 1)]
    df = frame(spark, rows).repartition(7)
    got = sorted(tuple(r) for r in mine(df, F.col("vec_id") % 6 == 0, 3, 4).collect())
    assert got == brute_force(rows, lambda i: i % 6 == 0, 3, 4) and len(got) > 200
    # repeated rows count once
    assert sorted(tuple(r) for r in mine(df.unionByName(df), F.col("vec_id") % 6 == 0, 3, 4).collect()) == got


def test_pruned_search_loses_nothing():
    import numpy as np

    draw = np.random.default_rng(2)
    centres = np.repeat(draw.normal(size=(90, 8)), 10, axis=0)
    values = np.floor(256 * (centres + 0.02 * draw.normal(size=(900, 8))) / np.linalg.norm(centres, axis=1)[:, None])
    values[::50] = np.floor(values[::50] / 3)
    bucket = Bucket(np.arange(900), values)
    anchors = np.vstack([values[:60] + 3, draw.normal(size=(5, 8)) * 200 // 1, np.zeros((1, 8))])
    scores = products(anchors, values)
    pruned = 0
    for share in (1.2, 0.95, 0.8, 0.3, -0.5):
        least = share * np.sort(scores, axis=1)[:, -3]
        got = {i: rows for i, rows, s in bucket.search(anchors, least)}
        for i in range(len(anchors)):
            wanted = np.flatnonzero(scores[i] >= least[i])
            assert set(wanted) <= set(got.get(i, ())) or not len(wanted)
        pruned += sum(len(r) < 270 for r in got.values())
    assert pruned > 40


def test_scores_beyond_doubles_are_exact(spark):
    draw = random.Random(4)
    rows = [(i, [float(draw.randrange(1 << 24)) * 2**20 for _ in range(2)], i % 2) for i in range(40)]
    got = sorted(tuple(r) for r in mine(frame(spark, rows), F.col("vec_id") < 4, 2, 3).collect())
    expected = brute_force(rows, lambda i: i < 4, 2, 3)
    cap = 2**63 - 1
    assert [r[:2] for r in got if r[2] == 1] == [r[:2] for r in expected if r[2] == 1] or max(r[4] for r in expected) > cap
    small = [(i, [x / 2**34 for x in v], label) for i, v, label in rows]  # over 53 bits, under 64
    assert sorted(tuple(r) for r in mine(frame(spark, small), F.col("vec_id") < 4, 2, 3, scale=256).collect()) == brute_force(small, lambda i: i < 4, 2, 3)


def test_empty_and_lonely(spark):
    df = frame(spark, some_rows(5, 1, labels=1))
    assert mine(df.limit(0), F.lit(True)).count() == 0
    assert mine(df, F.lit(True)).count() == 0  # one label has no negatives
    assert mine(df, F.lit(None).cast("boolean")).count() == 0
