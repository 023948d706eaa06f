import hashlib

import pytest

from broadsheet.operators import sampling as S
from broadsheet.plans.cleaning import clean_frame


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_allocation_matches_published_sizes():
    assert S.allocate_test_rows({0: 2000, 1: 1803}, 0.2) == {0: 400, 1: 361}
    assert S.allocate_test_rows({0: 1, 1: 1}, 0.2) == {0: 0, 1: 1}
    assert sum(S.allocate_test_rows({"a": 7, "b": 5, "c": 3}, 0.37).values()) == 6


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, i % 3 % 2) for i in range(1003)], "k long, label int")


def brute(counts):
    quota = S.allocate_test_rows(counts, 0.2)
    keys = sorted(range(1003), key=lambda i: md5(f"42|{i}"))
    return {k for c in quota for k in [i for i in keys if i % 3 % 2 == c][: quota[c]]}


def test_split_is_exact_and_stable(rows):
    split = S.fit_stratified_split(rows, "label", "k")
    want = brute(split.counts)
    assert {r.k for r in split.test(rows).collect()} == want
    again = S.fit_stratified_split(rows.repartition(5, "k"), "label", "k")
    assert again.bounds == split.bounds or sorted(again.bounds) == sorted(split.bounds)
    assert {r.k for r in split.train(rows).collect()} == set(range(1003)) - want


def test_split_narrows_in_several_passes(rows, monkeypatch):
    monkeypatch.setattr(S, "BOUNDARY_ROWS", 1)
    monkeypatch.setattr(S, "PREFIX_DIGITS", 1)
    split = S.fit_stratified_split(rows, "label", "k")
    assert {r.k for r in split.test(rows).collect()} == brute(split.counts)


@pytest.mark.parametrize("narrow, broadcast", [(False, 200_000), (True, 200_000), (True, 0)])
def test_many_classes_split_as_few_do(spark, rows, monkeypatch, narrow, broadcast):
    want = {r.k for r in S.fit_stratified_split(rows, "label", "k").test(rows).collect()}
    monkeypatch.setattr(S, "DRIVER_CLASSES", 1)
    monkeypatch.setattr(S, "BROADCAST_CLASSES", broadcast)
    if narrow:
        monkeypatch.setattr(S, "BOUNDARY_ROWS", 2)
        monkeypatch.setattr(S, "PREFIX_DIGITS", 1)
    split = S.fit_stratified_split(rows, "label", "k")
    assert isinstance(split, S.ManyClassSplit) and {r.k for r in split.test(rows).collect()} == want
    assert {r.k for r in split.train(rows).collect()} == set(range(1003)) - want
    assert [r.split for r in split.transform(spark.createDataFrame([(5, 77)], "k long, label int")).collect()] == ["train"]


def test_thousands_of_classes(spark):
    sizes = {c: 1 + (c * 7919) % 5 for c in range(1500)}
    pairs = [(c * 10 + i, c) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(pairs, "k long, label long")
    split = S.fit_stratified_split(df, "label", "k", 0.37, 5)
    quota = S.allocate_test_rows(sizes, 0.37)
    assert {r.c: r.test for r in split.sizes.collect()} == quota
    order = sorted(pairs, key=lambda p: md5(f"5|{p[0]}"))
    want, left = set(), dict(quota)
    for k, c in order:
        if left[c]:
            left[c] -= 1
            want.add(k)
    assert {r.k for r in split.test(df).collect()} == want
    with pytest.raises(S.CorpusError):
        S.fit_stratified_split(df.withColumn("label", S.F.when(S.F.col("label") != 3, S.F.col("label"))), "label", "k")


def test_ranks_on_two_levels(rows, monkeypatch):
    want = sorted((r.draw, r.k) for r in S.sample_with_replacement(rows, "k", 0.5, 123).collect())
    monkeypatch.setattr(S, "RANKED_ROWS", 1)
    monkeypatch.setattr(S, "PREFIX_DIGITS", 1)
    assert sorted((r.draw, r.k) for r in S.sample_with_replacement(rows, "k", 0.5, 123).collect()) == want


def test_split_edges(rows):
    nothing = S.fit_stratified_split(rows.limit(0), "label", "k")
    assert nothing.test(rows).count() == 0
    everything = S.fit_stratified_split(rows, "label", "k", fraction=1.0)
    assert everything.train(rows).count() == 0


def test_transform_needs_no_shuffle(rows):
    split = S.fit_stratified_split(rows, "label", "k")
    assert "Exchange" not in split.transform(rows)._jdf.queryExecution().executedPlan().toString()


def test_sample_with_replacement(rows):
    got = sorted((r.draw, r.k) for r in S.sample_with_replacement(rows, "k", 0.5, 123).collect())
    order = sorted(range(1003), key=lambda i: md5(f"123|{i}"))
    want = [(d, order[int(md5(f"123|draw|{d}")[:15], 16) % 1003]) for d in range(round(0.5 * 1003))]
    assert got == want
    assert S.sample_with_replacement(rows.limit(0), "k", 0.5).count() == 0
    assert S.sample_with_replacement(rows, "k", 1.5).count() == round(1.5 * 1003)


def test_fixed_sample(rows):
    want = sorted(range(1003), key=lambda i: md5(f"7|{i}"))[:30]
    assert [r.k for r in S.sample_fixed(rows, "k", 30).collect()] == want
    assert S.sample_fixed(rows.limit(3), "k", 30).count() == 3


def test_conflicts_are_injected_and_cleaned_away(spark):
    df = spark.createDataFrame(
        [(i, f"https://h/{i}", f"Headline number {i}", i % 2) for i in range(10)],
        "ord long, url string, headline string, label int",
    )
    stressed = S.inject_label_conflicts(df, "ord", 0.5)
    rows = stressed.collect()
    assert len(rows) == 15
    injected = [r for r in rows if r.part == 1]
    assert all(r.label == 1 - r.ord % 2 and r.url == f"https://h/{r.ord}#label_conflict_{r.ord}" for r in injected)
    assert clean_frame(stressed, False, S.CONFLICT_ORDER).count() == 15
    strict = clean_frame(stressed, True, S.CONFLICT_ORDER)
    assert sorted((r.ord, r.label) for r in strict.collect()) == [(i, i % 2) for i in range(10)]


def test_split_refuses_rows_without_a_class(spark):
    from broadsheet.sources.readers import CorpusError

    df = spark.range(60).selectExpr("id", "case when id % 7 > 0 then cast(id % 2 as int) end as label")
    with pytest.raises(CorpusError):
        S.fit_stratified_split(df, "label", "id")


def test_conflicts_without_a_url_get_one_of_their_own(spark):
    df = spark.range(40).selectExpr("id as ord", "cast(null as string) as url", "'h' as headline", "cast(id % 2 as int) as label")
    added = S.inject_label_conflicts(df, "ord").filter("part = 1")
    assert added.count() == 20 and added.filter("url is null").count() == 0
