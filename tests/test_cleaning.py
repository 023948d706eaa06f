import pytest
from pyspark.sql import functions as F

from broadsheet.config import CleaningOptions
from broadsheet.plans import cleaning as C
from broadsheet.sources.readers import CorpusError

ROWS = [
    (1, "https://h/a", 0, "short"),
    (2, "https://H/A", 0, "A long headline"),
    (3, "https://h/b", None, "Another headline"),
    (4, "https://h/b", 1, "Another headline"),
    (5, "", 0, "Blank url first one"),
    (6, " ", 1, "Blank url second one"),
    (7, "https://h/c", 1, "A LONG HEADLINE"),
    (8, "https://h/d", 0, "!!! ??? ---"),
    (9, "https://h/e", 1, None),
    (10, "https://h/e", 1, "Ten is a good row"),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(ROWS, "ord long, url string, label int, headline string")


def ids(df):
    return sorted(r.ord for r in df.select("ord").collect())


def raw_of(corpus):
    return corpus.withColumn("success", F.lit(True)).withColumn("source", F.lit("Unknown"))


def test_three_orders_keep_different_rows(corpus):
    assert ids(C.clean_resolved(raw_of(corpus), order=("ord",))) == [2, 4, 5, 10]
    assert ids(C.prepare_dataset(corpus, "ord", CleaningOptions.strict())) == [5, 6, 7, 10]
    assert ids(C.clean_frame(corpus.filter("label is not null"), strict=True)) == [2, 4, 5, 10]


def test_loose_cleaning_keeps_all_headlines(corpus):
    assert ids(C.clean_frame(corpus, strict=False)) == [1, 2, 3, 4, 5, 6, 7, 8, 10]


def test_funnel_counts_what_cleaning_drops(corpus):
    raw = raw_of(corpus).withColumn("success", F.col("ord") != 4)
    row = C.removal_funnel(raw, order=("ord",)).first().asDict()
    assert row == {
        "input_rows": 10,
        "removed_not_success": 1,
        "removed_no_label": 1,
        "removed_empty_headline": 1,
        "removed_short_headline": 1,
        "removed_symbol_only_headline": 1,
        "removed_duplicate_urls": 1,
        "removed_duplicate_headlines": 1,
        "clean_rows": 3,
    }
    assert row["clean_rows"] == C.clean_resolved(raw, order=("ord",)).count()


@pytest.mark.parametrize("switches", [
    {"dedup_urls": False}, {"dedup_headlines": False}, {"min_chars": 0}, {"drop_symbol_only": False},
    {"dedup_urls": False, "dedup_headlines": False, "min_chars": 0, "drop_symbol_only": False},
])
def test_funnel_follows_the_switches(corpus, switches):
    row = C.removal_funnel(raw_of(corpus), order=("ord",), **switches).first().asDict()
    kept = C.clean_resolved(raw_of(corpus), order=("ord",), **switches).count()
    assert row["clean_rows"] == kept
    assert row["input_rows"] - sum(v for k, v in row.items() if k.startswith("removed_")) == kept


def test_funnel_of_nothing(corpus):
    row = C.removal_funnel(raw_of(corpus).limit(0), order=("ord",)).first().asDict()
    assert set(row.values()) == {0}


def test_prepare_flags(spark, corpus):
    urls_only = spark.createDataFrame(
        [(1, "https://www.foxnews.com/us/big-storm"), (2, "https://www.nbcnews.com/"), (3, "https://x.org/a-b"), (4, None)],
        "ord long, Link string",
    )
    rows = C.prepare_data(urls_only, "ord").collect()
    assert [(r.ord, r.text, r.label) for r in rows] == [(1, "us big storm", 0)]
    with pytest.raises(CorpusError):
        C.prepare_dataset(urls_only, "ord", CleaningOptions.strict())
    # an unusable first row of a URL hides the second one only when URLs are deduplicated
    loose = CleaningOptions(allow_url_fallback=False, min_headline_chars=8)
    assert ids(C.prepare_dataset(corpus, "ord", loose)) == [2, 4, 5, 6, 7, 8, 10]


def test_strict_cleaning_is_idempotent_and_ignores_partitioning(spark):
    rows = [(i, f"https://h/{i % 700}", i % 2, f"Headline number {i % 500} of many") for i in range(2000)]
    df = spark.createDataFrame(rows, "ord long, url string, label int, headline string")
    once = C.clean_frame(df, strict=True)
    expected = ids(once)
    assert ids(C.clean_frame(once, strict=True)) == expected
    assert ids(C.clean_frame(df.repartition(17, "headline"), strict=True)) == expected
    # brute force
    urls, heads, kept = set(), set(), []
    for i, u, _, _ in rows:
        if u not in urls:
            urls.add(u)
            kept.append(i)
    want = [i for i in kept if rows[i][3] not in heads and not heads.add(rows[i][3])]
    assert expected == want


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "", 0, "x")], "ord long, url string, label int, headline string")
    plan = C.clean_frame(df, strict=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "Partial" in plan
