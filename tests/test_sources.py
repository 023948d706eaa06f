import datetime as dt

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import profile as P
from broadsheet.sources import readers as R, schemas, writers as W


def test_roles_prefer_earlier_candidates_and_later_columns():
    assert R.resolve_roles(["Title", "HEADLINE", "publisher", "Link"]) == R.Roles("HEADLINE", "publisher", "Link")
    assert R.resolve_roles(["Text", "TEXT"]).text == "TEXT"
    assert R.resolve_roles(["a", "b"]) == R.Roles(None, None, None)


def test_scan_urls(spark):
    df = spark.createDataFrame([(" https://h/a\t",), ("",), (None,), ("  ",)], "url string")
    assert [r.url for r in R.scan_urls(df).collect()] == ["https://h/a"]
    with pytest.raises(R.CorpusError):
        R.scan_urls(df.withColumnRenamed("url", "link"))


def test_guards(spark):
    df = spark.createDataFrame([(1, " ", None)], "ord long, title string, label int")
    with pytest.raises(R.CorpusError):
        R.require_text(df)
    with pytest.raises(R.CorpusError):
        R.require_text(df.select("ord"))
    assert R.require_text(df.select("ord"), allow_url_text=True) is not None
    with pytest.raises(R.CorpusError):
        R.require_rows(df.limit(0))
    with pytest.raises(R.CorpusError):
        R.experiment_input(df, "ord")
    ok = spark.createDataFrame([(1, "u", "h", "1", "x")], "ord long, url string, headline string, label string, other string")
    assert R.experiment_input(ok, "ord").dtypes == [("ord", "bigint"), ("url", "string"), ("headline", "string"), ("label", "int")]


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = [("https://h/a", "S", 0, 'He said "no",\nthen left'), ("https://h/b", "S", 1, "plain")]
    df = spark.createDataFrame(rows, schemas.CLEAN_CORPUS)
    W.write_clean(df.withColumn("extra", F.lit(1)), path, "csv")
    back = R.read_table(spark, path, schemas.CLEAN_CORPUS, "csv", multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@pytest.mark.parametrize("form", ["parquet", "orc", "json"])
def test_raw_sink_is_sorted(spark, tmp_path, form):
    path = str(tmp_path / form)
    at = dt.datetime(2026, 1, 1)
    rows = [(f"https://h/{i * 7 % 50:02d}", "S", i % 2, True, "h", 200, "", "f", 3, at, "direct_html") for i in range(50)]
    W.write_raw(spark.createDataFrame(rows, schemas.RESOLVED).repartition(4), path, form)
    back = R.read_table(spark, path, schemas.RESOLVED, form)
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("url").alias("a"), F.max("url").alias("b"))
    spans = sorted((r.a, r.b) for r in per_file.collect())
    assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:]))
    assert back.count() == 50


def test_metadata_round_trip(spark, tmp_path):
    path = str(tmp_path / "meta")
    W.write_metadata(spark, {"a": 1, "b": {"c": "é"}}, path)
    assert W.read_metadata(spark, path) == {"a": 1, "b": {"c": "é"}}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("s"))
    one = P.fingerprint(df, "id", "s").first()
    assert one == P.fingerprint(df.repartition(7).orderBy(F.desc("id")), "id", "s").first()
    assert one != P.fingerprint(df.withColumn("s", F.when(F.col("id") == 5, "x").otherwise(F.col("s"))), "id", "s").first()


def test_profile_maps_and_weights(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), (None, 1)], "m string, label int")
    assert P.count_map(df, "m").first()["m_counts"] == {"a": 2, "null": 1}
    many = spark.range(20_000).withColumns({"label": F.col("id"), "source": F.col("id") % 7, "headline_method": F.lit(None).cast("string")})
    counts = P.profile_counts(many, many.filter("id < 5"))
    assert {(r.name, r["count"]) for r in counts.groupBy("name").count().collect()} == {
        ("raw_label_counts", 20_000), ("clean_label_counts", 5), ("raw_source_counts", 7), ("clean_source_counts", 5), ("headline_method_counts_raw", 1),
    }
    assert counts.filter("name = 'headline_method_counts_raw'").first()["key"] is None
    assert {r.label: r.weight for r in P.class_weights(df).collect()} == {0: 0.75, 1: 1.5}


def test_null_url_gives_way_to_the_column_named_url(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame([(1, " u1 ", None), (2, "u2", "U2"), (3, None, None)], "id long, url string, URL string")
        assert [r.url for r in R.with_roles(df, "id").orderBy("ord").collect()] == ["u1", "U2", ""]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_roles_and_spellings_of_another_corpus(spark):
    """Two other sites, columns and labels, without a change to the library."""
    from broadsheet.config import CleaningOptions, RoleNames, SiteRule
    from broadsheet.plans.cleaning import prepare_dataset

    df = spark.createDataFrame(
        [(1, "Rates rise again", "Blau", "https://blau.example/a"), (2, "Cup final tonight", "?", "https://rot.example/b"), (3, "No side at all", None, "https://x.example/c")],
        "n long, Zeile string, Seite string, Adresse string",
    )
    options = CleaningOptions(
        roles=RoleNames(text=("zeile",), label=("seite",), url=("adresse",)),
        site_rules=(SiteRule("blau.example", "Blau", 5), SiteRule("rot.example", "Rot", 6)),
        label_synonyms={5: ("blau",), 6: ("rot",)},
    )
    assert sorted((r.ord, r.label, r.text) for r in prepare_dataset(df, "n", options).collect()) == [(1, 5, "Rates rise again"), (2, 6, "Cup final tonight")]
    with pytest.raises(R.CorpusError):
        R.with_roles(df, "n", True)
