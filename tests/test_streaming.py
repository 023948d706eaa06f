from pyspark.sql import functions as F

from broadsheet.operators.features import TfidfOptions
from broadsheet.operators.model import FitOptions, fit_model
from broadsheet.streaming import ingest

SCHEMA = "ord long, url string, html string"
FILES = [
    [
        (1, "https://www.foxnews.com/a", "<h1>First headline here</h1>"),
        (2, "https://www.foxnews.com/A", "<h1>Same URL, other case</h1>"),
        (3, "https://x.org/a", "<h1>No label at all</h1>"),
    ],
    [
        (4, "https://www.nbcnews.com/b", "<h1>FIRST headline here</h1>"),
        (5, "https://www.foxnews.com/a", "<h1>Seen before by URL</h1>"),
        (6, "https://www.nbcnews.com/c", "<h1>Second good headline</h1>"),
    ],
    [
        (7, "https://www.nbcnews.com/b", "<h1>URL known though its row lost</h1>"),
        (8, "https://www.nbcnews.com/d", "<h1>short</h1>"),
        (9, "https://www.nbcnews.com/e", "<h1>Third good headline</h1>"),
    ],
]


def test_corpus_grows_batch_by_batch(spark, tmp_path):
    pages, target, check = (str(tmp_path / n) for n in ("pages", "target", "check"))
    for rows in FILES:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(pages)
        schema = spark.createDataFrame([], SCHEMA).schema
        resolved = ingest.resolved_stream(ingest.stream_pages(spark, pages, schema))
        ingest.build_corpus(resolved, target, check, order=("ord",)).awaitTermination()
    expected = {"First headline here", "Second good headline", "Third good headline"}
    assert {r.headline for r in ingest.read_corpus(spark, target).collect()} == expected
    # replaying the last batch changes nothing
    batch = ingest.resolve_single(spark.createDataFrame(FILES[2], SCHEMA))
    ingest.append_clean(batch, 2, target, ("ord",))
    assert sorted(r.headline for r in ingest.read_corpus(spark, target).collect()) == sorted(expected)


def test_scores_follow_the_batch_path(spark, tmp_path):
    rows = [(i, "goal match cup" if i % 2 else "vote law senate", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, text string, label int")
    model = fit_model(df, "id", "text", options=FitOptions(tfidf=TfidfOptions(min_df=1, max_df=1.0)))
    source, target, check = (str(tmp_path / n) for n in ("items", "scores", "check"))
    df.select("id", "text").write.parquet(source)
    items = spark.readStream.schema("id long, text string").parquet(source)
    ingest.score_stream(items, model, "id", "text", target, check).awaitTermination()
    got = {r.id: r.prediction for r in spark.read.parquet(target).collect()}
    assert got == {i: i % 2 for i in range(40)}
    assert spark.read.parquet(target).filter(F.col("probability").isNull()).count() == 0
