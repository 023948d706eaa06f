import pytest

from broadsheet.llm.queries import QUERIES, SQL
from broadsheet.registry.base import Query
from tests.check_registry import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), name, Query(QUERIES[name], SQL[name]), SF).startswith("ok")


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and kept.join(docs, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() > 100


SCHEMA = "doc_id long, text string, lang string, source string, __row string, lang_pred string, row int"


def test_pipeline_stages_take_odd_rows(spark):
    """Nulls, empty and repeated rows, ties in id and text, and columns that operators use."""
    import corpus_pipeline

    prose = "the committee met in the old hall to talk about {} and agreed to meet again next week"
    rows = [(i, prose.format(f"item number {i} of the long list"), "en", "s") for i in range(1, 41)]
    rows += [(50, None, "en", "s"), (51, "", None, None), (52, "12 34 --", "en", "s"), (53, "\u0416\u0429\u042d" * 30, None, "x")]
    rows += [(60, prose.format("taxes"), "en", "b"), (60, prose.format("taxes"), "en", "a"), (60, prose.format("taxes"), None, "b"), (None, prose.format("roads"), "en", "s")]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    first, second, third, fourth = (stage for _, stage in corpus_pipeline.STAGES[:4])
    known = first(spark, docs, SF)
    assert known.columns == docs.columns and sorted(r.doc_id or -1 for r in known.collect()) == sorted([-1, *range(1, 41), 60, 60, 60])
    once = second(spark, known, SF)
    assert sorted(r.doc_id or -1 for r in once.collect()) == [-1, *range(1, 41), 60]
    # of rows that agree in id and text the least by all columns, nulls first
    assert [r.lang for r in once.filter("doc_id = 60").collect()] == [None]
    apart = third(spark, once, SF)
    assert apart.columns == docs.columns and 1 <= apart.count() <= 42
    clean = fourth(spark, apart, SF)
    assert clean.columns == docs.columns and clean.exceptAll(apart).count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_without_a_teacher_keeps_texts_with_letters(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some words", None), (2, "...", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in corpus_pipeline.known_language(spark, docs, SF).collect()] == [1]
