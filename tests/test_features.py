import math
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import tokens as T
from broadsheet.operators import counting, features as X
from tests.conftest import evaluate

V = F.col("v")
TEXTS = [
    "Café CAFÉ naïve a I x1 Œuvre", "ĳsland ﬁne ½ cup", "one", "", "a b c", "under_score 2024-05",
    "ÀÉÎõü ß ſtraße", "two two two words words", "Ａｆｕｌｌ ｗｉｄｔｈ", "İstanbul", "日本語 テキスト", "zero width",
    "𝐇ello ①② ㎏ 한국어 ¼half", "각힣 가나 ㍿ab wait… ﬃx", "𝟙𝟚𝟛 𝒜𝒷 🄰🄱 x",
]


def words(text):
    folded = unicodedata.normalize("NFKD", text.lower())
    folded = "".join(c for c in folded if not unicodedata.combining(c))
    return re.findall(r"\b\w\w+\b", folded)


def grams(text, n):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def test_tokens(spark):
    assert evaluate(spark, TEXTS, T.tokens(V)) == [words(t) for t in TEXTS]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_and_counts(spark, n):
    terms = T.ngrams(T.tokens(V), n)
    assert evaluate(spark, TEXTS, terms) == [grams(t, n) for t in TEXTS]
    counted = evaluate(spark, TEXTS, T.term_counts(terms))
    assert [{r.term: r.tf for r in row} for row in counted] == [dict(Counter(grams(t, n))) for t in TEXTS]


def test_vocabulary_against_brute_force(spark):
    docs = [f"w{i % 7} w{i % 5} w{i % 3} w{i % 3} common rare{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    for k in (3, 11, 1000):
        tf, dfreq = Counter(), Counter()
        for d in docs:
            tf.update(grams(d, 2))
            dfreq.update(set(grams(d, 2)))
        kept = [t for t in tf if dfreq[t] >= 2 and dfreq[t] <= 0.98 * len(docs)]
        want = sorted(kept, key=lambda t: (-tf[t], t))[:k]
        got = X.vocabulary(df, "text", X.TfidfOptions(max_features=k)).collect()
        assert {(r.term, r.tf, r.df) for r in got} == {(t, tf[t], dfreq[t]) for t in want}


@pytest.mark.parametrize("cells", [4, 64, 1 << 18])
def test_pruned_vocabulary_is_the_same(spark, monkeypatch, cells):
    monkeypatch.setattr(X, "SKETCH_CELLS", cells)
    docs = [f"w{i % 7} w{i % 5} w{i % 3} w{i % 3} common rare{i}" for i in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    for k in (3, 25, None):
        options = X.TfidfOptions(max_features=k)
        want = sorted(map(tuple, X.vocabulary(df, "text", options).collect()))
        assert sorted(map(tuple, X.pruned_vocabulary(df, "text", options).select("term", "tf", "df").collect())) == want
    assert X.pruned_vocabulary(df.limit(0), "text").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("chunk", [2, 1 << 20])
def test_totals_of_sets_against_brute_force(spark, n, chunk):
    docs = ["aa bb aa bb aa", None, "", "bb", "aa bb cc dd", "é aa bb cc", "cc dd aa bb aa"] * 3
    df = spark.createDataFrame([(i, t, None if i % 5 == 4 else i % 2 == 0) for i, t in enumerate(docs)], "id long, text string, even boolean")
    want = {}
    for i, d in enumerate(docs):
        for t, k in Counter(grams(d or "", n)).items():
            tf, dfreq, even_tf, even_df = want.get(t, (0, 0, None, 0))
            even = i % 5 != 4 and i % 2 == 0
            want[t] = (tf + k, dfreq + 1, (even_tf or 0) + k if even else even_tf, even_df + even)
    options = X.TfidfOptions(ngram_max=n, min_df=1, max_features=4)
    sets = {"all": F.lit(True), "even": F.col("even")}
    rows = X._with_sets(df, "text", options, sets)
    size, counting.CHUNK_WORDS = counting.CHUNK_WORDS, chunk
    try:
        got = {r.term: tuple(r)[1:] for r in X.ngram_totals(rows, "text", n, ["all", "even"]).collect()}
    finally:
        counting.CHUNK_WORDS = size
    assert got == want


def test_totals_sort_no_strings_in_rows(spark):
    """Counting inside each row, a lambda for every term, took most of the time of a vocabulary."""
    df = spark.createDataFrame([(1, "aa bb")], "id long, text string")
    plan = X.term_totals(df, "text", X.TfidfOptions(), {"all": F.lit(True)})._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "sort_array" not in plan


def test_only_terms_of_heavy_cells_are_shuffled(spark):
    docs = [f"common words again only{i} rare{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string")
    options = X.TfidfOptions(max_df=1.0, max_features=3)
    counted = X.frequent_totals(df, "text", options, {"all": F.lit(True)}, ("all",))
    terms = {r.term for r in counted.collect()}
    assert {"again", "common", "common words"} <= terms and len(terms) < 30
    assert {r.term for r in X.vocabulary(df, "text", options).collect()} == {"again", "common", "common words"}


def test_tfidf_formulas(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, "bb cc"), (4, "..")], "id long, text string")
    options = X.TfidfOptions(ngram_max=1, min_df=1, max_df=1.0)
    three = df.filter("id < 4")
    vocab = X.with_idf(X.vocabulary(three, "text", options), three)
    assert {round(r.idf, 6) for r in vocab.collect()} == {1.287682}
    weights = {(r.id, r.term): round(r.weight, 6) for r in X.tfidf_weights(df, "id", "text", vocab, options).collect()}
    assert weights[1, "aa"] == 0.861037 and weights[1, "bb"] == 0.508542
    assert not any(i == 4 for i, _ in weights)
    indexed = vocab.withColumn("idx", F.ascii("term") - 97)
    vectors = {r.id: r.features for r in X.stored_vectors(X.tfidf_vectors(df, "id", "text", indexed, 3, options), "t").collect()}
    assert vectors[1].toArray().round(6).tolist() == [0.861037, 0.508542, 0.0]
    assert vectors[4].numNonzeros() == 0 and len(vectors) == 4


def test_weights_beyond_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, "bb cc dd"), (4, ".."), (5, None)], "id long, text string")
    vocab = X.with_idf(X.vocabulary(df, "text", X.TfidfOptions(min_df=1)), df)
    rounded = lambda: sorted((r.id, r.term, round(r.weight, 9)) for r in X.tfidf_weights(df, "id", "text", vocab).collect())
    in_rows = rounded()
    assert len(in_rows) == 12 and "Exchange" not in X.row_weights(df, "text", X.Lookup.of(vocab, "idf"), X.TfidfOptions(), "id")._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(X, "BROADCAST_TERMS", 2)
    assert rounded() == in_rows


def test_words_cut_before_give_the_same(spark):
    df = spark.createDataFrame([(1, "Aa bb aa"), (2, "aa cc the bb"), (3, None)], "id long, text string")
    options = X.TfidfOptions(min_df=1, stop_words=("the",))
    cut = X.with_words(df, "text", options)
    totals = lambda d: sorted(map(tuple, X.term_totals(d, "text", options, {"x": F.col("id") > 1}).collect()), key=str)
    by_hand = X.term_totals(df, "text", options, {"x": F.lit(True)}).collect()
    assert {r.term: (r.tf_x, r.df_x) for r in by_hand}["aa"] == (3, 2)
    flagged = df.withColumn("in", F.col("id") > 1)
    assert sorted(map(tuple, X.term_totals(flagged, "text", options, {"x": F.col("in")}).collect()), key=str) == sorted(
        map(tuple, X.term_totals(X.with_words(flagged, "text", options), "text", options, {"x": F.col("in")}).collect()), key=str
    )
    assert totals(cut) == totals(df)


def test_stop_words_go_before_ngrams(spark):
    options = X.TfidfOptions(stop_words=("the", "of"))
    got = evaluate(spark, ["the cat of the house"], X.terms_of(V, options))
    assert got == [["cat", "house", "cat house"]]


def test_accents_stay_without_folding(spark):
    assert evaluate(spark, ["Café"], T.tokens(V, strip_accents=False)) == [["café"]]


def test_sublinear_weight(spark):
    row = spark.createDataFrame([(3, 2.0)], "tf int, idf double").select(
        X.raw_weight(X.TfidfOptions()).alias("s"), X.raw_weight(X.TfidfOptions(sublinear_tf=False)).alias("p")
    ).first()
    assert row.s == pytest.approx((1 + math.log(3)) * 2) and row.p == 6.0
