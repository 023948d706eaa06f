"""Tokens, n-grams, vocabularies and TF-IDF weights of the given documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions.tokens import ngrams, tokens
from broadsheet.operators import features as X
from broadsheet.operators.model import score_linear
from broadsheet.registry import sql
from broadsheet.registry.base import query, table
from broadsheet.session import materialise

# The stop words of the registered baseline query.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "was", "that", "it", "for", "on", "with", "as", "be", "by", "at", "are",
    "this", "from", "or", "an", "had", "his", "her", "not", "but", "have", "which", "you", "were", "they", "all",
)

_WORDS = f"words AS (SELECT doc_id, lang, {sql.TOKENS} AS w FROM documents)"
_COUNTS = f"""{_WORDS}, counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({sql.grams('w')}) AS term FROM words) GROUP BY 1, 2)"""
_VOCAB = f"""{_COUNTS}, vocab AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM counts GROUP BY 1
  HAVING count(*) >= 2 AND count(*) <= 0.98::DOUBLE * (SELECT count(*) FROM documents)
  ORDER BY 2 DESC, 1 LIMIT 30000)"""
_IDF = "ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1"


def _documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("tokens", sql=f"WITH {_WORDS} SELECT doc_id, len(w) AS n, md5(array_to_string(w, ' ')) AS words FROM words")
def tokens_of_documents(spark, sf):
    words = _documents(spark, sf).select("doc_id", tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("bigint").alias("n"), F.md5(F.array_join("w", " ")).alias("words"))


@query(
    "ngrams",
    sql=f"""WITH {_WORDS}, g AS (SELECT doc_id, {sql.grams('w')} AS g FROM words)
SELECT doc_id, len(g) AS n, md5(array_to_string(g, '|')) AS grams FROM g""",
)
def ngrams_of_documents(spark, sf):
    grams = _documents(spark, sf).select("doc_id", ngrams(tokens(F.col("text")), 2).alias("g"))
    return grams.select("doc_id", F.size("g").cast("bigint").alias("n"), F.md5(F.array_join("g", "|")).alias("grams"))


@query("term_counts", sql=f"WITH {_COUNTS} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, sf):
    terms = X.document_terms(_documents(spark, sf), "text", X.TfidfOptions(), "doc_id")
    return terms.filter(F.col("term").isNotNull()).select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"))


@query("vocabulary", sql=f"WITH {_VOCAB} SELECT term, tf, df FROM vocab")
def vocabulary(spark, sf):
    return X.vocabulary(_documents(spark, sf), "text")


@query("vocabulary_pruned", sql=f"WITH {_VOCAB} SELECT term, tf, df FROM vocab")
def vocabulary_pruned(spark, sf):
    """The same vocabulary from a sketch and an exact count of what it leaves."""
    return X.pruned_vocabulary(_documents(spark, sf), "text")


@query("idf", sql=f"WITH {_VOCAB} SELECT term, round({_IDF}, 6) AS idf FROM vocab")
def idf(spark, sf):
    documents = _documents(spark, sf)
    return X.with_idf(X.vocabulary(documents, "text"), documents).select("term", F.round("idf", 6).alias("idf"))


@query(
    "tfidf",
    sql=f"""WITH {_VOCAB}, raw AS (
  SELECT doc_id, term, (1 + ln(c.tf)) * ({_IDF}) AS w FROM counts c JOIN (SELECT term, df FROM vocab) USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def tfidf(spark, sf):
    documents = _documents(spark, sf)
    vocab = X.with_idf(X.vocabulary(documents, "text"), documents)
    return X.tfidf_weights(documents, "doc_id", "text", vocab).withColumn("weight", F.round("weight", 6))


@query(
    "baseline_vocab",
    sql=f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM w WHERE term NOT IN {STOP_WORDS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
)
def baseline_vocab(spark, sf):
    return X.vocabulary(_documents(spark, sf), "text", X.TfidfOptions.baseline(STOP_WORDS))


@query(
    "linear_score",
    sql=f"""WITH {_VOCAB}, coef AS (
  SELECT term, {_IDF} AS idf, ln((1 + en) / (1 + df - en)::DOUBLE) AS coef
  FROM vocab JOIN (SELECT term, count(*) FILTER (WHERE lang = 'en') AS en FROM counts JOIN documents USING (doc_id) GROUP BY 1) USING (term)
), s AS (
  SELECT doc_id, sum(w * coef) AS dot, sum(w * w) AS square
  FROM (SELECT doc_id, (1 + ln(c.tf)) * idf AS w, coef FROM counts c JOIN coef USING (term)) GROUP BY 1
), m AS (SELECT doc_id, coalesce(dot / sqrt(square), 0) - 0.25 AS margin FROM documents LEFT JOIN s USING (doc_id))
SELECT doc_id, round(margin, 6) AS margin, round(1 / (1 + exp(-margin)), 6) AS probability, CAST(margin > 0 AS INTEGER) AS prediction FROM m""",
)
def linear_score(spark, sf):
    """Scoring with a linear model whose coefficients are log odds of the language."""
    options = X.TfidfOptions()
    documents = X.with_words(table(spark, sf, "documents").select("doc_id", "text", "lang"), "text", options)
    documents = materialise(documents, "samples")
    sets = {"all": F.lit(True), "english": F.col("lang") == "en"}
    totals = X.frequent_totals(documents, "text", options, sets, ("all",))
    n_docs = documents.agg(F.count(F.lit(1))).scalar()
    vocab = X.with_idf(X.vocabulary_of(totals, "all", n_docs, options, "df_english"), documents)
    coefficients = vocab.withColumn("coef", F.log((1 + F.col("df_english")) / (1 + F.col("df") - F.col("df_english"))))
    out = score_linear(documents, "doc_id", "text", coefficients, -0.25)
    return out.select("doc_id", F.round("margin", 6).alias("margin"), F.round("probability", 6).alias("probability"), "prediction")
