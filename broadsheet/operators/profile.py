"""Counts and consistency audits of a corpus. Each is one aggregate with map-side
combination; ratios of label to source never meet row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.config import SITE_RULES
from broadsheet.functions.text import comparison_key
from broadsheet.functions.urls import label_from_host


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null counts as a value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def fetch_totals(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("raw_total"),
        F.count_if(F.col("success")).alias("raw_success"),
        F.count_if(~F.col("success")).alias("raw_fail"),
    )


def label_disagrees(url: Column, label: Column, rules=SITE_RULES) -> Column:
    """True when the label is not the one the URL's host implies."""
    return ~label.eqNullSafe(label_from_host(url, rules))


def source_label_mismatch(df: DataFrame, rules=SITE_RULES) -> DataFrame:
    return df.filter(label_disagrees(F.col("url"), F.col("label"), rules))


def class_distribution(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """``(dataset, class, count)`` with classes written ``Source(label)``."""

    def tagged(df: DataFrame, name: str) -> DataFrame:
        written = F.concat("source", F.lit("("), F.coalesce(F.col("label").cast("string"), F.lit("")), F.lit(")"))
        return df.select(F.lit(name).alias("dataset"), written.alias("class"))

    both = tagged(raw, "raw").unionByName(tagged(clean, "clean"))
    return both.groupBy("dataset", "class").agg(F.count(F.lit(1)).alias("count"))


def profile_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """``(name, key, count)``: rows by label and by source before and after cleaning, and by
    headline method before it; a null key is a value.

    One aggregate over grouping sets; values may be as many as they like.
    """

    def tagged(df: DataFrame, side: str, method: Column) -> DataFrame:
        return df.select(
            F.lit(side).alias("side"),
            F.col("label").cast("string").alias("label"),
            F.col("source").cast("string").alias("source"),
            method.cast("string").alias("method"),
        )

    both = tagged(raw, "raw", F.col("headline_method")).unionByName(tagged(clean, "clean", F.lit(None)))
    sets = [[F.col("side"), F.col(c)] for c in ("label", "source", "method")]
    counted = both.groupingSets(sets, "side", "label", "source", "method").agg(
        F.count(F.lit(1)).alias("count"), *[F.grouping(c).alias(f"no_{c}") for c in ("label", "source", "method")]
    )
    name = (
        F.when(F.col("no_label") == 0, F.concat("side", F.lit("_label_counts")))
        .when(F.col("no_source") == 0, F.concat("side", F.lit("_source_counts")))
        .when(F.col("side") == "raw", F.lit("headline_method_counts_raw"))
    )
    key = F.when(F.col("no_label") == 0, F.col("label")).when(F.col("no_source") == 0, F.col("source")).otherwise(F.col("method"))
    return counted.select(name.alias("name"), key.alias("key"), "count").filter(F.col("name").isNotNull())


def count_map(df: DataFrame, column: str) -> DataFrame:
    """One row: ``MAP<STRING,BIGINT>`` of value counts. A map is one cell, so it is for columns of
    few values; ``value_counts`` and ``profile_counts`` have a row for each."""
    key = F.coalesce(F.col(column).cast("string"), F.lit("null")).alias("key")
    entries = value_counts(df, column).select(F.struct(key, F.col("count").alias("value")).alias("e"))
    return entries.agg(F.map_from_entries(F.sort_array(F.collect_list("e"))).alias(f"{column}_counts"))


def dataset_profile(urls: DataFrame, raw: DataFrame, clean: DataFrame, rules=SITE_RULES) -> DataFrame:
    """One row: sizes before and after cleaning and the invariants of the clean side.

    The clean side is folded by ``(headline, label)`` first, which gives duplicates
    without a distinct count; the three single-row results are read as scalars.
    """
    url_rows = urls.agg(F.count(F.lit(1)).alias("n"))
    raw_side = raw.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("success")).alias("success"),
            F.count_if(F.col("success") & F.col("label").isNotNull() & (F.col("headline") != "")).alias("valid"),
        ).alias("v")
    )
    folded = clean.select(
        "headline",
        "label",
        label_disagrees(F.col("url"), F.col("label"), rules).cast("bigint").alias("mismatch"),
    ).groupBy("headline", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("mismatch").alias("mismatch"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    clean_side = folded.select(
        F.col("n"), F.col("mismatch"), (F.coalesce(F.col("headline"), F.lit("")) == "").alias("empty"), F.col("label").isNull().alias("unlabelled")
    ).agg(
        F.struct(
            rows.alias("rows"),
            F.coalesce(F.sum(F.when(F.col("empty"), F.col("n"))), F.lit(0)).alias("empty"),
            F.coalesce(F.sum(F.when(F.col("unlabelled"), F.col("n"))), F.lit(0)).alias("unlabelled"),
            (rows - F.count(F.lit(1))).alias("duplicates"),
            F.coalesce(F.sum("mismatch"), F.lit(0)).alias("mismatch"),
        ).alias("v")
    )
    one = urls.sparkSession.range(1).select(
        url_rows.scalar().alias("urls"), raw_side.scalar().alias("raw"), clean_side.scalar().alias("clean")
    )
    return one.select(
        F.col("urls").alias("input_url_rows"),
        F.col("raw.rows").alias("raw_rows"),
        F.col("raw.success").alias("raw_success"),
        (F.col("raw.rows") - F.col("raw.success")).alias("raw_fail"),
        F.col("clean.rows").alias("clean_rows"),
        (F.col("raw.rows") - F.col("clean.rows")).alias("removed_from_raw_to_clean"),
        F.col("raw.valid").alias("valid_rows_before_dedup"),
        F.col("clean.rows").alias("rows_after_dedup"),
        (F.col("raw.valid") - F.col("clean.rows")).alias("removed_duplicates_headline_label"),
        F.col("clean.empty").alias("clean_empty_headline"),
        F.col("clean.unlabelled").alias("clean_missing_label"),
        F.col("clean.duplicates").alias("clean_dup_headline_label"),
        F.col("clean.mismatch").alias("source_label_mismatch_clean"),
    )


def extraction_agreement(sample: DataFrame, first: Column, second: Column) -> DataFrame:
    """How many sampled rows have a second reading, and how many readings agree."""
    returned = F.coalesce(second, F.lit("")) != ""
    return sample.agg(
        F.count(F.lit(1)).alias("sample"),
        F.count_if(returned).alias("returned"),
        F.count_if(returned & (comparison_key(first) == comparison_key(second))).alias("exact_match"),
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (classes * n_class)``, one row per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(F.sum("rows") / F.count(F.lit(1)))
    return counts.select("label", "rows", (totals.scalar() / F.col("rows")).alias("weight"))


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """Row count and a sum of row digests: equal data, in any order, gives equal rows.

    The sum is a DECIMAL, which no number of rows overflows.
    """
    row = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    number = F.conv(F.substring(row, 1, 8), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(number).cast("decimal(38,0)").cast("string"), F.lit("0")).alias("fingerprint"),
    )
