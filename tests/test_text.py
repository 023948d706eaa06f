import html
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import labels, text
from tests.conftest import evaluate

V = F.col("v")


def test_clean_headline_once_and_twice(spark):
    cases = {
        "Storm hits coast | Fox News": ("Storm hits coast", "Storm hits coast"),
        "Storm hits coast - nbc news": ("Storm hits coast", "Storm hits coast"),
        "A - NBC News | Fox News": ("A", "A"),
        "A | Fox News | NBC News": ("A | Fox News", "A"),
        "A | NBC News Select": ("A", "A"),
        '"A | Fox News"': ("A | Fox News", "A"),
        "Tom &amp;amp; Jo": ("Tom &amp; Jo", "Tom & Jo"),
        "“‘Hi there’”": ("Hi there", "Hi there"),
        "a \tb": ("a b", "a b"),
    }
    once = evaluate(spark, list(cases), text.clean_headline(V))
    twice = evaluate(spark, list(cases), text.clean_headline(text.clean_headline(V)))
    assert list(zip(once, twice)) == list(cases.values())


def test_normalise(spark):
    assert evaluate(spark, ["  x\n\ty  ", "A | Fox News", "&lt;b&gt;", ""], text.normalise(V)) == [
        "x y",
        "A | Fox News",
        "<b>",
        "",
    ]


ENTITY_CASES = [
    "no refs", "&", "&&amp;", "a & b", "&amp;lt;", "&notit; x", "&copy2020", "&notin;", "&#8217;s", "&#x2019;s",
    "&#x80;", "&#150;", "&#0;", "&#xD800;", "&#1114112;", "&#99999999999999;", "&#1;", "&#x41", "&#65b", "&bogus;",
    "&AMP", "&ampx", "&am", "&\nThe", "&nbsp;x", "&NotEqualTilde;", "&fjlig;", "&#13;", "&#xFFFE;", "&#xFDD0;",
    "&hellip;&hellip;", "&#128512;", "x&eacute;y&eacutez", "&amp", "&#;", "&;", "&#x;",
]


def test_unescape_matches_the_standard_library(spark):
    got = evaluate(spark, ENTITY_CASES, text.unescape_entities(V))
    assert dict(zip(ENTITY_CASES, got)) == {c: html.unescape(c) for c in ENTITY_CASES}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(
            st.sampled_from(list("&#;xX19af &ampltcopynoé") + ["&amp;", "&#3", "&#x2", "&not", "&lt"]), max_size=20
        ).map("".join),
        min_size=100,
        max_size=200,
    )
)
def test_unescape_random(spark, values):
    got = evaluate(spark, values, text.unescape_entities(V))
    assert got == [html.unescape(v) for v in values]


def test_whitespace_is_unicode(spark):
    values = [" a 　b\x1cc\x85", "​x", " y"]
    assert evaluate(spark, values, text.squeeze(V)) == [re.sub(r"\s+", " ", v).strip() for v in values]
    assert evaluate(spark, values, text.strip(V)) == [v.strip() for v in values]


def test_alphanumeric_predicate(spark):
    values = ["!!! ??? ---", "a", "1", "½", "é", "一", "", "_"]
    assert evaluate(spark, values, text.has_alphanumeric(V)) == [any(c.isalnum() for c in v) for v in values]


def test_length_counts_code_points(spark):
    assert evaluate(spark, ["a😀é"], F.length(V)) == [3]


def test_canonical_label(spark):
    values = [" FOX ", "fox news", "foxnews", "0", "NBC News", "1", "0.0", "true", "", None, "\tnbc\n"]
    assert evaluate(spark, values, labels.canonical_label(V)) == [0, 0, 0, 0, 1, 1, None, None, None, None, 1]


def test_label_prefers_explicit_value(spark):
    rows = [("1", "https://www.foxnews.com/a"), ("?", "https://www.foxnews.com/a"), (None, "https://x.org/a")]
    got = evaluate(spark, rows, labels.resolve_label(V, F.col("u")), schema="i int, v string, u string")
    assert got == [1, 0, None]


def test_string_items(spark):
    values = ["https://h/us/big-storm.html", " x &amp; y ", "ftp://h/a-b"]
    assert evaluate(spark, values, labels.text_of_string(V)) == ["us big storm", "x & y", "ftp://h/a-b"]


def test_map_items(spark):
    rows = [
        (0, {"headline": "", "title": " T  one ", "url": "https://h/a"}),
        (1, {"url": "https://h/us/big-storm"}),
        (2, {"headline": "", "text": ""}),
        (3, {"content": "C"}),
        (4, {"other": "z"}),
    ]
    df = spark.createDataFrame(rows, "i int, m map<string,string>")
    got = [r.t for r in df.select("i", labels.text_of_map(F.col("m")).alias("t")).orderBy("i").collect()]
    assert got == ["T one", "us big storm", '{"headline":"","text":""}', "C", '{"other":"z"}']


def test_text_representation(spark):
    rows = [("head", "url words")]
    schema = "i int, v string, u string"
    for mode, expected in [
        ("headline_only", "head"),
        ("url_only", "url words"),
        ("headline_plus_url", "head [SEP] url words"),
    ]:
        assert evaluate(spark, rows, text.fields_text(V, F.col("u"), mode), schema=schema) == [expected]
    with pytest.raises(ValueError):
        text.fields_text(V, V, "both")
