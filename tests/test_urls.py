from pyspark.sql import functions as F

from broadsheet.functions import urls
from tests.conftest import evaluate

V = F.col("v")


def test_host_rules(spark):
    cases = [
        "https://WWW.FoxNews.com:443/x",
        "foxnews.com/x",
        "https://notfoxnews.com.example.org/x",
        "https://example.org/x",
        "http://nbcnews.com",
        "//www.nbcnews.com/a",
        "https://u:p@www.foxnews.com/a b|c%",
    ]
    assert evaluate(spark, cases, urls.label_from_host(V)) == [0, None, 0, None, 1, 1, 0]
    assert evaluate(spark, cases, urls.source_from_host(V)) == [
        "FoxNews", "Unknown", "FoxNews", "Unknown", "NBC", "NBC", "FoxNews",
    ]


def test_parts(spark):
    url = ["https://H:8/a/b;p=1?q=1#f", "https://h/a;x/b", "a/b?c", "https://h?x=1"]
    assert evaluate(spark, url, urls.path(V)) == ["/a/b", "/a;x/b", "a/b", ""]
    assert evaluate(spark, url, urls.query(V)) == ["q=1", "", "c", "x=1"]
    assert evaluate(spark, url, urls.authority(V)) == ["h:8", "h", "", "h"]


def test_url_words(spark):
    cases = {
        "https://h/us/big-storm_2024.print?x=1#f": "us big storm 2024",
        "https://h/a.html-b/caf%C3%A9+x": "a b café+x",
        "https://h/a/b;p=1": "a b",
        "https://h/a%zzb": "a%zzb",
        "https://h/": "",
        "https://h/a&amp;b": "a&",
        "https://h/a%26amp%3Bb": "a&b",
        "https://h/100%": "100%",
    }
    assert evaluate(spark, list(cases), urls.url_words(V)) == list(cases.values())


def test_slug(spark):
    cases = {
        "https://h/us/big-storm.HTML.print": "big storm",
        "https://h/us/big-storm.print.html": "big storm.print",
        "https://h/a/caf%C3%A9-x/": "caf%C3%A9 x",
        "https://h/": "",
        "https://h": "",
    }
    assert evaluate(spark, list(cases), urls.slug_headline(V)) == list(cases.values())


def test_variants(spark):
    cases = {
        "http://foxnews.com/a.print?q=1#f": [
            "http://foxnews.com/a.print?q=1#f",
            "https://www.foxnews.com/a.print?q=1",
            "https://www.foxnews.com/a.print",
            "https://www.foxnews.com/a?q=1",
            "https://www.foxnews.com/a",
            "https://www.foxnews.com/a.print/?q=1",
        ],
        "https://www.nbcnews.com/a/": ["https://www.nbcnews.com/a/", "https://www.nbcnews.com/a"],
        "https://h.org": ["https://h.org", "https://h.org/"],
        " https://h.org/a?b ": ["https://h.org/a?b", "https://h.org/a", "https://h.org/a/?b"],
    }
    assert evaluate(spark, list(cases), urls.url_variants(V)) == list(cases.values())
