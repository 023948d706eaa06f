from pyspark.sql import functions as F

from broadsheet.operators import resolve as R
from broadsheet.sources.schemas import CAPTURES

HTML = "text/html; charset=utf-8"
OG = '<meta property="og:title" content="{}">'


def capture(url, stage, status=None, body=None, error=None, variant=0, attempt=0, ctype=HTML, final=None):
    return (url, stage, variant, attempt, status, ctype if status else None, final, body, error, None, 5)


U = {n: f"https://h/{n}-page" for n in ("u1", "u2", "u3", "u4", "u5", "u7", "u8")} | {"u6": "https://h6/"}
ROWS = [
    capture(U["u1"], 1, 200, OG.format("One"), final="https://h/final"),
    capture(U["u2"], 1, 404),
    capture(U["u2"], 1, 200, OG.format("Two"), variant=1),
    capture(U["u2"], 2, 200, OG.format("Not used"), variant=0),
    capture(U["u3"], 1, 403),
    capture(U["u3"], 2, 200, OG.format("Three"), ctype="text/plain"),
    capture(U["u4"], 1, 403),
    capture(U["u4"], 2, 404),
    capture(U["u4"], 3, 200, "Title: Four | Fox News\n"),
    capture(U["u5"], 1, 403),
    capture(U["u5"], 2, None, error="Wayback Timeout: t", final="https://archive/u5"),
    capture(U["u5"], 3, 503, final="https://mirror/u5"),
    capture(U["u6"], 1, 403),
    capture(U["u6"], 2, None, error="Wayback Timeout: t"),
    capture(U["u6"], 3, None, error="Jina Timeout: t"),
    capture(U["u7"], 1, 200, "%PDF", ctype="application/pdf"),
    capture(U["u8"], 1, None, error="Timeout: first"),
    capture(U["u8"], 1, 200, "<p>no headline</p>", attempt=1),
]
EXPECTED = {
    "u1": ("direct_html", True, 200, "", "One"),
    "u2": ("direct_html_variant", True, 200, "", "Two"),
    "u3": ("wayback_html", True, 200, "", "Three"),
    "u4": ("jina_mirror", True, 200, "", "Four"),
    "u5": ("url_slug_fallback", True, 503, "Jina HTTP 503", "u5 page"),
    "u6": ("none", False, 403, "Jina Timeout: t", ""),
    "u8": ("url_slug_fallback", True, 200, "Empty headline after parsing", "u8 page"),
}


def tables(spark):
    urls = spark.createDataFrame([(u,) for u in U.values()] + [(U["u1"],)] * 2, "url string")
    return urls, spark.createDataFrame(ROWS, CAPTURES)


def by_name(df):
    names = {v: k for k, v in U.items()}
    return {names[r.url]: r for r in df.collect()}


def test_stage_order_and_overrides(spark):
    urls, captures = tables(spark)
    got = by_name(R.resolve(urls, captures, allow_url_fallback=True))
    for name, expected in EXPECTED.items():
        r = got[name]
        assert (r.headline_method, r.success, r.status_code, r.error, r.headline) == expected, name
    assert got["u1"].listed == 3 and got["u1"].final_url == "https://h/final"
    assert got["u5"].final_url == "https://mirror/u5"
    assert got["u6"].final_url == U["u6"]


def test_stages_can_be_switched_off(spark):
    urls, captures = tables(spark)
    got = by_name(R.resolve(urls, captures, use_archive=False, use_mirror=False))
    r = got["u7"]
    assert (r.headline_method, r.success, r.status_code, r.error) == (
        "none", False, 200, "Unexpected content type: application/pdf",
    )
    assert (got["u3"].headline_method, got["u3"].error) == ("none", "HTTP 403")


def test_listings_expand_to_rows(spark):
    urls, captures = tables(spark)
    rows = R.expand_listed(R.resolve(urls, captures), chunk=2)
    counts = {r.url: r["count"] for r in rows.groupBy("url").count().collect()}
    assert counts == {u: 3 if u == U["u1"] else 1 for u in U.values()}


def test_url_without_captures(spark):
    urls = spark.createDataFrame([("https://www.nbcnews.com/a/b-c",)], "url string")
    _, captures = tables(spark)
    r = R.resolve(urls, captures, allow_url_fallback=True).first()
    assert (r.headline_method, r.headline, r.status_code, r.error, r.label) == ("url_slug_fallback", "b c", None, "", 1)


def test_single_capture_path_agrees_with_general_path(spark):
    pages = spark.createDataFrame(
        [(1, "https://h/a-b", "<h1>Alpha beta</h1>"), (2, "https://h/c-d", "<p>x</p>"), (3, "https://h/", "")],
        "page_id long, url string, html string",
    )
    captures = pages.select(
        "url", F.lit(1).alias("stage"), F.lit(0).alias("variant"), F.lit(0).alias("attempt"),
        F.lit(200).alias("status_code"), F.lit(HTML).alias("content_type"), F.col("url").alias("final_url"),
        F.col("html").alias("body"), F.lit("").alias("error"),
    )
    columns = ["url", "source", "label", "success", "headline", "headline_method"]
    one = R.resolve_single(pages, allow_url_fallback=True).select(*columns)
    many = R.resolve(pages.select("url"), captures, allow_url_fallback=True).select(*columns)
    assert sorted(one.collect()) == sorted(many.collect())


def test_retryable_statuses(spark):
    df = spark.createDataFrame([(200,), (403,), (404,), (503,), (None,)], "s int")
    assert [r[0] for r in df.select(R.should_retry(F.col("s"))).collect()] == [False, True, False, True, False]


def test_requests_list_variants_in_order(spark):
    urls = spark.createDataFrame([("http://h.org/a/",)], "url string")
    rows = R.capture_requests(urls).orderBy("variant").collect()
    assert [(r.variant, r.request_url) for r in rows] == [
        (0, "http://h.org/a/"), (1, "https://h.org/a/"), (2, "https://h.org/a"),
    ]
