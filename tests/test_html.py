from pyspark.sql import functions as F

from broadsheet.functions import html
from tests.conftest import evaluate

V, S = F.col("v"), F.col("s")

CASES = [
    # page, source, expected
    ('<meta property="og:title" content="Og one"><h1>H</h1>', "Unknown", "Og one"),
    ('<h1>H</h1><meta content=\'Og "two"\' property=og:title>', "NBC", 'Og "two'),
    (
        '<meta property="og:title" content=" | Fox News"><meta name="twitter:title" content="Tw"/>',
        "FoxNews",
        "Tw",
    ),
    ('<meta name="headline" content="Hd"><meta itemprop="headline" content="It">', "Unknown", "Hd"),
    ('<META ITEMPROP="headline" CONTENT="It &amp;amp; up">', "Unknown", "It & up"),
    ('<meta name="og:title" content="no"><h1>A</h1>', "Unknown", "A"),
    ('<meta data-x=\'property="og:title"\' content="no"><h1>A</h1>', "Unknown", "A"),
    ('<meta property="og:title" content="a > b"><h1>A</h1>', "Unknown", "a > b"),
    ('<meta property="og:title"><meta property="og:title" content="second"><h1>A</h1>', "Unknown", "A"),
    ('<h1>First</h1><h1 class="Headline speakable">X <b>y</b></h1>', "FoxNews", "X y"),
    ('<h1>First</h1><h1 class="headline"> </h1>', "FoxNews", "First"),
    ('<h1 class="headline">| Fox News</h1><h1>Other</h1>', "FoxNews", ""),
    ('<h1>A</h1><h1 data-testid="headline">B</h1>', "NBC", "B"),
    ('<h1 data-testid="headline">B</h1><h1 class="x article-hero-headline__htag">C</h1>', "NBC", "C"),
    ('<h1>A</h1><h1 class="headline">B</h1>', "Unknown", "A"),
    ("<p>nothing</p>", "Unknown", ""),
    ("<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><style>h1{}</style><h1>yes</h1>", "Unknown", "yes"),
    ("<h1>a<br>b<!-- c --> 1 < 2</h1>", "Unknown", "a b 1 < 2"),
    ("<H1\n id='x'>up &eacute; | NBC News</H1 >", "Unknown", "up é"),
    ("<h1>open <i>ended", "Unknown", "open ended"),
    ("<h10>no</h10>", "Unknown", ""),
    ("", "Unknown", ""),
]


def test_extraction_order(spark):
    got = evaluate(
        spark, [(p, s) for p, s, _ in CASES], html.extract_headline(V, S), schema="i int, v string, s string"
    )
    assert got == [e for _, _, e in CASES]


def test_hostile_page_is_linear(spark):
    pages = ["<meta " + "a=\"" * 50_000, "<h1 " + "x " * 100_000, "<!--" * 50_000, "<h1>" + "<" * 100_000]
    got = evaluate(spark, [(p, "NBC") for p in pages], html.extract_headline(V, S), schema="i int, v string, s string")
    assert len(got) == 4


def test_mirror_title(spark):
    values = ["x\nTitle:  Big &amp; bold | Fox News\nURL: u\n", "Title: no newline", "no Title: here\n", ""]
    assert evaluate(spark, values, html.mirror_title(V)) == ["Big & bold", "", "", ""]
