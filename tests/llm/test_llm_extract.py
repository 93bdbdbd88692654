import random
import time

import pytest

from listingloom.llm import extract
from listingloom.llm.extract import Weights, best_run, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Site</a></header><nav><ul>NAV</ul></nav>
<div class="cookie-notice">We use cookies</div>
<article class="post"><h1>Head &amp; line</h1><p>First <b>bold</b>
 text&nbsp;here<br>after break<p>Second &lt;p&gt; &#233;
<aside>Aside</aside><div class="ad-slot">Buy now</div><form>Name <input></form>
<ul><li>Item one<li>Item <a href="x">two</a></ul><p>Last one.</p></article>
<div class="comments"><article class="comment"><p>I disagree with this long comment text</p></article></div>
<footer>&copy; foot</footer></body></html>""".replace("NAV", '<li><a href="/a">A</a></li>' * 60)
TEXT = "Head & line\nFirst bold text here\nafter break\nSecond <p> é\nItem one\nItem two\nLast one."


@pytest.fixture(scope="module")
def weights():
    return extract.weights_of(extract.count_features(PAGE))


def test_marked_article(weights):
    assert main_text(PAGE, weights) == TEXT
    assert main_text(PAGE, Weights()) == TEXT


@pytest.mark.parametrize("name", ["site right-sidebar", "sidebar-layout", "nav-open", "layout--right-rail", "hfeed widget"])
def test_wrappers_named_after_what_they_also_hold(weights, name):
    side = f"<div class='sidebar'>{'Side words here. ' * 3}</div>"
    teaser = "<div class='related'><article><p>Read this too</p></article></div>"
    body = "<h1>Head</h1><p>First words of the text.</p><div class='promo'>Buy</div><p>Last words.</p>"
    for first, last in (("<article>", "</article>"), ("<main>", "</main>")):
        page = f"<body><div id=page class='{name}'>{first}{body}{last}{side}{teaser}</div></body>"
        assert main_text(page, weights) == "Head\nFirst words of the text.\nLast words."
    inside = f"<article><div class='{name}'>{body}</div></article>"
    assert main_text(inside, weights) == "Head\nFirst words of the text.\nLast words."
    unmarked = f"<div class='{name}'><p>{'Long text of many words. ' * 9}</p>{side}</div>"
    assert main_text(unmarked, weights) == ("Long text of many words. " * 9).strip()


def test_unmarked_page_gets_its_best_run(weights):
    page = (
        "<body><ul><li><a href=1>one</a><li><a href=2>two</a></ul><div id=main><h2>Title here</h2><p>Some long text of "
        "many words</p><div class='advert'>x</div><p>and more words to read</p></div><ul><li><a>more links</a></ul>"
    )
    assert main_text(page, weights) == "Title here\nSome long text of many words\nand more words to read"


def test_best_run_equals_all_runs():
    pick = random.Random(7)
    for _ in range(200):
        scores = [pick.randint(-5, 5) for _ in range(pick.randint(0, 14))]
        runs = [(sum(scores[a:b]), a, b) for a in range(len(scores)) for b in range(a, len(scores) + 1)]
        start, end = best_run([float(s) for s in scores])
        assert sum(scores[start:end]) == max([0, *(r[0] for r in runs)])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain words", "plain words"), ("a < b and c", "a < b and c"),
        ("<!-- <p>x</p> -->y", "y"), ("<p title='a>b'>z</p>", "z"), ("<p>cut off <b", "cut off"),
        ("<script>x", ""), ("<textarea><p>no</textarea><p>yes", "yes"), ("<P>UP</P>", "UP"),
        ("<div hidden>h</div><p>seen", "seen"), ("<p>&am; &nosuchname; &#0; x", "&am; &nosuchname; � x"),
    ],
)
def test_odd_markup(weights, page, text):
    assert main_text(page, weights) == text


def test_deep_and_long_pages(weights):
    assert main_text("<b>" * 5000 + "deep", weights) == "deep"
    assert main_text("<div>" * 5000 + "deep words", weights) == "deep words"
    long_page = "<article>" + "<p>one two three</p>" * 100_000 + "</article>"
    assert main_text(long_page, weights).count("\n") == 99_999
    assert main_text("<a " * 20_000, weights) == ""


@pytest.mark.parametrize("piece", ["<b></i>", "<b>", "</i>", "<b><hr>", "<p></li>", "<div></p>", "<li><a>x"])
def test_time_is_that_of_the_page(piece):
    """200,000 stray, nested or repeated tags."""
    page = piece * (200_000 // piece.count("<"))
    started = time.time()
    extract.pieces_of(page)
    assert time.time() - started < 6


def test_sample_is_of_marked_pages(spark):
    """Few pages mark their article; all of these are learnt from, whatever the number of others."""
    plain = [(n, f"<body><h3>{n} words</h3></body>") for n in range(3000)]
    marked = [(n, f"<body><article><h3>said {n} said</h3></article><li>menu {n}</li></body>") for n in range(30)]
    weights = extract.fit(spark.createDataFrame(plain + marked, "page_id long, html string"))
    alone = extract.fit(spark.createDataFrame(marked, "page_id long, html string"))
    assert weights == alone and weights.blocks["h3"] > 2


def test_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract.extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, got.collect())) == sorted(
        map(str, [got.sparkSession.createDataFrame([r], got.schema).first() for r in [
            (1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "", 0)]])
    )
    assert extract.extract_pages(df.where("1 = 0")).count() == 0


def test_queries_pages_have_their_articles(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract.extract_pages(pages).collect()}
    for row in pages.collect():
        inside = re.search("<article>(.*)</article>", row["html"], re.S)[1]
        blocks = re.sub(r"</?(?:p|h1|br)>", "\0", inside)
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks.split("\0"))
        assert got[row["page_id"]] == "\n".join(x for x in lines if x)
