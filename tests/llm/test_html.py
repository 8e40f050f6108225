"""Main text: exact results on small pages, and the scan against all runs."""

import random
import re
import time

from opsloom.llm import html
from opsloom.llm.queries import queries

PROSE = "A sentence of the article with quite a few words in it. "


def text(source):
    return html.main_text(source, {"w:p": 3.0, "t:p": -0.02, "w:a": -1.0})


def test_best_run_against_all_runs():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-2, -1, -0.5, 0.5, 1, 3]) for _ in range(rng.randrange(12))]
        begin, end = html.best_run(scores)
        runs = [sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)]
        assert abs(sum(scores[begin:end]) - max(runs)) < 1e-9


def test_article_with_everything_around_it():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies.</div>
    <main><aside>Side</aside><article><h1>Title &amp; more</h1><p><b>First&nbsp;{PROSE}<br>same  block<p>Second &lt;one&gt; &#233;
    <div class="ad-slot">Buy!</div><form><label>Mail</label><input><button>Go</button></form><ul><li>one<li>two</ul>
    <table><tr><td>a<td>b<tr><td>c</table><!-- <p>no</p> --><p hidden>hidden</p><pre>x
      y</pre><section class="comments"><p>Reader: {PROSE}</p></section><p>Last.</p></article></main>
    <div class="sidebar">{PROSE}</div><footer>&copy; us</footer></body></html>"""
    assert text(page).split("\n\n") == [
        "Title & more", f"First {PROSE}same block", "Second <one> é", "one", "two", "a b", "c", "x y", "Last.",
    ]


def test_an_article_loses_no_words_to_the_weights():
    weights = {"w:p": 3.0, "w:td": -3.0, "w:li": -3.0, "t:p": -1.0, "t:td": -1.0, "t:a": -1.0, "t:h1": -1.0, "t:table": -1.0}
    link = "<a href='/'>More</a>"
    cells = "<tr><td>only cells of a<td>table here" * 30
    first, middle, last = f"<h1>{link}</h1><div class='share'>Share</div>", f"<p>{link}</p><table>{cells}</table>", f"<ul><li>{link}</ul><p>{link}</p>"
    page = f"<div>Outside {PROSE}</div><article>{first}<p>{PROSE}</p>{middle}<p>{PROSE}</p>{last}</article><div>Outside {PROSE}</div>"
    rows = ["only cells of a table here"] * 30
    expected = ["More", PROSE.strip(), "More", *rows, PROSE.strip(), "More", "More"]
    for learned in (weights, {}):
        assert html.main_text(page, learned).split("\n\n") == expected
    assert html.main_text(f"<p>{PROSE}</p><article><h1>{link}</h1></article>", weights) == "More"


def test_page_without_an_article_element():
    links = "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p></div><div><a>More</a> <a>links</a></div></body>"
    assert text(page) == f"Head\n\n{PROSE.strip()}\n\n{PROSE.strip()}"


def test_broken_pages():
    assert text(None) == text("") == text("   ") == text("<html></html>") == text("<script>x") == ""
    assert text("plain words only") == "plain words only"
    assert text("<article><p>open <b>tags") == "open tags"
    assert text("<article><p>a < b and c > d</article>") == "a < b and c > d"
    assert text('<article><p class="x>lost</article>').endswith("lost")
    assert text("<article>" + "<div>" * 5000 + "deep" + "</x>" * 5000 + "</article>") == "deep"
    assert len(text("<article><p>" + "word " * 200_000)) == 999_999


def test_hostile_pages_take_linear_time():
    n = 1_000_000
    pages = ["<a ", '<p x="', "<", "<a", "</a", '<a "" ', "<a '\"' ", '<!-- ', "<a x=y ", "<!"]
    for bit in pages:
        for end in ("", ">", '"', '">"', "-->"):
            source = bit * (n // len(bit)) + end
            began = time.process_time()
            html.main_text(source, {})
            assert time.process_time() - began < 5, (bit, end)
    assert text("a <i>e</i> < d <a x='>' \">\"") == "a e < d <a x='>' \">\""


def test_rows_and_clashing_columns(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</article>", "x"), (1, "u", f"<article><p>{PROSE}</article>", "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html.extract(pages).collect()
    assert [r.text for r in out] == ["x", "x", None] and [r._text for r in out] == [PROSE.strip()] * 2 + [""]
    assert html.extract(pages.limit(0)).count() == 0
    own = html.extract(pages.withColumnRenamed("text", "_text"), weights={})
    assert own.columns == ["page_id", "url", "_text"] and own.first()._text == PROSE.strip()


def test_query(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = queries()["op1_main_text"](spark, sf).collect()
    assert len(out) == len(pages) and all(r.n_chars == len(r.text) for r in out)
    for r in out:
        assert r.text and "<p" not in r.text and "©" not in r.text and "\n\n\n" not in r.text
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        assert abs(sum(map(str.isalpha, r.text)) - sum(map(str.isalpha, re.sub(r"<[^>]+>|&\w+;", "", body)))) <= 60
