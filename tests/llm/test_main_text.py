"""Main text: the cut against all labellings, hand-made pages, the sample pages read by their markup."""

from __future__ import annotations

import html
import random
import re
from itertools import product

from millrace.llm import main_text as M
from millrace.llm import queries

PAGE = """<!DOCTYPE html><html><head><title>Not me</title><style>p{}</style><script>var a = "<p>no</p>";</script>
<body class="search-page"><header class="site"><a href="/">Home</a><h1>Site name</h1></header><nav><ul><li>One<li>Two</ul></nav>
<div class="cookie-notice"><p>We use cookies on this site, and we would like you to agree to all of them.</p></div>
<div id="wrap"><div class="sidebar"><h3>Popular</h3><ul><li><a href="/x">A long list of links</a></li></ul></div>
<article class="post"><header><h1>The &eacute;t&#233;  title</h1></header><p>First   paragraph,
with <b>bold</b> and <a href="/y">a link</a>.<p>Second&nbsp;one<br>goes on.<ul><li>item one<li>item two</ul>
<div class="ad-slot">Buy now, this is a very good offer for all of you today.</div><p>Yes.</p>
<form><label>Mail</label><input><button>Send</button></form><aside>Aside</aside><blockquote><p>Quoted &lt;words&gt;.</p></blockquote>
<section class="post-comments" id="comments"><h2>Comments</h2><p>What a great article, I have read it twice with pleasure.</p></section>
</article></div><div class="related-posts"><a href="/z">Next</a></div><footer>&copy; 2024 Somebody. All rights reserved, everywhere.</footer>
<!-- <p>comment</p> --><div hidden>Hidden text that nobody sees at all.</div></body></html>"""


def test_hand_made_page():
    assert M.main_text(PAGE).split("\n") == [
        "The été title",
        "First paragraph, with bold and a link.",
        "Second one goes on.",
        "item one",
        "item two",
        "Yes.",
        "Quoted <words>.",
    ]


def test_page_without_article_and_broken_markup():
    text = "This paragraph has quite a number of words in it, so it should be taken for content. "
    page = f"<div class=menu><a href=1>Home</a> <a href=2>News</a></div><div><h2>Heading</h2><p>{text * 3}<p>Short one.<p>{text * 2}</div></div></b><div><a href=3>Imprint</a></div>"
    assert M.main_text(page) == "\n".join(["Heading", (text * 3).strip(), "Short one.", (text * 2).strip()])
    assert M.main_text(None) == M.main_text("") == M.main_text("<p>") == M.main_text("<script>never closed <p>x</p>") == ""
    assert M.main_text(f"<head><title>t</title><p>{text}") == text.strip()
    assert M.main_text("<article>" + "<b><p>word one two.</p>" * 3) == "word one two.\nword one two.\nword one two."


def test_long_and_deep_pages():
    many = M.main_text("<article>" + "<p>Some words here.</p>" * 20_000 + "</article>")
    assert many.count("\n") == 19_999
    assert M.main_text("<article>" + "<i>" * 20_000 + "<p>Deep words.</p>" * 500).count("Deep") == 500


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(1, 9)
        weights = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.randint(0, 6)) for _ in range(rng.randint(0, 14))]
        edges = [(a, b, c) for a, b, c in edges if a != b]

        def cost(labels, weights=weights, edges=edges):
            lost = sum(abs(w) for w, x in zip(weights, labels) if (w > 0) != x and w)
            return lost + sum(c for a, b, c in edges if labels[a] != labels[b])

        assert cost(M.minimum_cut(weights, edges)) == min(cost(x) for x in product([False, True], repeat=n))


def plain(page):
    """The article of a sample page, split at its block tags."""
    inner = re.sub(r"<!--.*?-->", "", re.search(r"<article>(.*?)(</article>|$)", page or "<article>", re.S)[1], flags=re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner)
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
    return "\n".join(line for line in lines if line)


def test_query_on_whole_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op1_main_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], plain(page["html"]), len(plain(page["html"])))


def test_edge_rows(spark):
    rows = [(1, None, "t", "k"), (2, "", "t", "k"), (None, PAGE, None, "k"), (None, PAGE, None, "k")]
    out = M.extract(spark.createDataFrame(rows, "page_id long, html string, text string, n_chars string")).collect()
    assert [bool(r["text"]) for r in out] == [False, False, True, True] and out[2] == out[3] and out[0]["n_chars"] == "k"
    assert M.extract(spark.createDataFrame([], "html string")).count() == 0
