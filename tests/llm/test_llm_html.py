"""Main text of pages: hand-written pages, the scan against all stretches, odd tables."""

import pytest
from hypothesis import given
from hypothesis import strategies as st

from claimloom.llm import html_text
from claimloom.llm.html_text import Weights, best_stretch, extract_text, main_text

PROSE = "Once there was a long story about a river and the people beside it. " * 3
CLEAN = " ".join(PROSE.split())

PAGES = {
    "article": (
        f"<html><head><title>T x</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body><nav><ul>"
        f"<li><a href=/a>Home</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy now.</div><article><h1>A &amp; B</h1>"
        f"<p>{PROSE}</p><p>two\n  lines<br>here</p></article><footer>&copy; me</footer></body></html>",
        f"A & B\n\n{CLEAN}\n\ntwo lines here",
    ),
    "inside the article": (
        f"<article><h2>T</h2><p>{PROSE}</p><aside>side</aside><div class='advert box'>buy</div><form>name <input></form>"
        f"<div id=cookie-notice>We use cookies</div><ul><li><a href=x>one</a><li>two</ul>"
        f"<section class=comments><p>First! {PROSE}</p></section></article><article class=comment>no</article>",
        f"T\n\n{CLEAN}\n\none\n\ntwo",
    ),
    "no article": (
        f"<body><div id=header>Site name</div><div class=sidebar-left><p>{PROSE}</p></div><div id=c><h1>T</h1>"
        f"<p>{PROSE}<p>and <b>so</b> on</div><div class=footer-links><a href=a>x</a></div></body>",
        f"T\n\n{CLEAN}\n\nand so on",
    ),
    "main": (f"<p>{PROSE}</p><main><p>just this</p></main><p>{PROSE}</p>", "just this"),
    "form around": (f"<form id=f><div class=nav>x</div><article><p>kept</p></article></form>", "kept"),
    "references": ("<p>&lt;p&gt; &eacute;&#233;&#xE9;&nbsp;x &amp;lt; &unknown; &amp &copy</p>", "<p> ééé x &lt; &unknown; & ©"),
    "joined": ("<p>foo<b>bar</b><!-- x -->baz<i> q</i></p>", "foobarbaz q"),
    "span": ("<p>a <span class=ad>x <span>y</span> z</span> b</p>", "a b"),
    "quotes": ("""<p title="a>b" data-x='>'>t</p><p title="open>u</p>""", "t\n\nu"),
    "not tags": ("<p>1 < 2 and a<3 <> </ x></p>", "1 < 2 and a<3 <> </ x>"),
    "unclosed": ("<div><p><b>one<br><p>two<li>three<script>no", "one\n\ntwo\n\nthree"),
    "cut in a tag": ("<p>one</p><p cla", "one"),
    "stray ends": ("</div></p></article><p>one and some more</b></i></p></section>two three", "one and some more\n\ntwo three"),
    "upper case": ("<P>one<SCRIPT>x</Script><BR>two</P><NAV>no</NAV>", "one two"),
    "nothing": ("<nav>menu</nav><script>x</script>", ""),
    "plain": ("just  text", "just text"),
    "empty": ("", ""),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, want = PAGES[name]
    assert main_text(page, Weights()) == want


@given(st.lists(st.integers(-4, 4)))
def test_scan(scores):
    sums = [(sum(scores[i:j]), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    best = max((s for s, _, _ in sums), default=0)
    start, stop = best_stretch(scores)
    if best <= 0:
        assert (start, stop) == (0, 0)
    else:
        assert sum(scores[start:stop]) == best
        assert not any(s == best and j < stop for s, _, j in sums)


@given(st.text(alphabet="<>/!-'\"= aptdivscrx&;", max_size=60))
def test_no_page_breaks_it(page):
    text = main_text(page, Weights())
    assert text == "\n\n".join(" ".join(b.split()) for b in text.split("\n\n"))


def test_weights_are_learnt(spark):
    """Links and an unknown class of boxes stand outside articles, so they end a stretch."""
    boxes = "<div class=q7>" + "<a href=x>word</a> " * 6 + "</div>"
    labelled = [f"{boxes}<article><p>{PROSE} {n}</p></article>{boxes}" for n in range(30)]
    rows = [(n, "u", p, n) for n, p in enumerate(labelled + ["<article>a</article><article>b</article>", None, ""])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    weights = html_text.learn_weights(pages)
    assert "div.q7" in weights.out and weights.word > 0 and all(w < 0 for w in weights.tags.values())
    # A page without marks, with a box of that class and a list of links of none.
    page = f"{boxes}<div><p>{PROSE}</p></div>{boxes}"
    assert main_text(page, weights) == CLEAN
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert [got[n] for n in range(30)] == [f"{CLEAN} {n}" for n in range(30)]
    assert (got[30], got[31], got[32]) == ("a\n\nb", "", "")
    # A sample of the pages gives weights too, the same however the table is cut.
    some = html_text.learn_weights(pages, sample=10)
    assert some == html_text.learn_weights(pages.repartition(7), sample=10)


def test_odd_tables(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    rows = [(1, None, "<p>x</p>", 1), (1, None, "<p>x</p>", 1), (None, "u", None, 2), (2, "u", long, 3), (3, "", "", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted((r.page_id or 0, r.url, r.text[:4], r.n_chars) for r in got.collect())
    assert found == [(0, "u", "", 0), (1, None, "x", 1), (1, None, "x", 1), (2, "u", "word", 999_999), (3, "", "", 0)]
    assert extract_text(pages.limit(0)).count() == 0
