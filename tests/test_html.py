"""HTML extraction: cases with results written by hand, and properties of nested hidden elements."""

import random
import time

import pytest

from leadsieve import constants as C
from leadsieve.functions.html import parse_html

#: markup, title, description, headings, text, links
CASES = [
    ("", "", "", [], "", []),
    ("<title>A &amp; B&nbsp;</title><body>x<p>y</p></body>", "A & B", "", [], "x y", []),
    ("<head><title>T</title><meta name='description' content=\"a &quot;b&quot;  c\"></head>body", "T", 'a "b" c', [], "body", []),
    ("<nav><a href='/a?x=1&amp;y=2'>n</a><aside>in</aside>still</nav>shown", "", "", [], "shown", ["/a?x=1&y=2"]),
    ("<h2 class=\"a>b\">He<b>l</b>lo</h2>", "", "", ["He l lo"], "He l lo", []),
    ("<p>open</p><nav>hidden <p>rest", "", "", [], "open", []),
    ("<title>One</title>x<title>Two</title>y", "OneTwo", "", [], "x y", []),
    ("</nav></nav>x<nav>y</nav>z", "", "", [], "x z", []),
    ("<meta property='og:description' content=''><meta name=Description content='second'>"
     "<meta name=description content=third>", "", "second", [], "", []),
    ("<a title='it' href=foo/bar>q</a><a HREF = \"b c\">r</a><a>n</a><a href=''>e</a>", "", "", [], "q r n e", ["foo/bar", "b c"]),
    ("<script>if(a<b){'</p>'}</script><!-- c <b> -->tail", "", "", [], "tail", []),
    ("a&amp;amp;b &#233; &#x41;.", "", "", [], "a&amp;b é A.", []),
    ("<h1>" + "x" * C.HEADING_LIMIT + "</h1>", "", "", [], "x" * C.HEADING_LIMIT, []),
    ("<h2>k</h2>" * (C.MAX_HEADINGS + 3), "", "", ["k"] * C.MAX_HEADINGS, " ".join(["k"] * (C.MAX_HEADINGS + 3)), []),
]


def parsed(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    return {r.i: r for r in parse_html(df).collect()}


def test_cases(spark):
    got = parsed(spark, [c[0] for c in CASES])
    for i, (markup, *want) in enumerate(CASES):
        r = got[i]
        assert [r.title, r.description, r.headings, r.text, r.links] == want, markup


def nested(rng, depth):
    """A balanced hidden element."""
    tag = rng.choice(["nav", "aside", "form"])
    inner = "".join(nested(rng, depth - 1) if rng.random() < 0.5 else "no " for _ in range(rng.randint(0, 3))) if depth else "no"
    return f"<{tag}>{inner}</{tag}>"


@pytest.mark.parametrize("ending", ["", "<nav>never <p>closed"])
def test_only_text_outside_hidden_elements_is_seen(spark, ending):
    rng, pages, want = random.Random(3), [], []
    for k in range(200):
        words, parts = [], ["</nav>", "</aside></form>"][:k % 3]  # ends without a start change nothing
        for n in range(rng.randint(0, 8)):
            parts.append(nested(rng, 3))
            if rng.random() < 0.7:
                words.append(f"yes{n}")
                parts.append(f"<p>yes{n}</p>")
        pages.append("".join(parts) + ending)
        want.append(" ".join(words))
    got = parsed(spark, pages)
    assert [got[k].text for k in range(len(pages))] == want


def test_broken_markup_stays_linear(spark):
    n = 100000
    bad = ["<a " * n, "<h1 " * n, "<h1>" * n, "<nav " * n, "<title " * n, "<title>" * n, "<!--" * n, "<script " * n,
           "<a x=\"y\" " * n + "<div class='" + "z" * n, "<" * n + ">", "<a x='" * n, "&" * n, "&#" * n, "</h1" * n,
           "<nav>" * n, "<nav></nav>x" * n, "</nav>x" * n, "<nav><nav><nav><nav></nav></nav></nav></nav>x" * 20000, " \u200b" * n, "<meta name=" * n, "<a href=x " * n + ">", "<svg/>" * 3000]
    df = spark.createDataFrame(list(enumerate(bad)) + [(99, "<p>" * n + "t")], "i int, html string").repartition(4)
    started = time.time()
    got = {r.i: r.text for r in parse_html(df).collect()}
    assert len(got) == len(bad) + 1 and got[99] == "t"
    assert time.time() - started < 60
