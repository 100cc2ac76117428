"""Column functions on single values."""

import random
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from leadsieve.functions import domains as D, html as H, text as X

c = F.col


def one(spark, fn, *values, types=None):
    types = types or ["string"] * len(values)
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(fn(*[c(f"c{i}") for i in range(len(values))]).alias("v")).first().v


def column(spark, fn, values, type_="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
    return [r.o for r in df.select("i", fn(c("v")).alias("o")).orderBy("i").collect()]


HOSTS = {
    "stripe.com": "stripe.com", "https://www.Shopify.com/": "www.shopify.com",
    "f@intercom.com": "intercom.com", "deliveroo.co.uk": "deliveroo.co.uk", "": "", "N/A": "",
    None: "", "--": "", "localhost": "", "two words.com": "", "//cdn.x.io/a?b#c": "cdn.x.io",
    "http://x.com:8080?y": "x.com", '"quoted.com"': "quoted.com", "..dots.com.": "dots.com",
    " spaced.com　": "spaced.com", "x.c": "", "x.123": "", "user:pw@h.com/p": "h.com",
}


def test_normalize_domain(spark):
    assert column(spark, D.normalize_domain, list(HOSTS)) == list(HOSTS.values())


def test_international_hosts_match_idna_2003(spark):
    names = ["bücher.de", "straße.de", "日本.jp", "ｅｘ.com", "café.example.org",
             "a..ü.com", "ü" * 70 + ".com", "x.日本"]

    def expected(name):
        try:
            host = name.encode("idna").decode("ascii")
        except UnicodeError:
            return ""
        return host if host.rsplit(".", 1)[-1].isalpha() else ""

    assert column(spark, D.normalize_domain, names) == [expected(n) for n in names]


def test_candidate_urls(spark):
    assert one(spark, D.candidate_urls, "x.com") == ["https://x.com", "https://www.x.com", "http://x.com"]
    assert one(spark, D.candidate_urls, "www.x.com") == ["https://www.x.com", "https://x.com", "http://www.x.com"]
    assert one(spark, D.candidate_urls, "") == []


def test_registrable(spark):
    cases = {"a.b.shop.co.uk": "shop.co.uk", "shop.co.uk": "shop.co.uk", "co.uk": "co.uk",
             "..www.x.com": "x.com", "x": "x", "": "", "A.B.Com": "b.com"}
    assert column(spark, D.registrable, list(cases)) == list(cases.values())
    assert one(spark, D.same_site, "a.x.com", "www.x.com") is True
    assert one(spark, D.same_site, "", "") is False


def test_collapse_follows_unicode_spaces(spark):
    text = "a​b    c\x1cd\x85e­﻿  "
    assert one(spark, X.collapse, text) == "ab c d e"
    rng = random.Random(7)
    alphabet = "ab \t\n  　​\x1f\x0b"
    texts = ["".join(rng.choice(alphabet) for _ in range(30)) for _ in range(200)]
    expected = [" ".join(t.replace("​", "").split()) for t in texts]
    assert column(spark, X.collapse, texts) == expected


def test_numbers(spark):
    cases = {"about 1,250 people": 1250.0, "-3.5x": -3.5, "none": None, "": None, "7.": 7.0, None: None}
    assert column(spark, X.to_number, list(cases)) == list(cases.values())


def test_phrases_follow_list_order(spark):
    assert one(spark, lambda t: X.first_phrase(t, ["zebra", "apple"]), "apple then zebra") == "zebra"
    assert one(spark, lambda t: X.first_phrase(t, ["zebra", "apple"]), "none") == ""


def test_content_words(spark):
    assert one(spark, X.content_words, "Home about freight Freight load-matching an ok") == 2


def test_rounding_is_half_even_on_the_exact_value(spark):
    numbers = [0.125, 0.145, 0.375, 0.005, 0.115, 0.5, 1.0, 0.0]
    assert column(spark, lambda v: X.fixed(v, 2), numbers, "double") == ["%.2f" % n for n in numbers]
    assert column(spark, lambda v: X.rounded(v, 2), numbers, "double") == [round(n, 2) for n in numbers]


@pytest.mark.parametrize("code, error, want", [
    (403, "", "blocked"), (429, "", "blocked"), (404, "", "http_4xx"), (503, "", "http_5xx"),
    (0, "Read timed out", "timeout"), (None, "getaddrinfo failed", "dns_fail"),
    (None, "could not resolve host", "dns_fail"), (None, None, "conn_fail")])
def test_classify_fetch(spark, code, error, want):
    assert one(spark, X.classify_fetch, code, error, types=["int", "string"]) == want


def test_links_resolve_like_a_browser(spark):
    rng = random.Random(3)
    parts = ["a", "b.html", "..", ".", "", "services", "x;p=1"]
    bases = ["https://x.com/a/b", "https://x.com/", "https://x.com", "http://x.com/a/b/c/?q=1"]
    rows = []
    for _ in range(300):
        href = rng.choice(["", "/", "//y.org/", "https://z.com/", "http://x.com/"]) + "/".join(
            rng.choice(parts) for _ in range(rng.randint(1, 4))) + rng.choice(["", "?k=v", "/"])
        rows.append((rng.choice(bases), href))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b string, h string")
    got = [r.v for r in df.select("i", D.resolve_link(c("b"), c("h")).alias("v")).orderBy("i").collect()]
    for (base, href), link in zip(rows, got):
        url = urlparse(urljoin(base, href))
        assert link == f"{url.scheme}://{url.netloc}{url.path.rstrip('/')}", (base, href)


def test_subpages_stay_on_site_and_skip_boilerplate(spark):
    links = ["https://elsewhere.com/about", "/services", "https://x.com/careers", "mailto:a@x.com",
             "https://sub.x.com/products", "/privacy", "/services/", "/", "/team.pdf"]
    picked = one(spark, D.pick_subpages, links, "https://x.com/", "x.com",
                 types=["array<string>", "string", "string"])
    assert picked == ["https://x.com/services", "https://sub.x.com/products", "https://x.com/careers"]


def test_score_path(spark):
    cases = {"/about": 8, "/a/b/c/about": 6, "/blog": 0, "/SERVICES/pricing": 9}
    assert column(spark, D.score_path, list(cases)) == list(cases.values())


def test_path_of(spark):
    cases = {"https://x.com": "/", "https://x.com/a?b": "/a?b", "http://x.com/" + "y" * 90: "/" + "y" * 59}
    assert column(spark, D.path_of, list(cases)) == list(cases.values())


def test_markdown(spark):
    bs = "\\"
    md = f"## Our cranes\n\nSee [the fleet](http://f/){bs}{bs} now, 30{bs}% more{bs}!\n"
    df = spark.createDataFrame([("https://x.com/", md, " T ", "D")],
                               "url string, markdown string, title string, description string")
    page = H.page_from_markdown(df).first()
    assert (page.title, page.description, page.headings) == ("T", "D", ["Our cranes"])
    assert page.text == "Our cranes See the fleet now, 30% more!"
    table = "before\n| a | b |\n---\n![i](u) **bold** `code`\n## Second `x`\n#### fourth"
    assert one(spark, H.markdown_text, table) == "before bold code Second x fourth"
    assert one(spark, H.markdown_headings, table) == ["Second x"]


def test_only_the_host_decides_on_idna(spark):
    from leadsieve.functions.domains import normalize_domain
    long = "a" * 64 + ".com"
    df = spark.createDataFrame([("a..com/\u00fc",), ("a..com/u",), (long + "/\u00fc",), ("b\u00fc.de",)], "cell string")
    assert [r[0] for r in df.select(normalize_domain(df["cell"])).collect()] == ["a..com", "a..com", long, "b\u00fc.de".encode("idna").decode()]


def test_keys_whose_order_is_null_keep_a_record(spark):
    from leadsieve.operators.selection import first_by, latest_by
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 1, "z")], "k string, seq int, v string")
    for pick in (first_by, latest_by):
        assert {(r.k, r.v) for r in pick(df, "k", "seq").collect()} == {("a", "x"), ("b", "z")}
