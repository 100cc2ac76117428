from pyspark.sql import functions as F

from leadsieve.functions.domains import offdomain_mark
from leadsieve.plans.campaign import crawl_results
from leadsieve.sources.pages import linked_pages

HOME = '<p>Home</p><a href="/blog/x/y/z">b</a><a href="/About-us/">a</a><a href="https://jobs.a.com/services">c</a><a href="/pricing">p</a><a href="https://b.com/about">o</a>'


def test_offdomain_mark(spark):
    rows = [("a.com", "https://www.a.com:8080/x", ""), ("a.com", "http://b.org/", "redirect_offdomain:b.org"), ("a.com", "a.com/x", ""),
            ("a.com", "", ""), ("a.com", None, ""), ("shop.co.uk", "https://other.co.uk/", "redirect_offdomain:other.co.uk")]
    for r in spark.createDataFrame(rows, "d string, u string, mark string").select("*", offdomain_mark(F.col("d"), F.col("u")).alias("m")).collect():
        assert r.m == r.mark, r


def test_links_of_the_homepage_choose_the_pages(spark):
    rows = [(1, "https://a.com/", HOME, 1), (2, "https://a.com/About-us?x=1", "<p>old</p>", 1), (2, "https://a.com/About-us?x=1", "<p>new</p>", 2),
            (3, "https://jobs.a.com/services", "<p>jobs</p>", 1), (4, "https://a.com/unlinked", "<p>no</p>", 1),
            (5, "https://a.com/pricing", "<p></p>", 1), (None, "https://a.com/About-us", "<p>later</p>", 9),
            (6, "https://b.com/about", "<p>b</p>", 1), (7, None, HOME, 1), (8, "no url", HOME, 1), (9, "https://c.com", None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, version long")
    got = linked_pages(pages).collect()
    found = {d: [(r.url, r.text) for r in sorted((r for r in got if r.domain == d), key=lambda r: r.place)] for d in {r.domain for r in got}}
    assert found["a.com"] == [("https://a.com/", "Home b a c p o"), ("https://jobs.a.com/services", "jobs"), ("https://a.com/About-us?x=1", "new")]
    assert found["jobs.a.com"] == [("https://jobs.a.com/services", "jobs")] and set(found) == {"a.com", "jobs.a.com", "b.com", "c.com"}
    few = linked_pages(pages, spark.createDataFrame([("a.com",), ("a.com",), ("z.com",)], "domain string"), 2).collect()
    assert sorted((r.domain, r.place) for r in few) == [("a.com", 0), ("a.com", 1)]
    assert linked_pages(pages.limit(0)).count() == 0


def test_results_tell_of_redirects_to_another_owner(spark):
    rows = [("old.com", 1, "https://new.org/", HOME), ("a.com", 2, "https://www.a.com/", HOME)]
    pages = spark.createDataFrame(rows, "asked string, page_id long, url string, html string")
    for links in (False, True):
        got = {r.domain: r.error for r in crawl_results(pages, links=links).collect()}
        assert got == {"old.com": "redirect_offdomain:new.org", "a.com": ""}
