"""The gate and the digest on invented sites."""

import pytest
from pyspark.sql import functions as F

from leadsieve.functions.html import PAGE_TYPE
from leadsieve.operators.gate import build_digest, quality_gate
from leadsieve.operators.sites import assemble_sites, first_pages
from leadsieve.plans.campaign import crawl_results

COPY = ("Harbor crane rental for inland ports across five river basins. Crews rig, lift and place turbine "
        "blades, locomotives, pressure vessels and bridge girders under certified engineering plans. Founded "
        "beside the old shipyard, the company maintains forty crawler cranes, floating derricks and hydraulic "
        "gantries, with dispatchers scheduling barges, escorts, permits and night shifts for demanding clients. "
        "Insurance surveyors inspect every sling before departure.")


def page(url="https://acme.com/", title="", text="", description="", headings=()):
    return (url, title, description, list(headings), text, 200)


ABOUT = page("https://acme.com/about", "Our story", "Two brothers bought the first barge in spring.")
CASES = {
    "real_multipage": ("ok", [page(title="Acme Crane Rental", description="Lifting crews", headings=["Heavy lifts"], text=COPY), ABOUT], "pass"),
    "parked_for_sale": ("ok", [page(title="acme.com", text="Buy this domain now. " + "Offers welcome. " * 9)], "parked:buy_this_domain"),
    "js_stub": ("ok", [page(title="Acme", text="Please enable JavaScript to continue. " * 5)], "stub:please_enable_javascript"),
    "bot_wall": ("ok", [page(title="Attention Required", text="Wait while we look at your request. " * 5)], "stub:attention_required"),
    "too_thin": ("ok", [page(title="Acme Corporation Limited", text="Acme Corporation.")], "thin:17_chars"),
    "title_is_domain": ("ok", [page(title="acme", text=COPY)], "no_real_title"),
    "title_is_long_domain": ("ok", [page(title="Acme!", text=COPY)], "no_real_title"),
    "single_page": ("ok", [page(title="Acme Crane Rental", text=COPY)], f"single_thin_page:{len(COPY)}"),
    "navigation_only": ("ok", [page(title="Acme Corporation Home", text="Home About Contact Services Blog Login Menu " * 12),
                               page("https://acme.com/about", "About", "Home About Contact")], "not_prose:0_words"),
    "dead": ("dns_fail", [], "status:dns_fail"),
    "blocked": ("blocked", [], "status:blocked"),
    "no_pages": ("ok", [], "no_pages"),
    "long_page_says_coming_soon": ("ok", [page(title="Acme Crane Rental", text=COPY * 5 + " New portal coming soon."), ABOUT], "pass"),
}


def sites(spark, cases):
    return spark.createDataFrame([(name, "acme.com", status, pages) for name, (status, pages, *_) in cases.items()],
                                 f"name string, domain string, status string, pages array<{PAGE_TYPE}>")


def test_gate_table(spark):
    got = {r.name: (r.gate_ok, r.gate_reason) for r in quality_gate(sites(spark, CASES)).collect()}
    assert got == {name: (reason == "pass", reason) for name, (_, _, reason) in CASES.items()}


def test_long_label_equal_to_the_host_is_no_title(spark):
    rows = [("x", "longcompany.com", "ok", [page(title="Long-Company", text=COPY), ABOUT])]
    df = spark.createDataFrame(rows, f"name string, domain string, status string, pages array<{PAGE_TYPE}>")
    assert quality_gate(df).first().gate_reason == "no_real_title"


def test_phrases_count_only_in_the_window(spark):
    late = ("ok", [page(title="Acme Crane Rental", text="x" * 100 + COPY),
                   page("https://acme.com/p", "P", " " * 4000 + "parked domain")])
    assert quality_gate(sites(spark, {"late": late})).first().gate_ok


def test_digest_cap_and_layout(spark):
    big = ("ok", [page(title="T" * 500, description="D" * 900, headings=["H" * 300] * 30, text=COPY * 200)]
           + [page(f"https://acme.com/p{i}", "P", COPY * 50) for i in range(8)])
    small = ("ok", [page(title=" Acme  Cranes ", headings=["Lifts", "lifts", " ", "Rigs"], text="We lift."),
                    page("https://acme.com/about?x=1", "About", "Us.", headings=["Who"]),
                    page("https://acme.com/empty")])
    got = {r.name: r.digest for r in build_digest(sites(spark, {"big": big, "small": small, "none": ("ok", [])})).collect()}
    assert len(got["big"]) == 2500 and got["big"].endswith("...")
    assert got["small"] == ("DOMAIN: acme.com\nTITLE: Acme Cranes\nHEADINGS: Lifts | Rigs\nHOME: We lift.\n"
                            "PAGE /about?x=1: About Who Us.")
    assert got["none"] == ""


def test_assembly_caps_pages_per_domain(spark):
    pages = spark.range(10000).select(
        F.when(F.col("id") % 3 == 0, "hot.com").otherwise(F.concat(F.lit("d"), F.col("id") % 50, F.lit(".com"))).alias("domain"),
        F.col("id").alias("ord"), F.concat(F.lit("https://x.com/"), "id").alias("url"), F.lit("t").alias("title"),
        F.lit("").alias("description"), F.array().cast("array<string>").alias("headings"),
        F.repeat(F.lit("a"), 100).alias("text"), F.lit(200).alias("http_status"))
    rows = {r.domain: r for r in assemble_sites(pages.repartition(40), "ord").collect()}
    assert len(rows) == 51
    assert [p.url for p in rows["hot.com"].pages] == [f"https://x.com/{i}" for i in (0, 3, 6, 9, 12)]
    assert rows["hot.com"].chars == 500 and rows["hot.com"].status == "ok"


def test_assembly_limits_inside_each_task(spark):
    pages = sites(spark, CASES).select("domain", F.lit(1).alias("ord"), F.inline("pages"))
    plan = assemble_sites(pages, "ord")._jdf.queryExecution().executedPlan().toString()
    # By domain and salt, then by domain; the page list needs no shuffle of its own.
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 2


def test_rows_of_a_hot_host_stay_at_the_cap_per_task(spark):
    pages = spark.range(0, 200_000, 1, 40).select(F.lit("hot.com").alias("domain"), F.col("id").alias("ord"))
    first = first_pages(pages, "ord")
    assert [r.ord for r in first.orderBy("ord").collect()] == [0, 1, 2, 3, 4]
    plan = first._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("_salt" in line and "Partial" in line for line in limits)


def test_homepage_stays_and_blank_subpages_go(spark):
    html = f"<html><title>Acme</title><p>{COPY}</p></html>"
    pages = spark.createDataFrame(
        [(1, "https://a.com/", "<html><noscript>please enable javascript</noscript></html>"),
         (2, "https://b.com/", "<html></html>"), (3, "https://b.com/about", html), (4, "https://b.com/empty", "<p> </p>"),
         (5, "https://c.com/", html)], "page_id bigint, url string, html string")
    asked = spark.createDataFrame([("a.com",), ("b.com",), ("b.com",), ("d.com",)], "domain string")
    rows = {r.domain: r for r in crawl_results(pages, requested=asked).collect()}
    assert set(rows) == {"a.com", "b.com", "d.com"}
    assert (rows["a.com"].pages, rows["a.com"].gate_reason) == (1, "thin:0_chars")
    assert rows["b.com"].pages == 2 and rows["b.com"].chars == len(COPY)
    assert (rows["d.com"].gate_reason, rows["d.com"].status, rows["d.com"].error) == ("no_pages", "thin", "no pages")
    assert {r.domain for r in crawl_results(pages).collect()} == {"a.com", "b.com", "c.com"}


@pytest.mark.parametrize("tier", ["plain", "browser"])
def test_gate_ignores_the_tier(spark, tier):
    df = sites(spark, CASES).withColumn("source_tier", F.lit(tier))
    got = {r.name: r.gate_reason for r in quality_gate(df).collect()}
    assert got == {name: reason for name, (_, _, reason) in CASES.items()}
