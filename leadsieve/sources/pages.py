"""Crawled pages as input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import host_of, normalize_domain, pick_subpages, resolve_link
from leadsieve.functions.html import parse_html
from leadsieve.operators.selection import fetch_rows
from leadsieve.operators.sites import first_pages, page_order
from leadsieve.session import stored


#: What orders the pages of a domain and tells them apart, none of it null; the first one is its homepage.
#: Pages without an id come after those of their depth that have one.
ORDER = ["depth", "no_id", "place_id", "url"]


def page_keys(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, ...) with host, order columns and version; pages with an unusable URL are dropped.

    Nothing is parsed. `version` orders repeated crawls of a page where the table has it. Where it has a column `asked`, a
    page belongs to the domain that the crawl set out for, wherever redirects led, and not to the host of its URL.
    """
    owner = normalize_domain(F.col("asked" if "asked" in pages.columns else "url"))
    keyed = pages.withColumn("domain", owner).where("domain <> ''")
    status = F.col("http_status") if "http_status" in pages.columns else F.lit(200)
    version = F.coalesce(F.col("version").cast("bigint"), F.lit(-(1 << 63))) if "version" in pages.columns else F.lit(0).cast("bigint")
    none = F.lit(0).cast(pages.schema["page_id"].dataType)
    return keyed.withColumns({"http_status": status, "depth": page_order(F.col("url")), "no_id": F.col("page_id").isNull(),
                              "place_id": F.coalesce("page_id", none), "version": version})


def ingest_pages(pages: DataFrame) -> DataFrame:
    """(url, html, ...) as parsed pages keyed by host; unusable URLs are dropped.

    The filter runs on the narrow URL before any HTML is parsed.
    """
    return parse_html(page_keys(pages))


def ingest_first_pages(pages: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """The first pages of each (requested) domain, parsed.

    They are chosen by narrow keys, which are stored: at most five a domain. All other pages are dropped where
    they are scanned, so their HTML is neither shuffled nor parsed. Of a page that was crawled several times
    (same id and URL) the latest version counts, of equal versions that whose HTML has the
    smallest MD5.
    """
    keyed = page_keys(pages)
    keys = keyed.select("domain", *ORDER)
    if requested is not None:
        keys = keys.join(requested.select("domain").distinct(), "domain", "left_semi")
    chosen = stored(first_pages(keys.distinct(), *ORDER), "page-choice")
    return parse_html(_newest(fetch_rows(keyed, chosen, ["domain", *ORDER]))).drop("links")


def _newest(rows: DataFrame) -> DataFrame:
    newest = Window.partitionBy("domain", *ORDER).orderBy(F.desc("version"), F.md5("html"))
    return rows.withColumn("_crawl", F.row_number().over(newest)).where("_crawl = 1").drop("_crawl")


def linked_pages(pages: DataFrame, requested: DataFrame | None = None, max_pages: int = C.MAX_PAGES) -> DataFrame:
    """The homepage of each (requested) domain and the pages its best links lead to, parsed; `place` is 0 and the link's rank.

    Homepages alone are parsed to find the links, which then meet the keys of all pages by their URL without query. A
    link may lead to another host of the owner; one whose page wasn't crawled gives none, and nor does a page without text. Of
    several pages with one such URL the first counts, and of one crawled several times the newest. Only HTML of chosen pages
    is shuffled, as in `ingest_first_pages`; a page that several sites link to is repeated for each.
    """
    keyed = page_keys(pages)
    on = ["domain", *ORDER]
    keys = keyed.select(*on).distinct()
    asked = keys if requested is None else keys.join(requested.select("domain").distinct(), "domain", "left_semi")
    homes = stored(first_pages(asked, *ORDER, max_pages=1), "homepages")
    home = parse_html(_newest(fetch_rows(keyed, homes, on)))
    best = pick_subpages(F.col("links"), F.col("url"), host_of(F.col("url")), max_pages - 1)
    picked = stored(home.select(F.col("domain").alias("site"), F.posexplode(best).alias("rank", "link")), "links")
    reached = keys.withColumn("link", resolve_link(F.col("url"), F.col("url"))).join(picked, "link")
    first = reached.groupBy("site", "rank").agg(F.min(F.struct(*ORDER, "domain")).alias("key")).select(
        "site", (F.col("rank") + 1).alias("place"), "key.*")
    chosen = stored(first.unionByName(homes.select(F.col("domain").alias("site"), F.lit(0).alias("place"), *on)), "page-choice")
    rows = parse_html(_newest(fetch_rows(keyed, chosen.select(*on).distinct(), on))).drop("links")
    return rows.join(chosen, on).where("place = 0 or text <> ''").drop("domain").withColumnRenamed("site", "domain")
