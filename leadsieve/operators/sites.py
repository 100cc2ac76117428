"""Pages and attempts as one record per domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import normalize_domain, path_depth, registrable, host_of
from leadsieve.functions.text import site_status
from leadsieve.operators.selection import latest_by, may_hold, spread_join
from leadsieve.session import stored

SALTS = 64
PAGE_FIELDS = ["url", "title", "description", "headings", "text", "http_status"]


def collect_domains(leads: DataFrame, url_col: str) -> DataFrame:
    """Distinct domains with their first row and row count.

    The rows of a domain stay in `domain_rows`, as one domain may own most of the table.
    """
    return domain_rows(leads, url_col).where("domain <> ''").groupBy("domain").agg(
        F.min("row_idx").alias("first_row"), F.count("*").alias("n_rows"))


def domain_rows(leads: DataFrame, url_col: str) -> DataFrame:
    """Domain and position of every row; an unusable website gives a blank domain."""
    return leads.select(normalize_domain(F.col(url_col)).alias("domain"), "row_idx",
                        F.trim(F.coalesce(F.col(url_col), F.lit(""))).alias("raw"))


def _first(rows: DataFrame, keys: list[str], order: tuple[str, ...], n: int) -> DataFrame:
    rank = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= n).drop("_rank")


def first_pages(pages: DataFrame, *order: str, max_pages: int = C.MAX_PAGES) -> DataFrame:
    """The rows of the first pages of each domain.

    The cap is a window limit, which Spark applies inside each task before the shuffle, so
    a domain sends at most the cap per task. The tasks are dealt over salts, so that even
    these rows of a domain with pages in every task meet in parts first.
    """
    salted = pages.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    parts = _first(salted, ["domain", "_salt"], order, max_pages).drop("_salt")
    return _first(parts, ["domain"], order, max_pages)


def assemble_sites(pages: DataFrame, *order: str, max_pages: int = C.MAX_PAGES) -> DataFrame:
    """One site per domain from its first pages: page list, body size and status.

    `order` must be unique within a domain. The first page is the homepage and always
    stays; blank ones among the others are left out. `places` and `blank_places` keep the
    order columns of both, so that a site can take further pages later.
    """
    return list_sites(first_pages(pages, *order, max_pages=max_pages), *order)


def list_sites(first: DataFrame, *order: str) -> DataFrame:
    """`assemble_sites` on pages that are capped per domain already."""
    listed = first.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct(
        F.struct(*order).alias("place"), F.struct(*PAGE_FIELDS).alias("page")))).alias("_pages"))

    def shown(p: Column, i: Column) -> Column:
        return (i == 0) | (F.coalesce(p["page"]["text"], F.lit("")) != "")

    split = listed.select("domain", F.filter("_pages", shown).alias("_shown"),
                          F.filter("_pages", lambda p, i: ~shown(p, i)).alias("_blank"))
    sites = split.select("domain", F.col("_shown.page").alias("pages"),
                         F.col("_shown.place").alias("places"),
                         F.col("_blank.place").alias("blank_places"))
    return sites.select("*", body_chars(F.col("pages")).alias("chars")) \
        .withColumn("status", site_status(F.col("chars")))


def body_chars(pages: Column) -> Column:
    return F.length(F.array_join(pages["text"], ""))


def assign_pages(pages: DataFrame, domains: DataFrame) -> DataFrame:
    """Give each page to the requested domain with the same owner part.

    Pages without text or owner are dropped; of two requested domains with one owner
    part the last one (by `seq`) gets the pages.
    Pages without an owner are dropped before their text moves, and a part that owns
    very many pages is dealt over many tasks.
    """
    owners = stored(latest_by(domains.select("domain", "seq", registrable(F.col("domain")).alias("site")), "site")
                    .select("site", "domain"), "owners")
    keyed = pages.where(F.col("text") != "") \
        .withColumn("site", registrable(host_of(F.col("url")))).where(F.col("site") != "")
    return spread_join(may_hold(keyed, owners, ["site"]), owners, "site", "url").drop("site")


def page_order(url: Column) -> Column:
    """Shallow paths first, so the homepage leads."""
    return path_depth(url)


def resolve_cascade(attempts: DataFrame, tiers: list[str],
                    domains: DataFrame | None = None) -> DataFrame:
    """The accepted attempt of each domain.

    The first passing attempt in tier order wins; otherwise the failure with the most
    text, the earliest on ties. Requested domains without any attempt get `no_url`.
    """
    tier_rank = F.array_position(F.array(*map(F.lit, tiers)), F.col("tier"))
    order = F.struct(
        (~F.col("gate_ok")).alias("failed"),
        F.when(F.col("gate_ok"), tier_rank).otherwise(-F.col("chars")).alias("rank"),
        F.col("seq"))
    fields = [c for c in attempts.columns if c != "domain"]
    best = attempts.groupBy("domain").agg(
        F.min_by(F.struct(*fields), order).alias("_best"), F.count("*").alias("n_attempts"))
    if domains is None:
        return best.select("domain", "_best.*", "n_attempts")
    asked = best.join(domains.select("domain").distinct(), "domain", "full")
    default = {"status": F.lit("no_url"), "error": F.lit("no tiers ran"), "gate_ok": F.lit(False),
               "gate_reason": F.lit("status:no_url"), "chars": F.lit(0)}
    tried = F.col("_best").isNotNull()

    def value(name: str) -> Column:
        given = F.col(f"_best.{name}") if name in fields else F.lit(None)
        return F.when(tried, given).otherwise(default.get(name, F.lit(None))).alias(name)

    names = fields + [c for c in default if c not in fields]
    return asked.select("domain", *map(value, names),
                        F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"))


def untried_tiers(domains: DataFrame, attempts: DataFrame, tiers: list[str]) -> DataFrame:
    """The tiers each domain has not tried yet, in tier order; `exhausted` if none."""
    flags = [F.bool_or(F.col("tier") == t).alias(f"_t{i}") for i, t in enumerate(tiers)]
    tried = attempts.groupBy("domain").agg(*flags)
    left = F.filter(F.array(*[F.when(~F.coalesce(F.col(f"_t{i}"), F.lit(False)), F.lit(t))
                              for i, t in enumerate(tiers)]), lambda t: t.isNotNull())
    return domains.select("domain").join(tried, "domain", "left").select(
        "domain", left.alias("untried")).withColumn("exhausted", F.size("untried") == 0)


def unattempted(domains: DataFrame, attempts: DataFrame, tier: str) -> DataFrame:
    """Domains one tier has not tried."""
    return domains.select("domain").subtract(
        attempts.where(F.col("tier") == tier).select("domain"))


def plan_fetches(domains: DataFrame, sites: DataFrame, mode: str = "first") -> DataFrame:
    """What to do with each requested domain: `serve`, `fetch` or `skip`.

    first: fetch what is not stored. escalate: fetch what is stored and failed, skip
    what is not stored. refresh: fetch everything.
    """
    known = domains.select("domain").join(sites.select("domain", "gate_ok"), "domain", "left")
    stored = F.col("gate_ok").isNotNull()
    actions = {
        "first": F.when(stored, "serve").otherwise("fetch"),
        "escalate": F.when(F.col("gate_ok"), "serve").when(stored, "fetch").otherwise("skip"),
        "refresh": F.lit("fetch"),
    }
    return known.select("domain", actions[mode].alias("action"))


def upsert_sites(old: DataFrame, new: DataFrame) -> DataFrame:
    """One current record per domain: a newer version replaces an older one.

    For two tables at hand; `sources.store.SiteStore` keeps sites and rewrites only what an update touches.
    """
    return latest_by(old.unionByName(new, allowMissingColumns=True), "domain", "version")


def replace_results(cached: DataFrame, fresh: DataFrame) -> DataFrame:
    """The current result view: fresh results, and stored ones for all other domains."""
    kept = cached.join(fresh.select("domain"), "domain", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def skip_disqualified(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Domains to crawl: all but those whose every row was pre-filtered."""
    out = verdicts.where(F.col("row_idx").isNotNull() & (F.col("source_tier") == "prefilter")) \
        .select("row_idx").distinct().withColumn("out", F.lit(True))
    return rows.where("domain <> ''").join(out, "row_idx", "left").groupBy("domain").agg(
        F.min("row_idx").alias("first_row"),
        F.bool_and(F.coalesce("out", F.lit(False))).alias("_all_out")) \
        .where(~F.col("_all_out")).drop("_all_out")
