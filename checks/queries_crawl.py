"""Pages, sites, the gate, digests and crawl attempts."""

from pyspark.sql import functions as F

from checks import sql as S
from checks.queries_leads import context_sql
from checks.registry import fixture, query, table
from leadsieve import constants as C
from leadsieve.operators import reports as R, selection as Sel, sites as Sites
from leadsieve.operators.gate import build_digest, dedupe_headings, gate_split, quality_gate
from leadsieve.operators.verdicts import resolve_failed
from leadsieve.plans.campaign import crawl_results, fetch_plan, gated_sites as gated_sites_of
from leadsieve.session import scratch_folder
from leadsieve.sources.pages import ingest_pages, page_keys
from leadsieve.sources.store import SiteStore
from leadsieve.streaming.incremental import current_sites, incremental_pages

c = F.col
TIERS = ["plain", "browser", "tls", "batched", "paged"]


def page_rows(spark, sf):
    rows = fixture(spark, sf, "page_rows")
    headings = F.when(c("heads") == "", F.array().cast("array<string>")).otherwise(F.split("heads", r"\|"))
    return rows.select("domain", "ord", "url", "title", "description", headings.alias("headings"),
                       "text", F.lit(200).alias("http_status"), "conv_id")


def sites(spark, sf):
    return Sites.assemble_sites(page_rows(spark, sf), "ord")


_LISTED = ("rows AS (SELECT *, CASE WHEN heads = '' THEN [] ELSE string_split(heads, '|') END AS headings "
           "FROM page_rows)")
_SITES = f"{_LISTED}, {S.site_ctes('rows', 'ord')}"
# Some sites are recorded as not reached.
_STATUS = ("CASE WHEN n_pages = 2 AND chars % 5 = 0 THEN 'dns_fail' "
           "WHEN n_pages = 4 AND chars % 5 = 1 THEN 'blocked' ELSE {0} END")


def gated_sites(spark, sf):
    n, chars = F.size("pages"), c("chars")
    status = F.when((n == 2) & (chars % 5 == 0), "dns_fail").when((n == 4) & (chars % 5 == 1), "blocked") \
        .otherwise(c("status"))
    return quality_gate(sites(spark, sf).withColumn("status", status))


@query("assemble_sites", f"""
WITH {_SITES}
SELECT domain, n_pages, chars, md5(words) AS text_md5, st AS status, urls FROM measured
JOIN (SELECT domain, string_agg(url, ' ' ORDER BY rk) AS urls FROM top5 GROUP BY domain) USING (domain)""")
def _(spark, sf):
    return sites(spark, sf).select(
        "domain", F.size("pages").alias("n_pages"), "chars",
        F.md5(F.array_join(c("pages.text"), " ")).alias("text_md5"), "status",
        F.array_join(c("pages.url"), " ").alias("urls"))


_GATED = (f"{_SITES}, gated AS (SELECT domain, reason, reason = 'pass' AS ok FROM (SELECT domain, "
          f"{S.gate_case('st2')} AS reason FROM (SELECT *, {_STATUS.format('st')} AS st2 FROM measured)))")


@query("quality_gate", f"WITH {_GATED} SELECT domain, ok AS gate_ok, reason AS gate_reason FROM gated")
def _(spark, sf):
    return gated_sites(spark, sf).select("domain", "gate_ok", "gate_reason")


@query("gate_split", f"WITH {_GATED} SELECT domain, CASE WHEN ok THEN 'passed' ELSE 'failed' END AS side FROM gated")
def _(spark, sf):
    passed, failed = gate_split(gated_sites(spark, sf))
    return passed.select("domain", F.lit("passed").alias("side")).unionAll(
        failed.select("domain", F.lit("failed")))


@query("build_digest", f"WITH {_SITES}, {S.digest_ctes()} SELECT domain, digest FROM digests")
def _(spark, sf):
    return build_digest(sites(spark, sf)).select("domain", "digest")


@query("dedupe_headings", f"""
WITH heads AS (SELECT doc_id, string_split(lang || '| ' || upper(lang) || '|' || source || '||' || replace(text, ' ', '|'), '|') AS hs FROM documents),
each AS (SELECT doc_id, {S.collapse('u.h')} AS h, u.i AS i FROM (
  SELECT doc_id, unnest(list_transform(hs, lambda h, i: {{'h': h, 'i': i}})) AS u FROM heads)),
firsts AS (SELECT doc_id, lower(h) AS l, arg_min(h, i) AS h, min(i) AS i FROM each WHERE h <> '' GROUP BY ALL),
kept AS (SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 12)
SELECT doc_id, string_agg(h, ' | ' ORDER BY i) AS headings FROM kept GROUP BY doc_id""")
def _(spark, sf):
    heads = F.split(F.expr("lang || '| ' || upper(lang) || '|' || source || '||' "
                           "|| replace(text, ' ', '|')"), r"\|")
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(dedupe_headings(heads), " | ").alias("headings"))


def _page_sites(source="crawled_pages"):
    """Parsed pages by row, each page once, and sites of them; pages without id come last at their depth."""
    row = "row_no" if source == "crawled_pages" else "page_id"
    return (f"numbered AS (SELECT {row} AS page_id, page_id AS given_id, md5(html) AS mark, url, html FROM {source}), "
            + S.parsed_pages("numbered") + ", keyed_pages AS (SELECT p.*, n.given_id FROM parsed p JOIN numbered n USING (page_id) "
            "WHERE domain <> '' QUALIFY row_number() OVER (PARTITION BY domain, depth, given_id, p.url ORDER BY mark) = 1), "
            + S.site_ctes("keyed_pages", "depth, given_id NULLS LAST, url"))


def crawled_pages(spark, sf):
    return fixture(spark, sf, "crawled_pages").drop("row_no")


_PAGE_SITES = _page_sites()
_PAGE_GATE = f"judged AS (SELECT *, {S.gate_case()} AS gate_reason FROM measured)"


@query("ingest_pages", f"""
WITH {S.parsed_pages()}
SELECT domain, count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS chars,
  CAST(sum(len(links)) AS BIGINT) AS n_links FROM parsed WHERE domain <> '' GROUP BY domain""")
def _(spark, sf):
    return ingest_pages(table(spark, sf, "pages")).groupBy("domain").agg(
        F.count("*").alias("n_pages"), F.sum(F.length("text")).alias("chars"),
        F.sum(F.size("links").cast("bigint")).alias("n_links"))


@query("crawl_results", f"""
WITH {_PAGE_SITES}, {_PAGE_GATE}, {S.digest_ctes()}
SELECT domain, st AS status, gate_reason = 'pass' AS gate_ok, gate_reason, n_pages AS pages, chars, digest
FROM judged JOIN digests USING (domain)""")
def _(spark, sf):
    return crawl_results(crawled_pages(spark, sf)).select(
        "domain", "status", "gate_ok", "gate_reason", "pages", "chars", "digest")


@query("crawl_requested", f"""
WITH {_PAGE_SITES}, {_PAGE_GATE}, asked AS (
  SELECT domain FROM keyed_pages WHERE NOT starts_with(domain, 'js') UNION SELECT 'none' || n_nationkey || '.com' FROM nation)
SELECT domain, coalesce(st, 'thin') AS status, coalesce(gate_reason = 'pass', FALSE) AS gate_ok,
  coalesce(gate_reason, 'no_pages') AS gate_reason, coalesce(n_pages, 0) AS pages, coalesce(chars, 0) AS chars,
  CASE WHEN gate_reason IS NULL THEN 'no pages' ELSE '' END AS error FROM asked LEFT JOIN judged USING (domain)""")
def _(spark, sf):
    pages = crawled_pages(spark, sf)
    asked = page_keys(pages).select("domain").where("not startswith(domain, 'js')").unionAll(
        table(spark, sf, "nation").select(F.concat(F.lit("none"), "n_nationkey", F.lit(".com"))))
    return crawl_results(pages, requested=asked).select(
        "domain", "status", "gate_ok", "gate_reason", "pages", "chars", "error")


@query("gate_report", f"""
WITH {_PAGE_SITES}, {_PAGE_GATE}
SELECT {S.family('gate_reason')} AS family, count(*) AS n, CAST(sum(n_pages) AS BIGINT) AS pages,
  CAST(sum(chars) AS BIGINT) AS chars FROM judged GROUP BY 1""")
def _(spark, sf):
    from leadsieve.functions.text import reason_family
    gated = gated_sites_of(crawled_pages(spark, sf))
    return gated.groupBy(reason_family(c("gate_reason")).alias("family")).agg(
        F.count("*").alias("n"), F.sum(F.size("pages").cast("bigint")).alias("pages"),
        F.sum("chars").cast("bigint").alias("chars"))


@query("incremental_pages", f"""
WITH {_page_sites("pages")}, {_PAGE_GATE}
SELECT domain, gate_reason, n_pages AS pages, chars FROM judged""")
def _(spark, sf):
    folder = scratch_folder(spark, "intake")
    for _ in range(2):  # the second run finds nothing new
        incremental_pages(spark, f"{sf}/pages*.parquet", folder, f"{folder}/progress")
    return current_sites(spark, folder).select("domain", "gate_reason", F.size("pages").alias("pages"), "chars")


_OWNER = "replace({0}, '.example.', '.')"


@query("assign_pages", f"""
WITH p AS (SELECT page_id, {_OWNER.format('url')} AS url FROM pages),
d AS (SELECT {S.host_of('url')} AS domain, page_id AS seq FROM p),
keyed AS (SELECT domain, seq, {S.registrable('domain')} AS site FROM d),
owners AS (SELECT site, domain FROM keyed WHERE site <> '' QUALIFY row_number() OVER (PARTITION BY site ORDER BY seq DESC) = 1)
SELECT page_id, owners.domain FROM p JOIN owners ON {S.registrable(S.host_of('p.url'))} = owners.site
WHERE p.url NOT LIKE '%utm_source%'""")
def _(spark, sf):
    from leadsieve.functions.domains import host_of
    pages = table(spark, sf, "pages").select(
        "page_id", F.replace("url", F.lit(".example."), F.lit(".")).alias("url"),
        # Some pages came back empty.
        F.when(c("url").contains("utm_source"), "").otherwise("copy").alias("text"))
    wanted = pages.select(host_of(c("url")).alias("domain"), c("page_id").alias("seq"))
    return Sites.assign_pages(pages, wanted).select("page_id", "domain")


_RANKED = """best AS (SELECT *, count(*) OVER (PARTITION BY domain) AS n_attempts FROM attempts
  QUALIFY row_number() OVER (PARTITION BY domain ORDER BY gate_ok DESC,
    CASE WHEN gate_ok THEN list_position(['plain', 'browser', 'tls', 'batched', 'paged'], tier) END,
    CASE WHEN NOT gate_ok THEN chars END DESC, seq) = 1)"""


@query("resolve_cascade", f"""
WITH {_RANKED}
SELECT w.domain, coalesce(tier, '') AS tier, coalesce(b.gate_ok, FALSE) AS gate_ok,
  coalesce(status, 'no_url') AS status, coalesce(gate_reason, 'status:no_url') AS gate_reason,
  coalesce(chars, 0) AS chars, coalesce(n_attempts, 0) AS n_attempts, coalesce(error, 'no tiers ran') AS error
FROM (SELECT domain FROM wanted UNION SELECT domain FROM attempts) w LEFT JOIN best b USING (domain)""")
def _(spark, sf):
    settled = Sites.resolve_cascade(fixture(spark, sf, "attempts"), TIERS, fixture(spark, sf, "wanted"))
    return settled.select("domain", F.coalesce("tier", F.lit("")).alias("tier"), "gate_ok", "status",
                          "gate_reason", "chars", "n_attempts", "error")


@query("untried_tiers", f"""
WITH tiers AS (SELECT unnest(['plain', 'browser', 'tls', 'batched', 'paged']) AS tier, unnest([1, 2, 3, 4, 5]) AS r),
open AS (SELECT w.domain, t.tier, t.r FROM wanted w, tiers t
  WHERE (w.domain, t.tier) NOT IN (SELECT domain, tier FROM attempts))
SELECT w.domain, coalesce(string_agg(o.tier, ' ' ORDER BY o.r), '') AS untried, count(o.tier) = 0 AS exhausted
FROM wanted w LEFT JOIN open o USING (domain) GROUP BY w.domain""")
def _(spark, sf):
    return Sites.untried_tiers(fixture(spark, sf, "wanted"), fixture(spark, sf, "attempts"), TIERS).select(
        "domain", F.array_join("untried", " ").alias("untried"), "exhausted")


@query("unattempted", "SELECT domain FROM wanted EXCEPT SELECT domain FROM attempts WHERE tier = 'tls'")
def _(spark, sf):
    return Sites.unattempted(fixture(spark, sf, "wanted"), fixture(spark, sf, "attempts"), "tls")


@query("plan_fetches", f"""
WITH {_RANKED}
SELECT w.domain, m.mode, CASE m.mode WHEN 'refresh' THEN 'fetch'
  WHEN 'first' THEN CASE WHEN b.domain IS NULL THEN 'fetch' ELSE 'serve' END
  ELSE CASE WHEN b.domain IS NULL THEN 'skip' WHEN b.gate_ok THEN 'serve' ELSE 'fetch' END END AS action
FROM wanted w LEFT JOIN best b USING (domain), (SELECT unnest(['first', 'escalate', 'refresh']) AS mode) m""")
def _(spark, sf):
    stored = Sites.resolve_cascade(fixture(spark, sf, "attempts"), TIERS)
    plans = [Sites.plan_fetches(fixture(spark, sf, "wanted"), stored, m).withColumn("mode", F.lit(m))
             for m in ("first", "escalate", "refresh")]
    return plans[0].unionByName(plans[1]).unionByName(plans[2])


@query("fetch_plan", f"""
WITH {_RANKED},
planned AS (SELECT w.domain, w.seq AS first_row, CASE WHEN b.domain IS NULL THEN 'skip' WHEN b.gate_ok THEN 'serve' ELSE 'fetch' END AS action
  FROM wanted w LEFT JOIN best b USING (domain)),
placed AS (SELECT *, row_number() OVER (PARTITION BY action ORDER BY first_row) AS place FROM planned)
SELECT domain, first_row, CASE WHEN action = 'fetch' AND place > greatest(1, floor(0.3 * (SELECT count(*) FROM wanted)))
  THEN 'defer' ELSE action END AS action FROM placed""")
def _(spark, sf):
    sites = Sites.resolve_cascade(fixture(spark, sf, "attempts"), TIERS)
    wanted = fixture(spark, sf, "wanted").select("domain", c("seq").alias("first_row"))
    return fetch_plan(wanted, sites, "escalate", paid=True)


@query("upsert_sites", "SELECT domain, status, seq AS version FROM attempts QUALIFY row_number() OVER (PARTITION BY domain ORDER BY seq DESC) = 1")
def _(spark, sf):
    log = fixture(spark, sf, "attempts").select("domain", "status", c("seq").alias("version"))
    store = SiteStore(spark, scratch_folder(spark, "sites"), buckets=8)
    for part in (log.where("status = 'thin'"), log.where("status = 'ok'"), log.where("status = 'timeout'")):
        store.upsert(part)
    return store.read()


@query("replace_results", f"""
WITH fresh AS (SELECT 'c' || event_id || '.com' AS domain, event_type AS status FROM events)
SELECT domain, status FROM results WHERE domain NOT IN (SELECT domain FROM fresh)
UNION ALL SELECT * FROM fresh""")
def _(spark, sf):
    fresh = table(spark, sf, "events").select(
        F.concat(F.lit("c"), "event_id", F.lit(".com")).alias("domain"), c("event_type").alias("status"))
    return Sites.replace_results(fixture(spark, sf, "results").select("domain", "status"), fresh)


@query("crawl_report", f"""
WITH t AS (SELECT count(*) AS total FROM results)
SELECT 'gate' AS section, CASE WHEN gate_ok THEN 'passed' ELSE 'failed' END AS key, count(*) AS n,
  count(*) * 100.0::DOUBLE / (SELECT total FROM t) AS value FROM results GROUP BY 2
UNION ALL SELECT 'accepted by tier', source_tier, count(*), sum(chars) / count(*) FROM results WHERE gate_ok GROUP BY 2
UNION ALL SELECT 'failure', {S.family('gate_reason')}, count(*), NULL FROM results WHERE NOT gate_ok GROUP BY 2""")
def _(spark, sf):
    return R.crawl_report(fixture(spark, sf, "results"))


@query("resolve_failed", f"""
SELECT domain, 'Unfit' AS fitment, '3' AS ranking, {S.comment_for('gate_reason')} AS comments,
  'gate=' || gate_reason || ' tier=' || source_tier AS evidence, status AS crawl_status,
  coalesce(nullif(source_tier, ''), 'none') AS source_tier, 'rule' AS judge
FROM results WHERE NOT gate_ok AND domain NOT IN (SELECT domain FROM verdicts WHERE row_idx IS NULL)""")
def _(spark, sf):
    return resolve_failed(fixture(spark, sf, "results"), fixture(spark, sf, "verdicts"))


@query("pending", "SELECT domain, seq FROM results WHERE gate_ok AND domain NOT IN (SELECT domain FROM decisions)")
def _(spark, sf):
    return Sel.pending(fixture(spark, sf, "results").where("gate_ok").select("domain", "seq"),
                       fixture(spark, sf, "decisions"))


@query("next_batch", f"""
WITH {context_sql()}, s AS (SELECT r.domain, r.digest, x.first_row, x.context FROM results r JOIN contexts x USING (domain)
  WHERE gate_ok AND domain NOT IN (SELECT domain FROM verdicts WHERE row_idx IS NULL))
SELECT domain, first_row, digest, context FROM s ORDER BY first_row LIMIT 25""")
def _(spark, sf):
    leads = fixture(spark, sf, "leads")
    crawled = fixture(spark, sf, "results").join(Sites.collect_domains(leads, "Website"), "domain")
    batch = R.next_batch(crawled, fixture(spark, sf, "verdicts"), leads, "Website")
    return batch.select("domain", "first_row", "digest", "context")


@query("next_batch_failed", f"""
WITH {context_sql()} SELECT r.domain, x.first_row, r.gate_reason, x.context FROM results r JOIN contexts x USING (domain)
WHERE NOT gate_ok AND domain NOT IN (SELECT domain FROM verdicts WHERE row_idx IS NULL) ORDER BY x.first_row LIMIT 25""")
def _(spark, sf):
    leads = fixture(spark, sf, "leads")
    crawled = fixture(spark, sf, "results").join(Sites.collect_domains(leads, "Website"), "domain")
    batch = R.next_batch(crawled, fixture(spark, sf, "verdicts"), leads, "Website", failed=True)
    return batch.select("domain", "first_row", "gate_reason", "context")
