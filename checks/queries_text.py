"""Column functions on text, hosts, links and pages."""

from pyspark.sql import functions as F

from checks import sql as S
from checks.registry import fixture, query, table
from leadsieve import constants as C
from leadsieve.functions import domains as D, html as H, text as X
from leadsieve.sources.pages import ingest_pages, linked_pages

c = F.col


@query("normalize_domain", f"SELECT row_idx, {S.domain('Website')} AS domain FROM leads")
def _(spark, sf):
    return fixture(spark, sf, "leads").select("row_idx", D.normalize_domain(c("Website")).alias("domain"))


@query("candidate_urls", f"""
WITH hosts AS (SELECT DISTINCT {S.domain('Website')} AS domain FROM leads)
SELECT domain, CASE WHEN domain = '' THEN '' ELSE 'https://' || domain || ' https://' ||
  CASE WHEN starts_with(domain, 'www.') THEN substr(domain, 5) ELSE 'www.' || domain END
  || ' http://' || domain END AS urls FROM hosts""")
def _(spark, sf):
    hosts = fixture(spark, sf, "leads").select(D.normalize_domain(c("Website")).alias("domain")).distinct()
    return hosts.select("domain", F.array_join(D.candidate_urls(c("domain")), " ").alias("urls"))


@query("registrable", f"""
WITH hosts AS (SELECT page_id, replace({S.host_of('url')}, '.example.', '.') AS host FROM pages
  UNION ALL SELECT p_partkey, {S.host_of('base')} FROM hrefs)
SELECT page_id, host, {S.registrable('host')} AS owner FROM hosts""")
def _(spark, sf):
    hosts = table(spark, sf, "pages").select(
        "page_id", F.replace(D.host_of(c("url")), F.lit(".example."), F.lit(".")).alias("host"))
    hosts = hosts.unionAll(fixture(spark, sf, "hrefs").select("p_partkey", D.host_of(c("base"))))
    return hosts.select("page_id", "host", D.registrable(c("host")).alias("owner"))


@query("same_site", f"""
SELECT p_partkey, {S.host_of('href')} <> '' AND {S.registrable(S.host_of('href'))} = {S.registrable('site')} AS same
FROM hrefs""")
def _(spark, sf):
    return fixture(spark, sf, "hrefs").select(
        "p_partkey", D.same_site(D.host_of(c("href")), c("site")).alias("same"))


@query("collapse", f"SELECT doc_id, md5({S.collapse('text')}) AS digest, length({S.collapse('text')}) AS n FROM documents")
def _(spark, sf):
    flat = table(spark, sf, "documents").select("doc_id", X.collapse(c("text")).alias("t"))
    return flat.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n"))


@query("distinct_content_words", f"SELECT doc_id, {S.words('text')} AS n_words FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.content_words(c("text")).alias("n_words"))


_PLANTED = ("text || CASE doc_id % 9 WHEN 1 THEN ' Coming Soon, buy this domain' WHEN 2 THEN ' Parked DOMAIN' "
            "WHEN 3 THEN ' sedoparking' ELSE '' END")


@query("first_phrase", f"SELECT doc_id, {S.first_phrase(f'lower({_PLANTED})', C.PARKED_PHRASES)} AS phrase FROM documents")
def _(spark, sf):
    lowered = table(spark, sf, "documents").select("doc_id", F.lower(F.expr(_PLANTED)).alias("t"))
    return lowered.select("doc_id", X.first_phrase(c("t"), C.PARKED_PHRASES).alias("phrase"))


@query("to_number", f"SELECT row_idx, {S.number('Employees')} AS employees, {S.number('Company')} AS code FROM leads")
def _(spark, sf):
    return fixture(spark, sf, "leads").select(
        "row_idx", X.to_number(c("Employees")).alias("employees"), X.to_number(c("Company")).alias("code"))


@query("reason_family", f"SELECT domain, {S.family('gate_reason')} AS family FROM results")
def _(spark, sf):
    return fixture(spark, sf, "results").select("domain", X.reason_family(c("gate_reason")).alias("family"))


@query("comment_for", f"SELECT domain, {S.comment_for('gate_reason')} AS comment FROM results")
def _(spark, sf):
    return fixture(spark, sf, "results").select("domain", X.comment_for(c("gate_reason")).alias("comment"))


@query("site_status", "SELECT domain, CASE WHEN chars >= 400 THEN 'ok' ELSE 'thin' END AS status, seq FROM attempts")
def _(spark, sf):
    return fixture(spark, sf, "attempts").select("domain", X.site_status(c("chars")).alias("status"), "seq")


_FETCH = """SELECT event_id, CASE WHEN value > 40 THEN CAST(200 + event_id % 330 AS INT) END AS code,
  CASE event_id % 6 WHEN 0 THEN 'Read timed out' WHEN 1 THEN 'getaddrinfo failed' WHEN 2 THEN 'TIMEOUT 12s'
    WHEN 3 THEN 'Name or service not known' WHEN 4 THEN 'reset by peer' END AS error FROM events"""


@query("classify_fetch", f"""
SELECT event_id, CASE WHEN code IN (401, 403, 429) THEN 'blocked' WHEN code >= 400 AND code < 500 THEN 'http_4xx'
  WHEN code >= 500 THEN 'http_5xx' WHEN lower(error) LIKE '%timed out%' OR lower(error) LIKE '%timeout%' THEN 'timeout'
  WHEN regexp_matches(lower(error), 'resolve|getaddrinfo|name or service|nodename nor servname') THEN 'dns_fail'
  ELSE 'conn_fail' END AS status FROM ({_FETCH})""")
def _(spark, sf):
    fetches = spark.sql(_FETCH.replace("FROM events", f"FROM parquet.`{sf}/events.parquet`"))
    return fetches.select("event_id", X.classify_fetch(c("code"), c("error")).alias("status"))


@query("path_of", f"SELECT page_id, {S.path_of('url')} AS path FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", D.path_of(c("url")).alias("path"))


def _score(e):
    depth = S.depth(f"lower({e})")
    hits = ", ".join(f"CASE WHEN regexp_matches(lower({e}), '{'|'.join(f)}') THEN {w} ELSE 0 END"
                     for f, w in C.PATH_WEIGHTS)
    return f"greatest({hits}) - greatest(0, {depth} - 2)"


@query("score_path", f"SELECT p_partkey, CAST({_score('href')} AS INT) AS score FROM hrefs")
def _(spark, sf):
    return fixture(spark, sf, "hrefs").select("p_partkey", D.score_path(c("href")).alias("score"))


_SKIP = f"(?i){C.SKIP_LINK_PATTERN}"


@query("crawlable_link", f"SELECT p_partkey, href <> '' AND NOT regexp_matches(href, '{_SKIP}') AS keep FROM hrefs")
def _(spark, sf):
    return fixture(spark, sf, "hrefs").select("p_partkey", D.crawlable_link(c("href")).alias("keep"))


# Relative links resolved by walking the segments of base folder and link.
_RESOLVED = f"""
    shaped AS (SELECT *, lower(regexp_extract(href, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS own FROM hrefs),
    bared AS (SELECT *, CASE WHEN own <> '' THEN regexp_replace(href, '^[^:]*:', '') ELSE href END AS rest FROM shaped),
    parted AS (SELECT *, regexp_replace(regexp_extract(rest, '^(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') AS p,
      regexp_extract(rest, '^//([^/?#]*)', 1) AS net FROM bared),
    joined AS (SELECT *, CASE WHEN p = '' THEN {S.url_path('base')} WHEN starts_with(p, '/') THEN p
      ELSE regexp_extract({S.url_path('base')}, '^.*/') || p END AS full_path FROM parted),
    walked AS (SELECT *, list_reduce(list_concat([['']], list_transform(list_filter(string_split(full_path, '/')[2:],
        lambda x: x <> ''), lambda x: [x])),
        lambda acc, x: CASE WHEN x[1] = '..' THEN acc[1:len(acc) - 1] WHEN x[1] = '.' THEN acc ELSE list_concat(acc, x) END) AS segs
      FROM joined),
    resolved AS (SELECT *, CASE WHEN CASE WHEN own <> '' THEN own ELSE 'https' END NOT IN ('http', 'https') THEN NULL
      ELSE CASE WHEN own <> '' THEN own ELSE 'https' END || '://'
        || CASE WHEN net <> '' THEN net || rtrim(p, '/') ELSE {S.host_of('base')} || CASE WHEN p = '' THEN rtrim(full_path, '/')
             ELSE rtrim(array_to_string(segs, '/'), '/') END END END AS link FROM walked)"""


@query("resolve_link", f"WITH {_RESOLVED} SELECT p_partkey, link FROM resolved")
def _(spark, sf):
    return fixture(spark, sf, "hrefs").select("p_partkey", D.resolve_link(c("base"), c("href")).alias("link"))


@query("pick_subpages", f"""
WITH {_RESOLVED},
usable AS (SELECT page, base, site, link, min(p_partkey) AS ord FROM resolved
  WHERE href <> '' AND NOT regexp_matches(href, '{_SKIP}') AND link IS NOT NULL AND link <> base
    AND {S.registrable(S.host_of('link'))} = {S.registrable('site')} GROUP BY ALL),
scored AS (SELECT *, {_score(S.url_path('link'))} AS score FROM usable)
SELECT page, link, row_number() OVER (PARTITION BY page ORDER BY score DESC, length(link), ord) AS place
FROM scored WHERE score > 0 QUALIFY place <= 4""")
def _(spark, sf):
    # A page holds the twelve links of its key range, so the list is bounded.
    pages = fixture(spark, sf, "hrefs").groupBy("page", "base", "site").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("p_partkey", "href"))), lambda s: s["href"]).alias("links"))
    picked = pages.select("page", F.posexplode(D.pick_subpages(c("links"), c("base"), c("site"))).alias("i", "link"))
    return picked.select("page", "link", (c("i") + 1).alias("place"))


_LINKS = _RESOLVED.replace("FROM hrefs", "FROM home_links")


@query("linked_pages", f"""
WITH {_LINKS},
usable AS (SELECT page, base, site, link, min(p_partkey) AS ord FROM resolved
  WHERE href <> '' AND NOT regexp_matches(href, '{_SKIP}') AND link IS NOT NULL AND link <> rtrim(base, '/')
    AND {S.registrable(S.host_of('link'))} = {S.registrable('site')} GROUP BY ALL),
scored AS (SELECT *, {_score(S.url_path('link'))} AS score FROM usable),
picked AS (SELECT page, site, link, row_number() OVER (PARTITION BY page ORDER BY score DESC, length(link), ord) AS place
  FROM scored WHERE score > 0 QUALIFY place <= 4)
SELECT DISTINCT site AS domain, CAST(0 AS INT) AS place, base AS url, 'Home ' || page AS text FROM home_links
UNION ALL SELECT site, CAST(place AS INT), c.url, 'Text of page ' || i FROM picked p
  JOIN linked_crawl c ON c.page = p.page AND rtrim(regexp_extract(c.url, '^[^?]*'), '/') = link WHERE i <> 4""")
def _(spark, sf):
    # A homepage holds the twelve links of its key range; page 4 of each site has no text.
    link = F.concat(F.lit('<a href="'), c("href"), F.lit('"></a>'))
    homes = fixture(spark, sf, "home_links").groupBy("page", "base").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("p_partkey", link.alias("a")))), lambda s: s["a"]), "").alias("links"))
    homes = homes.select((c("page") * 10 + 9).alias("page_id"), c("base").alias("url"), F.concat(
        F.lit("<html><body><p>Home "), c("page").cast("string"), F.lit("</p>"), c("links"), F.lit("</body></html>")).alias("html"))
    others = fixture(spark, sf, "linked_crawl").select((c("page") * 10 + c("i")).alias("page_id"), "url", F.when(
        c("i") == 4, "<html></html>").otherwise(F.concat(F.lit("<p>Text of page "), c("i").cast("string"), F.lit("</p>"))).alias("html"))
    return linked_pages(homes.unionByName(others)).select("domain", "place", "url", "text")


@query("parse_html", f"""
WITH {S.parsed_pages()}
SELECT page_id, domain, depth, title, description, array_to_string(headings, ' | ') AS headings,
  length(text) AS n_text, md5(text) AS text_md5, array_to_string(links, ' ') AS links FROM parsed""")
def _(spark, sf):
    pages = ingest_pages(table(spark, sf, "pages"))
    return pages.select("page_id", "domain", "depth", "title", "description",
                        F.array_join("headings", " | ").alias("headings"), F.length("text").alias("n_text"),
                        F.md5("text").alias("text_md5"), F.array_join("links", " ").alias("links"))


_MD_WORD = r"[\p{L}\p{N}_]"


def _md_escape(e):
    return (f"regexp_replace(regexp_replace({e}, '\\\\+([^\\p{{L}}\\p{{N}}_\\\\]|$)', '\\1', 'g'), "
            f"'\\\\+(\\\\{_MD_WORD})', '\\1', 'g')")


_SP = f"[{C.SPACE_CLASS}]"
_MD_TEXT = ("regexp_replace(regexp_replace(markdown, '!\\[[^\\]]*\\]\\([^)]*\\)', ' ', 'g'), "
            "'\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')")
_MD_TEXT = f"regexp_replace({_MD_TEXT}, '(?m)^{_SP}*\\|.*\\|{_SP}*$', ' ', 'g')"
_MD_TEXT = f"regexp_replace(regexp_replace({_MD_TEXT}, '(?m)^[-=]{{3,}}$', ' ', 'g'), '[*_`>#]+', ' ', 'g')"
_MD_HEAD = ("regexp_replace(" + S.collapse(
    "regexp_replace(regexp_extract(l, '^" + _SP + "{0,3}#{1,3}" + _SP + "+(.*)', 1), '\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g')")
    + ", '[*_`>#]+', '', 'g')")


@query("page_from_markdown", f"""
SELECT doc_id, url, left({S.collapse('title')}, {C.TITLE_CHARS}) AS title, description,
  md5({S.collapse(_md_escape(_MD_TEXT))}) AS text_md5, length({S.collapse(_md_escape(_MD_TEXT))}) AS n_text,
  array_to_string(list_filter(list_transform(list_filter(string_split(regexp_replace(markdown,
      '\\r\\n|[\\n\\r\\x0b\\f\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), chr(10)),
      lambda l: regexp_matches(l, '^{_SP}{{0,3}}#{{1,3}}{_SP}+')),
    lambda l: {S.strip(_md_escape(_MD_HEAD))}), lambda h: h <> '' AND length(h) < 200)[1:20], ' | ') AS headings
FROM markdown""")
def _(spark, sf):
    pages = H.page_from_markdown(fixture(spark, sf, "markdown"))
    return pages.select("doc_id", "url", "title", "description", F.md5("text").alias("text_md5"),
                        F.length("text").alias("n_text"), F.array_join("headings", " | ").alias("headings"))


@query("markdown_to_text", f"SELECT doc_id, {S.collapse(_md_escape(_MD_TEXT))} AS text FROM markdown")
def _(spark, sf):
    return fixture(spark, sf, "markdown").select("doc_id", H.markdown_text(c("markdown")).alias("text"))
