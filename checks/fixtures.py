"""Stand-ins for leads, crawls, logs and answers, derived from the given tables.

Each is one SQL text that Spark and DuckDB both run.
"""

from checks.registry import FIXTURES

FIXTURES["lead_hosts"] = """
SELECT c_custkey AS row_idx, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 4 = 0 THEN 'c1.com'
            ELSE 'c' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) || '.com' END AS host
FROM customer"""

FIXTURES["leads"] = """
SELECT row_idx, c_name AS Company,
       CASE row_idx % 11
         WHEN 0 THEN host WHEN 1 THEN 'https://' || host || '/'
         WHEN 2 THEN 'www.' || host WHEN 3 THEN 'info@' || host
         WHEN 4 THEN ' ' WHEN 5 THEN 'N/A'
         WHEN 6 THEN 'HTTP://' || upper(host) || '/path?q=1#x'
         WHEN 7 THEN host || ':8080' WHEN 8 THEN '"' || host || '"'
         WHEN 9 THEN '//' || host || '/x' ELSE 'not a host' END AS Website,
       r_name AS Country,
       CASE WHEN row_idx % 13 = 0 THEN '' WHEN row_idx % 13 = 1 THEN 'about 1,250 people'
            ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) END AS Employees,
       c_mktsegment AS Industry
FROM lead_hosts JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# All given pages, and hosts that show no text, have a blank homepage, or a blank subpage; hosts whose only page has no
# id, or whose homepage has none; hosts whose pages share one id; hosts with a page crawled twice.
FIXTURES["crawled_pages"] = """
SELECT page_id AS row_no, page_id, url, html FROM pages
UNION ALL SELECT 10000000 + r_regionkey, 10000000 + r_regionkey, 'https://js' || CAST(r_regionkey AS STRING) || '.com/',
       '<html><body><noscript>please enable javascript</noscript></body></html>' FROM region
UNION ALL SELECT 20000000 + n_nationkey, 20000000 + n_nationkey, 'https://blank' || CAST(n_nationkey AS STRING) || '.com/',
       '<html><body></body></html>' FROM nation
UNION ALL SELECT 30000000 + n_nationkey, 30000000 + n_nationkey, 'https://blank' || CAST(n_nationkey AS STRING) || '.com/about', html
FROM nation JOIN pages ON page_id = n_nationkey
UNION ALL SELECT 40000000 + n_nationkey, 40000000 + n_nationkey, 'https://blank' || CAST(n_nationkey AS STRING) || '.com/empty',
       '<html><body> </body></html>' FROM nation
UNION ALL SELECT 50000000 + page_id, NULL, 'https://noid' || CAST(page_id AS STRING) || '.com/', html FROM pages WHERE page_id < 20
UNION ALL SELECT 60000000 + page_id, NULL, 'https://half' || CAST(page_id AS STRING) || '.com/', html FROM pages WHERE page_id < 20
UNION ALL SELECT 61000000 + page_id, page_id, 'https://half' || CAST(page_id AS STRING) || '.com/about', html
FROM pages WHERE page_id < 20
UNION ALL SELECT 70000000 + page_id, 7, 'https://same' || CAST(page_id % 3 AS STRING) || '.com/p' || CAST(page_id AS STRING), html
FROM pages WHERE page_id < 30
UNION ALL SELECT 80000000 + page_id, CASE WHEN page_id % 4 < 2 THEN NULL ELSE page_id % 8 END,
       'https://again' || CAST(page_id % 8 AS STRING) || '.com/', html FROM pages WHERE page_id < 40
UNION ALL SELECT 81000000 + page_id, page_id % 4, 'https://again' || CAST(page_id % 4 AS STRING) || '.com/about', html
FROM pages WHERE page_id < 8"""

FIXTURES["page_rows"] = """
SELECT 'c' || CAST(conv_id AS STRING) || '.com' AS domain, CAST(turn AS BIGINT) AS ord,
       'https://c' || CAST(conv_id AS STRING) || '.com/' || CASE WHEN turn = 0 THEN ''
         WHEN turn % 2 = 0 THEN 'team/p' || CAST(turn AS STRING) || '?ref=a'
         ELSE 'p' || CAST(turn AS STRING) END AS url,
       CASE WHEN conv_id % 9 = 4 THEN 'c' || CAST(conv_id AS STRING) || '.com'
            ELSE 'The ' || role || ' desk of account ' || CAST(conv_id AS STRING) END AS title,
       CASE WHEN conv_id % 9 = 4 OR turn % 3 = 1 THEN '' ELSE '  About ' || role || '  ' END AS description,
       CASE WHEN conv_id % 9 = 4 THEN ''
            ELSE 'Our Work|our work| Team ' || CAST(turn AS STRING) || '|' || substr(text, 1, 30) END AS heads,
       text, conv_id
FROM conversations
UNION ALL
SELECT 's' || CAST(n_nationkey AS STRING) || '.com', CAST(s_suppkey AS BIGINT),
       'https://s' || CAST(n_nationkey AS STRING) || '.com/' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE CAST(s_suppkey AS STRING) END,
       'The ' || n_name || ' desk', '', s_name || '|' || n_name,
       CASE n_nationkey % 5 WHEN 0 THEN 'A few words on ' || s_name
         WHEN 1 THEN repeat('Home About Contact Services Menu ', 9)
         WHEN 2 THEN 'This domain is for sale. ' || s_name
         WHEN 3 THEN 'Please enable JavaScript to go on. ' || n_name ELSE '' END, -1 - n_nationkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

FIXTURES["attempts"] = """
SELECT 'u' || CAST(user_id AS STRING) || '.com' AS domain,
       CASE event_type WHEN 'view' THEN 'plain' WHEN 'click' THEN 'browser' WHEN 'signup' THEN 'tls'
         WHEN 'purchase' THEN 'batched' ELSE 'paged' END AS tier,
       CASE WHEN value > 300 THEN 'ok' WHEN event_id % 5 = 0 THEN 'timeout' ELSE 'thin' END AS status,
       value > 300 AS gate_ok,
       CASE WHEN value > 300 THEN 'pass' WHEN event_id % 5 = 0 THEN 'status:timeout'
            WHEN event_id % 5 = 1 THEN 'parked:buy_this_domain'
            ELSE 'thin:' || CAST(CAST(floor(value) AS BIGINT) AS STRING) || '_chars' END AS gate_reason,
       CAST(floor(value) AS BIGINT) AS chars, event_id AS seq, 'e' || CAST(event_id AS STRING) AS error
FROM events"""

FIXTURES["wanted"] = """
SELECT 'u' || CAST(c_custkey AS STRING) || '.com' AS domain, c_custkey AS seq FROM customer"""

FIXTURES["results"] = """
SELECT 'c' || CAST(p_partkey AS STRING) || '.com' AS domain, p_partkey AS seq,
       p_size > 20 AS gate_ok,
       CASE WHEN p_size > 20 THEN 'ok' WHEN p_size % 9 = 0 THEN 'dns_fail'
            WHEN p_size % 9 = 1 THEN 'http_5xx' WHEN p_size % 9 = 2 THEN 'no_url' ELSE 'thin' END AS status,
       CASE WHEN p_size > 20 THEN 'pass' WHEN p_size % 9 = 0 THEN 'status:dns_fail'
            WHEN p_size % 9 = 1 THEN 'status:http_5xx' WHEN p_size % 9 = 2 THEN 'status:no_url'
            WHEN p_size % 9 = 3 THEN 'parked:coming_soon' WHEN p_size % 9 = 4 THEN 'stub:enable_cookies'
            WHEN p_size % 9 = 5 THEN 'thin:120_chars' WHEN p_size % 9 = 6 THEN 'no_real_title'
            WHEN p_size % 9 = 7 THEN 'single_thin_page:900' ELSE 'surprise' END AS gate_reason,
       CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN 'browser' ELSE 'plain' END AS source_tier,
       CAST(floor(p_retailprice) AS BIGINT) AS chars,
       'DOMAIN: c' || CAST(p_partkey AS STRING) || '.com ' || p_name || ' "' || p_type || '"' AS digest
FROM part"""

FIXTURES["decisions"] = """
SELECT 'c' || CAST(user_id AS STRING) || '.com' AS domain, event_id AS seq,
       CASE WHEN value > 80 THEN 'Good' WHEN value > 30 THEN 'Avg' ELSE 'Unfit' END AS fitment,
       CAST(1 + event_id % 3 AS INT) AS ranking, 'fitment p=' || CAST(event_id % 7 AS STRING) AS why,
       CAST(event_id % 100 AS DOUBLE) / 100 AS p_good,
       CASE WHEN event_id % 3 = 0 THEN 'low fitment confidence 0.30' ELSE '' END AS note,
       'f' || CAST(event_id % 4 AS STRING) AS found_fit, 'm' || CAST(event_id % 3 AS STRING) AS found_mom,
       CASE WHEN event_id % 2 = 0 THEN 'aaaa' ELSE 'bbbb' END AS rubric_sha,
       CAST(floor(value * 10) AS BIGINT) AS input_tokens, 'ok' AS crawl_status, 'plain' AS source_tier,
       'm-1' AS model
FROM events WHERE event_type = 'view'
UNION ALL
SELECT 'c' || CAST(c_custkey AS STRING) || '.com', CAST(NULL AS BIGINT), 'Avg', 2, 'fitment p=0', 0.5, '', 'f0', 'm0',
       CASE WHEN c_custkey % 2 = 0 THEN 'aaaa' ELSE 'cccc' END, CAST(7 AS BIGINT), 'ok', 'plain', 'm-1'
FROM customer WHERE c_custkey % 3 = 0"""

FIXTURES["comments"] = """
SELECT CASE WHEN user_id % 10 = 0 THEN 'x' ELSE 'c' END || CAST(user_id AS STRING) || '.com' AS domain,
       event_id AS seq,
       CASE WHEN event_id % 6 = 0 THEN '  ' ELSE ' note on ' || props || ' ' END AS comments,
       CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS STRING) ELSE props END AS evidence,
       CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS BOOLEAN) ELSE event_id % 5 = 1 END AS disagree
FROM events WHERE event_type = 'click'"""

FIXTURES["verdicts"] = """
SELECT c_custkey AS row_idx, 'c' || CAST(c_custkey AS STRING) || '.com' AS domain, c_custkey AS seq,
       'Unfit' AS fitment, '3' AS ranking, 'Outside target ' || c_mktsegment AS comments,
       'not_crawled' AS crawl_status, 'prefilter' AS source_tier, CAST(NULL AS STRING) AS judge,
       FALSE AS needs_review, FALSE AS disagree
FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT CAST(NULL AS BIGINT), CASE WHEN user_id % 3 = 0 THEN 'w' ELSE 'c' END || CAST(user_id AS STRING) || '.com', event_id,
       CASE event_id % 7 WHEN 0 THEN 'good' WHEN 1 THEN ' AVG ' WHEN 2 THEN 'Unfit' WHEN 3 THEN 'maybe'
         WHEN 4 THEN '' WHEN 5 THEN 'Good' ELSE 'Avg' END,
       CASE event_id % 9 WHEN 0 THEN '1' WHEN 1 THEN ' 2 ' WHEN 2 THEN '3' WHEN 3 THEN '0'
         WHEN 4 THEN 'high' WHEN 5 THEN '7' WHEN 6 THEN CAST(NULL AS STRING) WHEN 7 THEN '2.7' ELSE '1' END,
       '  ' || props || repeat(' more', CAST(event_id % 40 AS INT)) || ' ',
       CASE WHEN event_id % 4 = 0 THEN '' ELSE 'ok' END, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'plain' END,
       CASE WHEN event_id % 3 = 0 THEN 'model' WHEN event_id % 3 = 1 THEN '' ELSE 'manual' END,
       event_id % 3 = 0 AND event_id % 2 = 0, event_id % 6 = 3
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT CAST(NULL AS BIGINT), 'c' || CAST(c_custkey AS STRING) || '.com', CAST(NULL AS BIGINT), 'Good', '1', 'of unknown age',
       '', 'plain', 'manual', FALSE, FALSE
FROM customer WHERE c_custkey % 5 = 0"""

# Signals of the stand-in rubric: kind, id, weight, factor, offset. The probability of a
# signal for document d is ((d * factor + offset) mod 100) / 100.
SIGNALS = [
    ("disqualifier", "competitor", "", 7, 3), ("fit", "regulated", "strong", 37, 11),
    ("fit", "paperwork", "moderate", 41, 5), ("anti-fit", "agency", "strong", 11, 29),
    ("anti-fit", "hardware", "moderate", 13, 7), ("momentum", "hiring", "strong", 17, 40),
    ("momentum", "scale", "moderate", 19, 1),
]
PREFIXES = {"disqualifier": "dq__", "fit": "fit__", "anti-fit": "anti__", "momentum": "mom__"}


def _answers(seq: str, where, shift: int) -> list[str]:
    return [f"SELECT 'd' || CAST(doc_id AS STRING) || '.com' AS domain, '{PREFIXES[k]}{i}' AS qid, "
            f"CAST((doc_id * {a} + {b + shift}) % 100 AS DOUBLE) / 100 AS noul, {seq} AS seq "
            f"FROM documents{where(i)}" for k, i, _, a, b in SIGNALS]


FIXTURES["answers"] = "\nUNION ALL\n".join(
    # One question stays open for some documents; some are answered twice.
    _answers("doc_id", lambda i: " WHERE source <> 'src3'" if i == "hiring" else "", 0)
    + _answers("doc_id + 1000000000", lambda i: " WHERE lang = 'de'", 23)
    # Answers without an order value, the only ones to some questions.
    + [a for a in _answers("CAST(NULL AS BIGINT)", lambda i: " WHERE doc_id % 4 = 1", 51) if "mom__hiring" in a or "dq__" in a])

FIXTURES["grades"] = """
SELECT 'd' || CAST(doc_id AS STRING) || '.com' AS domain,
       CASE doc_id % 5 WHEN 0 THEN 'Good' WHEN 1 THEN 'Avg' WHEN 2 THEN 'maybe'
         WHEN 3 THEN 'Unfit' ELSE CAST(NULL AS STRING) END AS choice,
       CAST(doc_id * 13 % 101 AS DOUBLE) / 100 AS p_good,
       CASE WHEN doc_id % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(doc_id * 29 % 97 AS DOUBLE) / 100 END AS p_avg,
       CAST(doc_id * 7 % 89 AS DOUBLE) / 100 AS p_unfit,
       CASE WHEN doc_id % 23 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(doc_id * 31 % 100 AS DOUBLE) / 100 END AS confidence
FROM documents"""

FIXTURES["rubric_signals"] = """
SELECT 'k' || CAST(CAST(floor(p_partkey / 8) AS BIGINT) AS STRING) AS campaign,
       CASE p_partkey % 4 WHEN 0 THEN 'disqualifier' WHEN 1 THEN 'fit' WHEN 2 THEN 'anti-fit' ELSE 'momentum' END AS kind,
       CAST(p_partkey AS BIGINT) AS ord, CASE WHEN p_size = 7 THEN '' ELSE 's' || CAST(p_partkey AS STRING) END AS id,
       CASE WHEN p_size = 9 THEN '' ELSE p_name || ' "' || p_type || '"' END AS text,
       CASE WHEN p_size % 2 = 0 THEN 'strong' ELSE 'moderate' END AS weight,
       CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS evidence
FROM part"""

FIXTURES["rubrics"] = """
SELECT 'k' || CAST(CAST(floor(p_partkey / 8) AS BIGINT) AS STRING) AS campaign,
       min(CASE WHEN p_size > 40 THEN p_type ELSE '' END) AS offering,
       min(CASE WHEN p_size > 5 THEN p_brand ELSE '' END) AS good, max(p_type) AS avg,
       CAST(NULL AS STRING) AS unfit
FROM part GROUP BY 1"""

#: Sites whose homepages hold twelve links each, and the pages of them that were crawled.
CRAWLED = ["/about-us/", "/careers", "/pricing?x=1", "/Solutions/./x/../y", "/case-studies/1", "/case-studies/2", "/plans", "/privacy"]
FIXTURES["home_links"] = """
SELECT p_partkey, page, 'https://www.shop' || CAST(page AS STRING) || '.co.uk/' AS base, 'www.shop' || CAST(page AS STRING) || '.co.uk' AS site,
  replace(href, '.shop' || CAST(page % 40 AS STRING) || '.', '.shop' || CAST(page AS STRING) || '.') AS href FROM hrefs"""
FIXTURES["linked_crawl"] = " UNION ALL ".join(
    f"SELECT DISTINCT page, {i} AS i, base, substr(base, 1, length(base) - 1) || '{p}' AS url FROM home_links WHERE (page + {i}) % 5 <> 0"
    for i, p in enumerate(CRAWLED))

FIXTURES["hrefs"] = """
SELECT p_partkey, CAST(floor(p_partkey / 12) AS BIGINT) AS page,
       'https://www.shop' || CAST(CAST(floor(p_partkey / 12) AS BIGINT) % 40 AS STRING) || '.co.uk/eu/start' AS base,
       'shop' || CAST(CAST(floor(p_partkey / 12) AS BIGINT) % 40 AS STRING) || '.co.uk' AS site,
       CASE p_size % 18
         WHEN 0 THEN '/about-us/' WHEN 1 THEN '../services/' || p_brand WHEN 2 THEN 'careers/'
         WHEN 3 THEN '//www.shop' || CAST(CAST(floor(p_partkey / 12) AS BIGINT) % 40 AS STRING) || '.co.uk/Solutions/./x/../y'
         WHEN 4 THEN 'mailto:a@x.com' WHEN 5 THEN '/files/report.PDF' WHEN 6 THEN 'https://other.com/about'
         WHEN 7 THEN '/privacy' WHEN 8 THEN '/a/b/c/d/e/products?x=' || CAST(p_size AS STRING)
         WHEN 9 THEN 'ftp://x.com/about' WHEN 10 THEN '?page=2' WHEN 11 THEN '/pricing/'
         WHEN 12 THEN './case-studies/' || CAST(p_partkey % 3 AS STRING) WHEN 13 THEN '' WHEN 14 THEN '/wp-content/x'
         WHEN 15 THEN 'https://blog.shop' || CAST(CAST(floor(p_partkey / 12) AS BIGINT) % 40 AS STRING) || '.co.uk/who-we-are'
         WHEN 16 THEN '/about-us' ELSE '/plans;v=1' END AS href
FROM part"""

FIXTURES["markdown"] = """
SELECT doc_id, 'https://d' || CAST(doc_id AS STRING) || '.com/' AS url, '  ' || source || '  page ' AS title,
       lang AS description,
       '# ' || source || ' [' || lang || '](http://x/y) *' || substr(text, 1, 20) || '*' || chr(10)
       || '![logo](img.png) [home](/h) ' || text || chr(10) || ' | a | b | ' || chr(10) || '-----' || chr(10)
       || '### Part ' || CAST(doc_id AS STRING) || ' ' || chr(92) || chr(92) || '. end' || chr(10)
       || '#### deep' || chr(10) || '> 50' || chr(92) || '% off' || chr(92) || '. `code` ' || chr(92) || chr(92)
       || '_x a' || chr(92) || 'b ' || chr(92) || chr(92) || 'c' || chr(10) || '## ' || text AS markdown
FROM documents"""
