"""Lead tables: positions, profile, pre-filter and selection."""

from pyspark.sql import functions as F

from checks import sql as S
from checks.registry import fixture, query, table
from leadsieve import constants as C
from leadsieve.operators import profile as P, selection as Sel, sites as Sites
from leadsieve.operators.rules import Rule, prefilter, rule_hits
from leadsieve.session import scratch_folder
from leadsieve.sources.commits import BatchLog
from leadsieve.sources.leads import read_leads

c = F.col

RULES = [
    Rule("geo", "Country", accept_values=["america", " EUROPE ", "Asia"], comment=""),
    Rule("tiny", "Employees", min=500, comment="Below minimum headcount " + "x" * 90),
    Rule("huge", "Employees", max=9000),
    Rule("trade", "Industry", reject_values=["Machinery"], reject_contains=["HOLD"]),
]

_LOW = "lower(trim({0}))"


def _hit_sql():
    emp = S.number("Employees")
    why = f"""CASE
      WHEN trim(Country) <> '' AND lower(trim(Country)) NOT IN ('america', 'europe', 'asia')
        THEN 'geo|' || 'Country = ' || trim(Country) || ' (not in target list)'
      WHEN {emp} < 500 THEN 'tiny|Employees = ' || trim(Employees) || ' (below 500)'
      WHEN {emp} > 9000 THEN 'huge|Employees = ' || trim(Employees) || ' (above 9000)'
      WHEN lower(trim(Industry)) = 'machinery' THEN 'trade|Industry = ' || trim(Industry)
      WHEN contains(lower(trim(Industry)), 'hold') THEN 'trade|Industry contains ''HOLD''' END"""
    return f"hits AS (SELECT *, {why} AS hit FROM leads)"


HIT_COMMENT = """left(CASE WHEN hit LIKE 'tiny|%' THEN 'Below minimum headcount ' || repeat('x', 90)
       ELSE split_part(hit, '|', 2) END, 90)"""


@query("with_row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_idx,
  count(*) OVER () AS total FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return Sel.with_row_index(orders, "o_totalprice", "o_orderkey", total="total") \
        .select("o_orderkey", "row_idx", "total")


@query("chunk", """
SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 20) AS BIGINT) AS batch,
  (row_number() OVER (ORDER BY ts, event_id) - 1) % 20 AS place FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id")
    return Sel.chunk(events, "ts", "event_id", size=C.BATCH_DOMAINS).select("event_id", "batch", "place")


@query("read_leads", "SELECT row_idx - 1 AS row_idx, Company, trim(Website) AS Website, Employees FROM (SELECT row_number() OVER (ORDER BY row_idx) AS row_idx, Company, Website, Employees FROM leads)")
def _(spark, sf):
    folder = scratch_folder(spark, "leads-csv")
    leads = fixture(spark, sf, "leads").repartitionByRange(4, "row_idx").sortWithinPartitions("row_idx")
    leads.select("Company", "Website", "Employees").write.csv(folder, header=True, sep=";", quote='"', escape='"')
    return read_leads(spark, folder).select("row_idx", "Company", F.trim("Website").alias("Website"), "Employees")


@query("collect_domains", f"""
SELECT domain, min(row_idx) AS first_row, count(*) AS n_rows
FROM (SELECT row_idx, {S.domain('Website')} AS domain FROM leads) WHERE domain <> '' GROUP BY domain""")
def _(spark, sf):
    return Sites.collect_domains(fixture(spark, sf, "leads"), "Website")


@query("domain_rows", f"SELECT row_idx, {S.domain('Website')} AS domain, trim(Website) AS raw FROM leads")
def _(spark, sf):
    return Sites.domain_rows(fixture(spark, sf, "leads"), "Website")


@query("rule_hits", f"WITH {_hit_sql()} SELECT row_idx, CASE WHEN {S.number('Employees')} < 500 THEN 'Employees = ' || trim(Employees) || ' (below 500)' END AS why FROM hits")
def _(spark, sf):
    return fixture(spark, sf, "leads").select("row_idx", rule_hits(RULES[1], c("Employees")).alias("why"))


@query("prefilter", f"""
WITH {_hit_sql()}
SELECT row_idx, {S.domain('Website')} AS domain, 'Unfit' AS fitment, '3' AS ranking,
  {HIT_COMMENT} AS comments,
  'pre-filter rule ' || split_part(hit, '|', 1) || ': ' || split_part(hit, '|', 2) AS evidence,
  'not_crawled' AS crawl_status, 'prefilter' AS source_tier, 'rule' AS judge
FROM hits WHERE hit IS NOT NULL
  AND row_idx NOT IN (SELECT row_idx FROM verdicts WHERE row_idx IS NOT NULL)""")
def _(spark, sf):
    return prefilter(fixture(spark, sf, "leads"), RULES, "Website", fixture(spark, sf, "verdicts"))


@query("tally_reasons", f"WITH {_hit_sql()} SELECT split_part(hit, '|', 1) AS rule, count(*) AS n FROM hits WHERE hit IS NOT NULL GROUP BY 1")
def _(spark, sf):
    from leadsieve.operators.reports import tally
    hits = prefilter(fixture(spark, sf, "leads"), RULES, "Website")
    return tally(hits.select(F.regexp_extract("evidence", "rule ([a-z]+):", 1).alias("rule")), "rule")


@query("skip_disqualified", f"""
WITH {_hit_sql()}, rows AS (SELECT row_idx, {S.domain('Website')} AS domain, hit FROM hits)
SELECT domain, min(row_idx) AS first_row FROM rows WHERE domain <> ''
GROUP BY domain HAVING NOT bool_and(hit IS NOT NULL)""")
def _(spark, sf):
    leads = fixture(spark, sf, "leads")
    return Sites.skip_disqualified(Sites.domain_rows(leads, "Website"), prefilter(leads, RULES, "Website"))


_COLUMNS = ["Company", "Website", "Country", "Employees", "Industry"]
_LONG = " UNION ALL ".join(
    f"SELECT row_idx, {i} AS ord, '{n}' AS col, trim({n}) AS v FROM leads" for i, n in enumerate(_COLUMNS))


_PROFILE = f"""
WITH long AS ({_LONG}),
filled AS (SELECT col, ord, CAST(floor(100 * count(*) FILTER (v <> '') / count(*)) AS BIGINT) AS filled_pct FROM long GROUP BY ALL),
samples AS (SELECT col, string_agg(v, ' | ' ORDER BY row_idx) AS samples FROM (
  SELECT * FROM long WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY col ORDER BY row_idx) <= 3) GROUP BY col),
counts AS (SELECT col, v, count(*) AS n, min(row_idx) AS first FROM long
  WHERE v <> '' AND col IN ('Country', 'Employees', 'Industry') GROUP BY ALL),
tops AS (SELECT col, string_agg(v || ' (' || n || ')', ' | ' ORDER BY n DESC, first) AS top_values FROM (
  SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, first) <= 4) GROUP BY col),
uniq AS (SELECT col, count(*) AS n_distinct FROM counts GROUP BY col)
SELECT filled.col AS "column", ord, filled_pct, samples, n_distinct, top_values
FROM filled LEFT JOIN samples USING (col) LEFT JOIN uniq USING (col) LEFT JOIN tops USING (col)"""


@query("profile_columns", _PROFILE)
def _(spark, sf):
    return P.profile_columns(fixture(spark, sf, "leads"))


@query("score_url_columns", f"""
WITH long AS ({_LONG}),
sampled AS (SELECT * FROM long WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY col ORDER BY row_idx) <= 200),
shares AS (SELECT col, ord, avg(CASE WHEN {S.domain('v')} <> '' THEN 1.0 ELSE 0.0 END) AS host_share FROM sampled GROUP BY ALL),
scored AS (SELECT *, CASE col WHEN 'Website' THEN 50 ELSE 0 END + CAST(floor(host_share * 60) AS BIGINT) AS score FROM shares)
SELECT col AS "column", ord, host_share, score, row_number() OVER (ORDER BY score DESC, ord) = 1 AS best FROM scored""")
def _(spark, sf):
    return P.score_url_columns(fixture(spark, sf, "leads"))


_HEALTH = f"""
WITH d AS (SELECT {S.domain('Website')} AS domain, trim(Website) = '' AS blank FROM leads),
per AS (SELECT domain, count(*) AS n FROM d WHERE domain <> '' GROUP BY 1)
SELECT (SELECT CAST(sum(n) AS BIGINT) FROM per) AS usable, (SELECT count(*) FROM per) AS unique_domains,
  (SELECT count(*) FROM d WHERE blank) AS blank,
  (SELECT count(*) FROM d WHERE NOT blank AND domain = '') AS unparseable,
  (SELECT count(*) FROM per WHERE n > 1) AS duplicate_domains,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM per WHERE n > 1) AS duplicate_rows"""


@query("url_health", _HEALTH)
def _(spark, sf):
    return P.url_health(fixture(spark, sf, "leads"), "Website")


def merged_facts(spark, sf):
    """Facts of the leads in three parts of neighbouring rows, stored as batches; one comes twice."""
    leads = fixture(spark, sf, "leads")
    log = BatchLog(spark, scratch_folder(spark, "facts"), P.FACTS)
    third = table(spark, sf, "orders").count() // 3
    for part in (1, 0, 2, 1):
        rows = leads.where(F.least(F.floor(c("row_idx") / (third + 1)), F.lit(2)) == part)
        log.append(P.profile_facts(rows, "Website", part), f"leads {part}.csv")
    return log.read()


@query("merged_profile", _PROFILE)
def _(spark, sf):
    return P.merged_profile(merged_facts(spark, sf))


@query("merged_url_health", _HEALTH)
def _(spark, sf):
    return P.merged_url_health(merged_facts(spark, sf))


@query("unparseable_cells", f"""
SELECT row_idx, row_idx + 2 AS line, Website AS value FROM leads WHERE trim(Website) <> '' AND {S.domain('Website')} = ''""")
def _(spark, sf):
    return P.unparseable_cells(fixture(spark, sf, "leads"), "Website")


@query("repeated_domains", f"""
SELECT {S.domain('Website')} AS domain, count(*) AS n, min(row_idx) AS first_row FROM leads
WHERE {S.domain('Website')} <> '' GROUP BY 1 HAVING count(*) > 1""")
def _(spark, sf):
    return P.repeated_domains(fixture(spark, sf, "leads"), "Website")


def context_sql():
    bits = ", ".join(f"CASE WHEN trim({n}) <> '' THEN '{n}=' || left(trim({n}), 40) END"
                     for n in ("Company", "Country", "Employees", "Industry"))
    return f"""contexts AS (SELECT domain, row_idx AS first_row, concat_ws(' | ', {bits}) AS context
      FROM (SELECT *, {S.domain('Website')} AS domain FROM leads) WHERE domain <> ''
      QUALIFY row_number() OVER (PARTITION BY domain ORDER BY row_idx) = 1)"""


@query("lead_context", f"WITH {context_sql()} SELECT * FROM contexts")
def _(spark, sf):
    return P.lead_context(fixture(spark, sf, "leads"), "Website")


@query("top_k", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 10")
def _(spark, sf):
    return Sel.top_k(table(spark, sf, "part"), "p_type", 10)


_WORDS = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


@query("frequent", f"SELECT word, count(*) AS n FROM ({_WORDS}) GROUP BY 1 ORDER BY n DESC, word LIMIT 40")
def _(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ", -1)).alias("word"))
    return Sel.frequent(words, "word", 40)


@query("latest_by", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def _(spark, sf):
    return Sel.latest_by(table(spark, sf, "events").select("user_id", "event_id", "event_type", "value"),
                         "user_id", "event_id")


@query("first_by", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def _(spark, sf):
    return Sel.first_by(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"),
                        "o_custkey", "o_orderkey")


@query("cap_escalations", """
WITH todo AS (SELECT domain, seq FROM wanted WHERE domain NOT IN (SELECT domain FROM attempts WHERE gate_ok))
SELECT domain, seq FROM todo QUALIFY row_number() OVER (ORDER BY seq)
  <= greatest(1, floor(0.3 * (SELECT count(*) FROM wanted)))""")
def _(spark, sf):
    wanted = fixture(spark, sf, "wanted")
    todo = Sel.pending(wanted, fixture(spark, sf, "attempts").where("gate_ok"))
    return Sel.cap_share(todo.select("domain", "seq"), "seq", share=C.ESCALATION_SHARE, of=wanted)
