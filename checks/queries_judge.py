"""Questions, decisions, verdict logs and reports."""

from pyspark.sql import functions as F

from checks import sql as S
from checks.fixtures import PREFIXES, SIGNALS
from checks.queries_leads import HIT_COMMENT, RULES, _hit_sql, context_sql
from checks.registry import fixture, query, table
from leadsieve import constants as C
from leadsieve.functions.text import rounded
from leadsieve.operators import decide as J, reports as R, selection as Sel, verdicts as V
from leadsieve.session import scratch_folder
from leadsieve.plans.campaign import qualify
from leadsieve.plans.progress import ProgressStore
from leadsieve.sources.commits import BatchLog
from leadsieve.sources.leads import read_leads, write_qualified
from leadsieve.sources.logs import append_log, read_log
from leadsieve.sources.rubric import Rubric, with_sha

c = F.col
RUBRIC = [J.Signal(kind, id_, f"{kind} {id_}", weight) for kind, id_, weight, _, _ in SIGNALS]
_TABLE = "sig AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{PREFIXES[k]}{i}', '{k}', '{i}', '{k} {i}', '{w}', {n}, "
    f"{C.DISQUALIFIER_FIRES if k == 'disqualifier' else C.SIGNAL_PRESENT}::DOUBLE)"
    for n, (k, i, w, _, _) in enumerate(SIGNALS)) + ") t(qid, kind, id, txt, weight, ord, bar))"
_LATEST = "latest AS (SELECT * FROM answers QUALIFY row_number() OVER (PARTITION BY domain, qid ORDER BY seq DESC) = 1)"
_COMPLETE = (f"full_set AS (SELECT domain FROM latest GROUP BY domain HAVING count(DISTINCT qid) = {len(SIGNALS)}), "
             "hits AS (SELECT l.domain, l.qid, l.noul, sig.*  EXCLUDE (qid), l.noul >= bar AS hit FROM latest l "
             "JOIN sig USING (qid) JOIN full_set USING (domain))")


def decisions(spark, sf):
    """Decision log rows with their nested fields."""
    log = fixture(spark, sf, "decisions")
    empty = F.array().cast("array<string>")

    def signal(kind, col):
        return F.struct(F.lit(kind).alias("kind"), c(col).alias("id"),
                        F.concat(F.lit("text of "), c(col)).alias("text"), F.lit(0.9).alias("p"))

    return log.select(
        "*", F.create_map(F.lit("Good"), c("p_good")).alias("fitment_probabilities"),
        F.when(c("note") != "", F.array("note")).otherwise(empty).alias("needs_review"),
        F.array(signal("fit", "found_fit"), signal("momentum", "found_mom")).alias("signals_present")) \
        .drop("p_good", "note", "found_fit", "found_mom")


@query("answers_with_signals", f"""
WITH {_TABLE}
SELECT domain, qid, seq, noul, kind, id, weight, ord, noul >= bar AS present FROM answers JOIN sig USING (qid)""")
def _(spark, sf):
    return J.answers_with_signals(fixture(spark, sf, "answers"), RUBRIC).drop("text", "threshold")


@query("answers_wide", f"WITH {_LATEST} SELECT domain, " + ", ".join(
    f"max(CASE WHEN qid = '{PREFIXES[k]}{i}' THEN noul END) AS \"p_{PREFIXES[k]}{i}\"" for k, i, *_ in SIGNALS)
    + " FROM latest GROUP BY domain")
def _(spark, sf):
    return J.answers_wide(fixture(spark, sf, "answers"), RUBRIC)


@query("complete_answers", f"WITH {_LATEST} SELECT domain FROM latest GROUP BY domain HAVING count(DISTINCT qid) = {len(SIGNALS)}")
def _(spark, sf):
    wide = J.answers_wide(fixture(spark, sf, "answers"), RUBRIC)
    return J.complete_answers(wide, RUBRIC).select("domain")


_KINDS = [("disqualifier", "dq"), ("fit", "fit"), ("anti-fit", "anti"), ("momentum", "mom")]
_ROLLUP = "rolled AS (SELECT domain, " + ", ".join(
    f"CAST(count(*) FILTER (hit AND kind = '{k}') AS INT) AS n_{s}, "
    f"CAST(count(*) FILTER (hit AND kind = '{k}' AND weight = 'strong') AS INT) AS n_strong_{s}, "
    f"arg_min(id, ord) FILTER (hit AND kind = '{k}') AS first_{s}, "
    f"arg_min(id, ord) FILTER (hit AND kind = '{k}' AND weight = 'strong') AS first_strong_{s}, "
    f"coalesce(string_agg(id, ', ' ORDER BY ord) FILTER (hit AND kind = '{k}'), '') AS ids_{s}"
    for k, s in _KINDS) + (
    ", coalesce(string_agg(kind || ':' || id || ':' || txt || ':' || printf('%.3f', noul), ' ' ORDER BY ord) "
    "FILTER (hit), '') AS present FROM hits GROUP BY domain)")
_DECIDE_BASE = f"{_TABLE}, {_LATEST}, {_COMPLETE}, {_ROLLUP}"


@query("signal_rollup", f"WITH {_DECIDE_BASE} SELECT * FROM rolled")
def _(spark, sf):
    wide = J.complete_answers(J.answers_wide(fixture(spark, sf, "answers"), RUBRIC), RUBRIC)
    rolled = J.signal_rollup(wide, RUBRIC).drop(*[f"p_{s.qid}" for s in RUBRIC])
    for short in J.SHORT.values():
        rolled = rolled.withColumn(f"ids_{short}", F.array_join(f"ids_{short}", ", "))
    shown = F.transform("signals_present", lambda s: F.concat_ws(
        ":", s["kind"], s["id"], s["text"], F.format_number(s["p"], 3)))
    return rolled.withColumn("present", F.array_join(shown, " ")).drop("signals_present")


_DECIDED = f"""{_DECIDE_BASE},
    g AS (SELECT domain, choice, coalesce(p_good, 0) AS pg, coalesce(p_avg, 0) AS pa, coalesce(p_unfit, 0) AS pu,
      coalesce(confidence, 0) AS conf FROM grades),
    tops AS (SELECT *, CASE WHEN choice IN ('Good', 'Avg', 'Unfit') THEN choice WHEN pg >= pa AND pg >= pu THEN 'Good'
      WHEN pa >= pu THEN 'Avg' ELSE 'Unfit' END AS top FROM g JOIN rolled USING (domain)),
    lowers AS (SELECT *, CASE top WHEN 'Good' THEN 'Avg' WHEN 'Avg' THEN 'Unfit' END AS low,
      CASE top WHEN 'Good' THEN pg WHEN 'Avg' THEN pa ELSE pu END AS p_top,
      CASE top WHEN 'Good' THEN pa WHEN 'Avg' THEN pu END AS p_low FROM tops),
    torn AS (SELECT *, low IS NOT NULL AND p_top - p_low < 0.15 AS t FROM lowers),
    steps AS (SELECT *, CASE WHEN t THEN low ELSE top END AS g1 FROM torn),
    graded AS (SELECT *, n_strong_anti > 0 AND g1 <> 'Unfit' AS forced,
      CASE WHEN n_dq > 0 OR n_strong_anti > 0 THEN 'Unfit' ELSE g1 END AS fitment FROM steps),
    decided AS (SELECT *, CASE fitment WHEN 'Unfit' THEN 3 WHEN 'Good' THEN CASE WHEN n_mom > 0 THEN 1 ELSE 2 END
      ELSE CASE WHEN n_strong_mom > 0 THEN 2 ELSE 3 END END AS ranking,
      CASE WHEN n_dq > 0 THEN 'disqualified by ' || first_dq ELSE concat_ws('; ',
        'fitment ' || top || ' p=' || printf('%.2f', p_top),
        CASE WHEN t THEN 'torn with ' || low || ' p=' || printf('%.2f', p_low) || ', took the lower grade' END,
        CASE WHEN forced THEN 'strong anti-fit ' || first_strong_anti END,
        CASE WHEN fitment <> 'Unfit' THEN CASE WHEN n_mom > 0 THEN 'momentum ' || ids_mom ELSE 'no momentum signal' END END) END AS why,
      CASE WHEN n_dq > 0 THEN '' ELSE concat_ws('; ',
        CASE WHEN conf < 0.5 THEN 'low fitment confidence ' || printf('%.2f', conf) END,
        CASE WHEN fitment = 'Good' AND n_fit = 0 THEN 'Good with no fit signal found on the site' END) END AS review FROM graded)"""


def decided(spark, sf):
    return J.decide(fixture(spark, sf, "answers"), fixture(spark, sf, "grades"), RUBRIC)


@query("decide", f"""
WITH {_DECIDED}
SELECT domain, fitment, CAST(ranking AS INT) AS ranking, first_dq AS disqualified_by, round(pg, 3) AS p_good,
  round(pa, 3) AS p_avg, round(pu, 3) AS p_unfit, round(conf, 3) AS fitment_confidence, present,
  round((SELECT sum(noul) FROM latest l WHERE l.domain = decided.domain), 2) AS signal_sum FROM decided""")
def _(spark, sf):
    p = c("fitment_probabilities")
    shown = F.transform("signals_present", lambda s: F.concat_ws(
        ":", s["kind"], s["id"], s["text"], F.format_number(s["p"], 3)))
    total = F.aggregate(F.map_values("signals"), F.lit(0.0), lambda a, x: a + x)
    return decided(spark, sf).select(
        "domain", "fitment", "ranking", "disqualified_by", p["Good"].alias("p_good"), p["Avg"].alias("p_avg"),
        p["Unfit"].alias("p_unfit"), "fitment_confidence", F.array_join(shown, " ").alias("present"),
        F.round(total, 2).alias("signal_sum"))


@query("decision_why", f"WITH {_DECIDED} SELECT domain, why FROM decided")
def _(spark, sf):
    return decided(spark, sf).select("domain", "why")


@query("review_flags", f"WITH {_DECIDED} SELECT domain, review FROM decided")
def _(spark, sf):
    return decided(spark, sf).select("domain", F.array_join("needs_review", "; ").alias("review"))


_PASSED = "gate AS (SELECT 'd' || doc_id || '.com' AS domain FROM documents WHERE n_chars > 400)"
_OLD = "old AS (SELECT 'd' || doc_id || '.com' AS domain FROM labels WHERE quality = 1)"


@query("incremental_decide", f"""
WITH {_DECIDED}, {_PASSED}, {_OLD}
SELECT domain, fitment, CAST(ranking AS INT) AS ranking FROM decided
WHERE domain IN (SELECT domain FROM gate) AND domain NOT IN (SELECT domain FROM old)""")
def _(spark, sf):
    name = F.concat(F.lit("d"), "doc_id", F.lit(".com")).alias("domain")
    sites = table(spark, sf, "documents").select(name, (c("n_chars") > 400).alias("gate_ok"))
    old = table(spark, sf, "labels").where("quality = 1").select(name)
    return J.incremental_decide(sites, fixture(spark, sf, "answers"), fixture(spark, sf, "grades"), old, RUBRIC) \
        .select("domain", "fitment", "ranking")


def _json(e):
    return f"CAST(to_json({e}) AS VARCHAR)"


_USABLE = "usable AS (SELECT * FROM rubric_signals WHERE id <> '' AND (kind = 'disqualifier' OR text <> ''))"
_NOULS = f"""nouls AS (SELECT campaign, CASE kind WHEN 'disqualifier' THEN 'dq__' WHEN 'fit' THEN 'fit__'
    WHEN 'anti-fit' THEN 'anti__' ELSE 'mom__' END || id AS qid, 'noul' AS type,
    CASE WHEN kind = 'momentum' THEN {S.lit(C.ASK_TIMING)} ELSE {S.lit(C.ASK_TRUE)} END || text || '"?' AS instructions,
    CASE kind WHEN 'disqualifier' THEN {S.lit(C.PROOF)} || CASE WHEN evidence = '' THEN {S.lit(C.DEFAULT_PROOF)} ELSE evidence END
      WHEN 'momentum' THEN {S.lit(C.SHOWN_SIGN)} ELSE {S.lit(C.SHOWN)} END AS yes FROM usable)"""
_NOUL_ROWS = f"""noul_rows AS (SELECT campaign, qid, type, instructions,
    '{{"true":' || {_json('yes')} || ',"false":' || {_json(S.lit(C.NOT_SHOWN))} || '}}' AS criteria FROM nouls)"""
_LISTS = """lists AS (SELECT campaign, list(text ORDER BY ord) FILTER (kind = 'fit' AND weight = 'strong') AS strong,
    list(text ORDER BY ord) FILTER (kind = 'fit') AS fit, list(text ORDER BY ord) FILTER (kind = 'anti-fit') AS antis
    FROM usable GROUP BY campaign)"""


def _tier(col, name):
    return _json(f"CASE WHEN coalesce({col}, '') = '' THEN {S.lit(C.DEFAULT_TIERS[name])} ELSE {col} END")


_GRADE_ROWS = f"""grade_rows AS (SELECT r.campaign, 'fitment' AS qid, 'choice' AS type,
    '{{"question":' || {_json(S.lit(C.GRADE_ASK))} || CASE WHEN offering <> '' THEN ',"what_we_sell":' || {_json('offering')} ELSE '' END
      || ',"judge_on":' || {_json(S.lit(C.GRADE_JUDGE_ON))} || ',"tiebreaker":' || {_json(S.lit(C.GRADE_TIEBREAKER))} || '}}' AS instructions,
    '{{"Good":{{"definition":' || {_tier('good', 'Good')}
      || CASE WHEN coalesce(strong, fit) IS NOT NULL THEN ',"look_for":' || {_json('coalesce(strong, fit)')} ELSE '' END
      || '}},"Avg":{{"definition":' || {_tier('"avg"', 'Avg')} || ',"also":' || {_json(S.lit(C.GRADE_AVG_ALSO))}
      || '}},"Unfit":{{"definition":' || {_tier('unfit', 'Unfit')}
      || CASE WHEN antis IS NOT NULL THEN ',"look_for":' || {_json("antis")} ELSE '' END
      || ',"also":' || {_json(S.lit(C.GRADE_UNFIT_ALSO))} || '}}}}' AS criteria
  FROM rubrics r LEFT JOIN lists USING (campaign))"""
_QUESTIONS = f"{_USABLE}, {_NOULS}, {_NOUL_ROWS}, {_LISTS}, {_GRADE_ROWS}"


@query("build_questions", f"WITH {_QUESTIONS} SELECT * FROM noul_rows UNION ALL SELECT * FROM grade_rows")
def _(spark, sf):
    return J.build_questions(fixture(spark, sf, "rubric_signals"), fixture(spark, sf, "rubrics")).drop("chars")


@query("build_state", f"""
SELECT domain, CASE WHEN source_tier = '' THEN '{{"website":' || {_json('digest')} || '}}'
  ELSE '{{"website":' || {_json('digest')} || ',"lead_record":' || {_json('source_tier')} || '}}' END AS state FROM results""")
def _(spark, sf):
    return fixture(spark, sf, "results").select("domain", J.build_state(c("digest"), c("source_tier")).alias("state"))


@query("load_rubric", """
SELECT campaign, 'rule' AS kind, p_partkey % 8 AS ord, 's' || p_partkey AS id, p_brand AS text, CAST(p_size AS DOUBLE) AS bound
FROM (SELECT *, 'k' || CAST(floor(p_partkey / 8) AS BIGINT) AS campaign FROM part) WHERE p_size % 2 = 0 AND p_size % 5 <> 0
UNION ALL SELECT campaign, 'disqualifier', p_partkey % 8, 's' || p_partkey, p_type, NULL
FROM (SELECT *, 'k' || CAST(floor(p_partkey / 8) AS BIGINT) AS campaign FROM part) WHERE p_size % 2 = 1
UNION ALL SELECT campaign, 'momentum', p_partkey % 8, 'm' || p_partkey, p_name, NULL
FROM (SELECT *, 'k' || CAST(floor(p_partkey / 8) AS BIGINT) AS campaign FROM part) WHERE p_size % 3 <> 0""")
def _(spark, sf):
    from leadsieve.sources.rubric import explode_rubrics
    crawl = c("p_size") % 2 == 1
    rule = F.struct(
        F.concat(F.lit("s"), "p_partkey").alias("id"), c("p_type").alias("rule"),
        F.when(crawl, "crawl").otherwise("csv").alias("checkable_from"),
        F.when(crawl, None).when(c("p_size") % 5 == 0, "").otherwise(c("p_brand")).alias("column"),
        c("p_size").alias("min"))
    sign = F.struct(F.concat(F.lit("m"), "p_partkey").alias("id"),
                    F.when(c("p_size") % 3 == 0, "").otherwise(c("p_name")).alias("signal"))
    in_order = lambda s: F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", s.alias("x")))), lambda e: e["x"])
    # Eight entries per document.
    documents = table(spark, sf, "part").groupBy(
        F.concat(F.lit("k"), F.floor(c("p_partkey") / 8)).alias("campaign")).agg(
        F.to_json(F.struct(in_order(rule).alias("disqualifiers"), in_order(sign).alias("momentum_signals"))).alias("rubric"))
    rules, signals = explode_rubrics(documents)
    none = F.lit(None).cast("double").alias("bound")
    return rules.select("campaign", F.lit("rule").alias("kind"), "ord", "id", c("column").alias("text"), c("min").alias("bound")) \
        .unionByName(signals.select("campaign", "kind", "ord", "id", "text", none))


# A blank follows every colon and comma between JSON parts.
_Q_CHARS = f"""q AS (SELECT CAST(sum(n) + 2 + 2 * (count(*) - 1) AS BIGINT) AS chars, campaign FROM (
    SELECT campaign, length({_json('qid')}) + 2 + length('{{"type":"noul","instructions":' || {_json('instructions')}
      || ',"criteria":' || criteria || '}}') + 8 AS n FROM noul_rows
    UNION ALL SELECT campaign, length('"fitment": ') + length('{{"type":"choice","instructions":' || instructions || ',"criteria":' || criteria || '}}')
      + 2 * (14 + CASE WHEN offering <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(strong, fit) IS NOT NULL THEN 1 ELSE 0 END
        + CASE WHEN antis IS NOT NULL THEN 1 ELSE 0 END) - 6
      + greatest(len(coalesce(strong, fit, [])) - 1, 0) + greatest(len(coalesce(antis, [])) - 1, 0)
    FROM grade_rows JOIN rubrics USING (campaign) LEFT JOIN lists USING (campaign)) GROUP BY campaign)"""
_TOKENS = f"""{_QUESTIONS}, {_Q_CHARS},
  toks AS (SELECT domain, CAST(floor((chars_q + len(CASE WHEN source_tier = '' THEN '{{"website": ' || {_json('digest')} || '}}'
    ELSE '{{"website": ' || {_json('digest')} || ', "lead_record": ' || {_json('source_tier')} || '}}' END)) / 4) AS BIGINT) AS tokens
  FROM (SELECT r.*, q.chars AS chars_q FROM results r JOIN q ON q.campaign = 'k' || CAST(CAST(floor(r.seq / 8) AS BIGINT) AS VARCHAR)))"""


def tokens(spark, sf):
    questions = J.build_questions(fixture(spark, sf, "rubric_signals"), fixture(spark, sf, "rubrics"))
    states = fixture(spark, sf, "results").withColumn(
        "campaign", F.concat(F.lit("k"), F.floor(c("seq") / 8).cast("string")))
    return states.join(J.questions_chars(questions), "campaign").select(
        "domain", J.estimate_tokens(c("digest"), c("source_tier"), c("question_chars")).alias("tokens"))


@query("estimate_tokens", f"WITH {_TOKENS} SELECT * FROM toks")
def _(spark, sf):
    return tokens(spark, sf)


@query("estimate_cost", f"""
WITH {_TOKENS}
SELECT count(*) AS domains, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(tokens) * 0.042 / 1e6, 8) AS usd,
  sum(tokens) * 0.042 / 1e6 <= 5 AS within_cap FROM toks""")
def _(spark, sf):
    return J.estimate_cost(tokens(spark, sf)).withColumn("usd", F.round("usd", 8))


@query("spend_guard", """
SELECT o_orderkey, o_totalprice / 100000 <= 5.0 AS allowed,
  CASE WHEN o_orderstatus = 'P' OR o_totalprice = 0 THEN TRUE ELSE o_totalprice - o_totalprice * (o_orderkey % 2) > 5.0 END AS room
FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    used = F.when(c("o_orderstatus") != "P", c("o_totalprice") * (c("o_orderkey") % 2))
    return J.spend_guard(orders, c("o_totalprice") / 100000).select(
        "o_orderkey", "allowed", J.budget_headroom(used, c("o_totalprice")).alias("room"))


_DEC = f"dec AS {S.latest('decisions', 'domain')}"
_SAID = f"said AS (SELECT * FROM {S.latest('comments', 'domain')} WHERE trim(comments) <> '')"
_DONE = "done AS (SELECT DISTINCT domain FROM verdicts WHERE row_idx IS NULL)"


@query("stale_decisions", f"WITH {_DEC} SELECT domain, rubric_sha FROM dec WHERE rubric_sha <> 'aaaa'")
def _(spark, sf):
    return R.stale_decisions(fixture(spark, sf, "decisions"), "aaaa").select("domain", "rubric_sha")


@query("rubric_sha", """
SELECT p_partkey, left(sha1('{"offering_summary": "' || p_name || '", "tier": ["' || p_type || '"]}'), 12) AS sha FROM part""")
def _(spark, sf):
    # Keys in another order, which the fingerprint does not depend on.
    document = F.to_json(F.struct(F.array("p_type").alias("tier"), F.col("p_name").alias("offering_summary")))
    return with_sha(table(spark, sf, "part").select("p_partkey", document.alias("content")), column="sha").drop("content")


@query("finalize", f"""
WITH {_DEC}, {_SAID}, {_DONE}
SELECT d.domain, fitment, CAST(ranking AS VARCHAR) AS ranking, trim(s.comments) AS comments,
  coalesce(s.evidence, '') AS evidence, crawl_status, source_tier, model,
  CASE WHEN note <> '' THEN note ELSE '' END AS needs_review, 'model' AS judge, coalesce(s.disagree, FALSE) AS disagree
FROM dec d JOIN said s USING (domain) WHERE domain NOT IN (SELECT domain FROM done)""")
def _(spark, sf):
    return V.finalize(decisions(spark, sf), fixture(spark, sf, "comments"), fixture(spark, sf, "verdicts")) \
        .withColumn("needs_review", F.array_join("needs_review", "; "))


@query("missing_comments", f"WITH {_DEC}, {_SAID} SELECT domain, seq FROM dec WHERE domain NOT IN (SELECT domain FROM said)")
def _(spark, sf):
    return V.missing_comments(fixture(spark, sf, "decisions"), fixture(spark, sf, "comments")).select("domain", "seq")


@query("orphan_comments", f"SELECT domain, seq FROM {S.latest('comments', 'domain')} WHERE domain NOT IN (SELECT domain FROM decisions)")
def _(spark, sf):
    return V.orphan_comments(fixture(spark, sf, "decisions"), fixture(spark, sf, "comments")).select("domain", "seq")


@query("both_progress", """
SELECT count(DISTINCT domain) AS decided,
  count(DISTINCT domain) FILTER (domain IN (SELECT domain FROM comments)) AS commented,
  count(DISTINCT domain) FILTER (domain IN (SELECT domain FROM verdicts WHERE row_idx IS NULL)) AS finalized FROM decisions""")
def _(spark, sf):
    return V.both_progress(fixture(spark, sf, "decisions"), fixture(spark, sf, "comments"), fixture(spark, sf, "verdicts"))


@query("decided_and_commented", "SELECT domain FROM decisions INTERSECT SELECT domain FROM comments")
def _(spark, sf):
    return Sel.in_both(fixture(spark, sf, "decisions"), fixture(spark, sf, "comments"))


@query("all_verdicts", f"""
WITH {_DEC}, {_SAID}, {_DONE}
SELECT domain, fitment, judge FROM verdicts
UNION ALL SELECT domain, 'Unfit', 'rule' FROM results WHERE NOT gate_ok AND domain NOT IN (SELECT domain FROM done)
UNION ALL SELECT domain, fitment, 'model' FROM dec JOIN said USING (domain) WHERE domain NOT IN (SELECT domain FROM done)""")
def _(spark, sf):
    log = fixture(spark, sf, "verdicts")
    failed = V.resolve_failed(fixture(spark, sf, "results"), log)
    final = V.finalize(fixture(spark, sf, "decisions"), fixture(spark, sf, "comments"), log)
    return V.all_verdicts(log, failed, final.drop("needs_review")).select("domain", "fitment", "judge")


_JUDGE = "coalesce(nullif(judge, ''), CASE WHEN source_tier = 'prefilter' THEN 'rule' ELSE 'manual' END)"


@query("judge_of", f"SELECT seq, domain, {_JUDGE} AS judge FROM verdicts")
def _(spark, sf):
    return fixture(spark, sf, "verdicts").select("seq", "domain", V.judge_of(c("judge"), c("source_tier")).alias("judge"))


_FIT = "lower(trim(coalesce(nullif(fitment, ''), 'Unfit')))"
_RANK = "CASE WHEN regexp_matches(trim(coalesce(ranking, '')), '^[+-]?[0-9]+$') THEN nullif(CAST(trim(ranking) AS INT), 0) END"
_COERCED = f"""CASE {_FIT} WHEN 'good' THEN 'Good' WHEN 'avg' THEN 'Avg' ELSE 'Unfit' END AS fitment,
  CASE WHEN {_RANK} IN (1, 2, 3) THEN {_RANK} ELSE 3 END AS ranking, left(trim(comments), 120) AS comments,
  {_FIT} NOT IN ('good', 'avg', 'unfit') AS bad_fitment, coalesce({_RANK} NOT IN (1, 2, 3), FALSE) AS bad_ranking"""


@query("coerce_verdict", f"SELECT seq, domain, {_COERCED} FROM verdicts")
def _(spark, sf):
    return V.coerce_verdict(fixture(spark, sf, "verdicts").select("seq", "domain", "fitment", "ranking", "comments"))


_MERGED = f"""
  l AS (SELECT *, {S.domain('Website')} AS domain FROM leads),
  rowv AS {S.latest('(SELECT * FROM verdicts WHERE row_idx IS NOT NULL)', 'row_idx')},
  domv AS {S.latest('(SELECT * FROM verdicts WHERE row_idx IS NULL)', 'domain')},
  crawl AS {S.latest('results', 'domain')},
  v AS (SELECT row_idx AS k_row, NULL AS k_dom, * FROM rowv),
  picked AS (SELECT l.row_idx, l.Company, l.Website, l.Country, l.Employees, l.Industry,
    r.row_idx IS NOT NULL OR d.domain IS NOT NULL AS assessed, c.status AS st,
    CASE WHEN r.row_idx IS NOT NULL THEN r.fitment WHEN d.domain IS NOT NULL THEN d.fitment ELSE 'Unfit' END AS fitment,
    CASE WHEN r.row_idx IS NOT NULL THEN r.ranking WHEN d.domain IS NOT NULL THEN d.ranking ELSE '3' END AS ranking,
    CASE WHEN r.row_idx IS NOT NULL THEN r.comments WHEN d.domain IS NOT NULL THEN d.comments ELSE 'Not assessed' END AS comments,
    CASE WHEN r.row_idx IS NOT NULL THEN r.crawl_status WHEN d.domain IS NOT NULL THEN d.crawl_status END AS cs,
    CASE WHEN r.row_idx IS NOT NULL THEN r.source_tier WHEN d.domain IS NOT NULL THEN d.source_tier ELSE 'none' END AS source_tier,
    CASE WHEN r.row_idx IS NOT NULL THEN r.judge WHEN d.domain IS NOT NULL THEN d.judge ELSE 'none' END AS judge,
    CASE WHEN r.row_idx IS NOT NULL THEN r.needs_review WHEN d.domain IS NOT NULL THEN d.needs_review ELSE FALSE END AS flagged,
    CASE WHEN r.row_idx IS NOT NULL THEN r.disagree WHEN d.domain IS NOT NULL THEN d.disagree ELSE FALSE END AS disagree
    FROM l LEFT JOIN rowv r USING (row_idx) LEFT JOIN domv d ON d.domain = l.domain LEFT JOIN crawl c ON c.domain = l.domain),
  merged AS (SELECT row_idx, Company, Website, Country, Employees, Industry, assessed, {_COERCED},
    CASE WHEN assessed THEN coalesce(nullif(cs, ''), nullif(st, ''), '') ELSE coalesce(nullif(st, ''), 'not_crawled') END AS crawl_status,
    coalesce(nullif(source_tier, ''), 'none') AS tier, {_JUDGE} AS judge, flagged, disagree,
    source_tier = 'prefilter' AS pre FROM picked)"""


def merged(spark, sf):
    return V.merge_verdicts(fixture(spark, sf, "leads"), fixture(spark, sf, "verdicts"),
                            fixture(spark, sf, "results"), "Website")


@query("merge_verdicts", f"""
WITH {_MERGED} SELECT row_idx, Company, Website, Country, Employees, Industry, fitment AS "Fitment", ranking AS "Ranking",
  comments AS "Comments", crawl_status AS "Crawl_Status" FROM merged""")
def _(spark, sf):
    return V.qualified(merged(spark, sf))


# Rule verdicts of rows, failed sites without a verdict, and the domain verdicts of both judges.
_GIVEN = f"""{_hit_sql()}, recent AS {S.latest('results', 'domain')},
  given AS (SELECT row_idx, '' AS domain, 0 AS seq, 'Unfit' AS fitment, '3' AS ranking, {HIT_COMMENT} AS comments,
    'not_crawled' AS crawl_status, 'prefilter' AS source_tier, 'rule' AS judge, FALSE AS needs_review, FALSE AS disagree
    FROM hits WHERE hit IS NOT NULL
  UNION ALL SELECT NULL, domain, 0, 'Unfit', '3', {S.comment_for('gate_reason')}, status,
    coalesce(nullif(source_tier, ''), 'none'), 'rule', FALSE, FALSE
    FROM recent WHERE NOT gate_ok AND domain NOT IN (SELECT domain FROM verdicts WHERE row_idx IS NULL)
  UNION ALL SELECT * FROM verdicts WHERE row_idx IS NULL)"""


@query("qualify", f"""
WITH {_GIVEN}, {_MERGED.replace("FROM verdicts", "FROM given")}
SELECT row_idx, Company, Website, Country, Employees, Industry, fitment AS "Fitment", ranking AS "Ranking",
  comments AS "Comments", crawl_status AS "Crawl_Status", judge FROM merged""")
def _(spark, sf):
    log = V.domain_verdicts(fixture(spark, sf, "verdicts"))
    by_model = c("judge") == "model"
    all_leads = qualify(fixture(spark, sf, "leads"), "Website", Rubric(rules=RULES), fixture(spark, sf, "results"),
                        log.where(by_model), log.where(~by_model))
    return V.qualified(all_leads.withColumn("judge", c("_judge")))


@query("write_qualified", f"""
WITH {_MERGED} SELECT row_idx, Company, Website, Employees, fitment AS "Fitment", CAST(ranking AS VARCHAR) AS "Ranking",
  comments AS "Comments", crawl_status AS "Crawl_Status" FROM merged""")
def _(spark, sf):
    folder = scratch_folder(spark, "qualified")
    write_qualified(merged(spark, sf), folder)
    return read_leads(spark, folder).select("row_idx", "Company", "Website", "Employees", "Fitment", "Ranking",
                                            "Comments", "Crawl_Status")


@query("append_log", "SELECT domain, seq, fitment FROM decisions UNION ALL SELECT domain, seq, 'comment' FROM comments")
def _(spark, sf):
    folder, schema = scratch_folder(spark, "log"), "domain string, seq bigint, fitment string"
    append_log(fixture(spark, sf, "decisions").select("domain", "seq", "fitment"), folder)
    append_log(fixture(spark, sf, "comments").select("domain", "seq", F.lit("comment").alias("fitment")), folder)
    # Half-written lines do not count.
    table(spark, sf, "events").select(F.concat(F.lit('{"domain": "'), "user_id")).write.mode("append").text(folder)
    return read_log(spark, folder, schema)


@query("append_batches", "SELECT domain, seq, fitment FROM decisions UNION ALL SELECT domain, seq, 'comment' FROM comments")
def _(spark, sf):
    log = BatchLog(spark, scratch_folder(spark, "batches"), "domain string, seq bigint, fitment string")
    parts = [fixture(spark, sf, "decisions").select("domain", "seq", "fitment").where(F.pmod(F.xxhash64("domain"), F.lit(2)) == k)
             for k in (0, 1)]
    parts.append(fixture(spark, sf, "comments").select("domain", "seq", F.lit("comment").alias("fitment")))
    for k in (0, 1, 0, 2, 1):  # batches that come again add nothing
        log.append(parts[k], "judge", k)
        if k == 1:
            log.compact()
    return log.read()


_REASONS = "reasons AS (SELECT comments AS key, count(*) AS n FROM merged WHERE pre GROUP BY 1 ORDER BY n DESC, key LIMIT 8)"


@query("merge_report", f"""
WITH {_MERGED}, {_REASONS}, total AS (SELECT count(*) AS t FROM merged),
sections AS (
  SELECT 'fitment' AS section, fitment AS key, count(*) AS n FROM merged GROUP BY 2
  UNION ALL SELECT 'ranking', CAST(ranking AS VARCHAR), count(*) FROM merged GROUP BY 2
  UNION ALL SELECT 'tier', tier, count(*) FROM merged GROUP BY 2
  UNION ALL SELECT 'judge', judge, count(*) FROM merged GROUP BY 2
  UNION ALL SELECT 'reason', key, n FROM reasons
  UNION ALL SELECT 'rows', 'divergent', count(*) FROM merged WHERE (fitment = 'Good' AND ranking <> 1) OR (fitment = 'Unfit' AND ranking <> 3)
  UNION ALL SELECT 'rows', 'flagged', count(*) FROM merged WHERE flagged
  UNION ALL SELECT 'rows', 'disagree', count(*) FROM merged WHERE disagree
  UNION ALL SELECT 'rows', 'unassessed', count(*) FROM merged WHERE NOT assessed
  UNION ALL SELECT 'rows', 'bad', CAST(sum(CAST(bad_fitment AS INT) + CAST(bad_ranking AS INT)) AS BIGINT) FROM merged)
SELECT section, key, n, round(n * 100.0::DOUBLE / t, 6) AS pct FROM sections, total""")
def _(spark, sf):
    return R.merge_report(merged(spark, sf)).withColumn("pct", F.round("pct", 6))


_PAIRS = f"""man AS {S.latest(f"(SELECT * FROM verdicts WHERE row_idx IS NULL AND {_JUDGE} = 'manual')", 'domain')}, {_DEC},
  pairs AS (SELECT m.domain, array_to_string(list_transform(string_split(lower(coalesce(m.fitment, 'None')), ' '),
      lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') AS manual_fitment,
    coalesce(m.ranking, 'None') AS manual_ranking, m.comments, d.fitment AS model_fitment, CAST(d.ranking AS VARCHAR) AS model_ranking, d.why,
    p_good, d.note <> '' AS flagged FROM man m JOIN dec d USING (domain))"""


def pairs(spark, sf):
    return R.judged_by_both(fixture(spark, sf, "verdicts"), decisions(spark, sf))


@query("judged_by_both", f"WITH {_PAIRS} SELECT * FROM pairs")
def _(spark, sf):
    return pairs(spark, sf)


@query("agreement_matrix", f"""
WITH {_PAIRS}
SELECT manual_fitment AS manual, {", ".join(f"count(*) FILTER (model_fitment = '{g}') AS " + '"' + g + '"' for g in C.GRADES)},
  (SELECT count(*) FILTER (manual_fitment = model_fitment) / count(*) FROM pairs) AS agree_share
FROM pairs WHERE manual_fitment IN ({S.values(C.GRADES)}) GROUP BY 1""")
def _(spark, sf):
    return R.agreement_matrix(pairs(spark, sf), "manual_fitment", "model_fitment", C.GRADES)


@query("mean_probability_by_grade", f"""
WITH {_PAIRS} SELECT manual_fitment, count(*) AS n, round(avg(p_good), 9) AS mean_p_good FROM pairs
WHERE manual_fitment IN ({S.values(C.GRADES)}) GROUP BY 1""")
def _(spark, sf):
    return R.mean_probability_by_grade(pairs(spark, sf)).withColumn("mean_p_good", F.round("mean_p_good", 9))


@query("review_agreement", f"""
WITH {_PAIRS} SELECT count(*) FILTER (flagged) AS flagged,
  count(*) FILTER (flagged AND manual_fitment <> model_fitment) AS flagged_differing FROM pairs""")
def _(spark, sf):
    return R.review_agreement(pairs(spark, sf))


@query("disagreements", f"""
WITH {_PAIRS} SELECT domain, manual_fitment, manual_ranking, model_fitment, model_ranking FROM pairs
WHERE manual_fitment <> model_fitment OR manual_ranking <> model_ranking ORDER BY domain LIMIT 15""")
def _(spark, sf):
    return R.disagreements(pairs(spark, sf), 15).select(
        "domain", "manual_fitment", "manual_ranking", "model_fitment", "model_ranking")


_PROGRESS = f"""
WITH {_DEC}, {_DONE}
SELECT (SELECT count(*) FROM results) AS crawled, (SELECT count(*) FROM results WHERE gate_ok) AS passed,
  (SELECT count(*) FROM results WHERE NOT gate_ok) AS failed, (SELECT count(*) FROM done) AS assessed,
  (SELECT count(*) FROM results WHERE gate_ok AND domain NOT IN (SELECT domain FROM done)) AS pending,
  (SELECT count(*) FROM dec) AS decided, (SELECT count(*) FROM dec WHERE rubric_sha <> 'aaaa') AS stale"""


@query("progress", _PROGRESS)
def _(spark, sf):
    return R.progress(fixture(spark, sf, "results"), fixture(spark, sf, "verdicts"),
                      fixture(spark, sf, "decisions"), "aaaa")


@query("progress_from_changes", _PROGRESS)
def _(spark, sf):
    store = ProgressStore(spark, scratch_folder(spark, "counts"), buckets=8)
    sites, verdicts, decisions = (fixture(spark, sf, n) for n in ("results", "verdicts", "decisions"))

    def part(log, k):
        return log.where(F.pmod(F.xxhash64("domain", "seq"), F.lit(2)) == k)

    # Sites come with another outcome first, logs in two parts, the second batch twice.
    store.update(1, sites.withColumn("gate_ok", ~c("gate_ok")), part(verdicts, 1), part(decisions, 0))
    for _ in range(2):
        store.update(2, sites, part(verdicts, 0), part(decisions, 1))
    return store.report("aaaa")


@query("decision_report", f"""
WITH {_DEC}
SELECT count(*) AS decided, CAST(sum(input_tokens) AS BIGINT) AS tokens, round(sum(input_tokens) * 0.042 / 1e6, 9) AS usd,
  {", ".join(f"count(*) FILTER (fitment = '{g}') AS {g.lower()}" for g in C.GRADES)},
  {", ".join(f"count(*) FILTER (ranking = {r}) AS wave_{r}" for r in (1, 2, 3))},
  count(*) FILTER (note <> '') AS flagged FROM dec""")
def _(spark, sf):
    return R.decision_report(Sel.latest_by(decisions(spark, sf), "domain")).withColumn("usd", F.round("usd", 9))


@query("comment_sheet", f"""
WITH {_DEC}, {_SAID}, {_DONE}, {context_sql()},
begun AS (SELECT domain, min(coalesce(seq, -9223372036854775808)) AS first_seq FROM decisions GROUP BY domain),
open AS (SELECT dec.* FROM dec JOIN begun USING (domain)
  WHERE domain NOT IN (SELECT domain FROM comments) AND domain NOT IN (SELECT domain FROM done)
  ORDER BY first_seq, domain LIMIT 25)
SELECT o.domain, o.seq, fitment || ' / ' || ranking AS verdict, why, '' AS disqualifier, 'text of ' || found_fit AS fit,
  '' AS anti_fit, 'text of ' || found_mom AS momentum, note AS review, r.source_tier, r.chars, r.digest, x.context
FROM open o LEFT JOIN results r USING (domain) LEFT JOIN contexts x USING (domain)""")
def _(spark, sf):
    return R.comment_sheet(decisions(spark, sf), fixture(spark, sf, "comments"), fixture(spark, sf, "results"),
                           fixture(spark, sf, "verdicts"), fixture(spark, sf, "leads"), "Website")
