"""Questions, the decision table, verdict logs and the whole round trip."""

import json

import pytest
from pyspark.sql import functions as F

from leadsieve import constants as C
from leadsieve.operators import decide as J, reports as R, sites as Sites, verdicts as V
from leadsieve.operators.selection import pending
from leadsieve.plans.campaign import decide_new, judge, qualify, requested_domains
from leadsieve.sources.rubric import load_rubric, parse_rubric, rubric_sha, rubric_tables

c = F.col
RUBRIC = {
    "offering_summary": "Crane software for \"inland\" ports",
    "disqualifiers": [
        {"id": "geo", "rule": "Outside Europe", "checkable_from": "csv", "column": "Country", "accept_values": ["France", "Spain"]},
        {"id": "rival", "rule": "Sells crane software itself", "checkable_from": "crawl", "evidence": "product page for cranes"},
        {"rule": "no id", "checkable_from": "crawl"}],
    "fit_signals": [{"id": "port", "signal": "Runs a port", "weight": "strong"}, {"id": "paper", "signal": "Paper permits", "weight": "moderate"},
                    {"id": "empty", "signal": ""}],
    "antifit_signals": [{"id": "agency", "signal": "Design agency", "weight": "strong"}, {"id": "metal", "signal": "Only metal parts", "weight": "moderate"}],
    "momentum_signals": [{"id": "hiring", "signal": "Hires engineers", "weight": "strong"}, {"id": "names", "signal": "Names large clients", "weight": "moderate"}],
    "tier_definitions": {"Good": "Port operator", "Avg": "Other logistics"},
}
PARSED = parse_rubric(RUBRIC)
GOOD = {"Good": 0.8, "Avg": 0.15, "Unfit": 0.05}
AVG = {"Good": 0.1, "Avg": 0.8, "Unfit": 0.1}
# name: answers, probabilities, confidence, choice -> fitment, ranking, needs review
TABLE = {
    "disqualified": ({"dq__rival": .9, "mom__hiring": .9}, GOOD, .8, None, "Unfit", 3, []),
    "below_bar": ({"dq__rival": .6, "fit__port": .9}, GOOD, .8, None, "Good", 2, []),
    "good_momentum": ({"fit__port": .9, "mom__names": .7}, GOOD, .8, None, "Good", 1, []),
    "good_calm": ({"fit__port": .9}, GOOD, .8, None, "Good", 2, []),
    "at_threshold": ({"fit__port": .5, "mom__names": .5}, GOOD, .5, None, "Good", 1, []),
    "avg_strong": ({"mom__hiring": .8}, AVG, .8, None, "Avg", 2, []),
    "avg_moderate": ({"mom__names": .8}, AVG, .8, None, "Avg", 3, []),
    "torn": ({"fit__port": .9}, {"Good": .45, "Avg": .40, "Unfit": .15}, .8, None, "Avg", 3, []),
    "clear": ({"fit__port": .9}, {"Good": .6, "Avg": .3, "Unfit": .1}, .8, None, "Good", 2, []),
    "torn_low": ({}, {"Good": .1, "Avg": .46, "Unfit": .44}, .8, None, "Unfit", 3, []),
    "strong_anti": ({"fit__port": .9, "anti__agency": .8, "mom__hiring": .9}, GOOD, .8, None, "Unfit", 3, []),
    "moderate_anti": ({"fit__port": .9, "anti__metal": .8}, GOOD, .8, None, "Good", 2, []),
    "unsure": ({"fit__port": .9}, GOOD, .3, None, "Good", 2, ["low fitment confidence 0.30"]),
    "no_signal": ({}, GOOD, .8, None, "Good", 2, ["Good with no fit signal found on the site"]),
    "odd_choice": ({"fit__port": .9}, GOOD, .8, "perhaps", "Good", 2, []),
    "all_equal": ({"fit__port": .9}, {"Good": .3, "Avg": .3, "Unfit": .3}, .8, "perhaps", "Avg", 3, []),
    "no_grades": ({}, {}, None, "Unfit", "Unfit", 3, ["low fitment confidence 0.00"]),
}


def answers_of(spark, table, skip=()):
    rows = [(name, s.qid, float(given.get(s.qid, .05)), 1) for name, (given, *_) in table.items()
            for s in PARSED.signals if (name, s.qid) not in skip]
    return spark.createDataFrame(rows, "domain string, qid string, noul double, seq bigint")


def grades_of(spark, table):
    rows = [(name, choice or max(p, key=p.get), *(p.get(g) for g in C.GRADES), confidence)
            for name, (_, p, confidence, choice, *_) in table.items()]
    return spark.createDataFrame(rows, "domain string, choice string, p_good double, p_avg double, p_unfit double, confidence double")


def test_latest_grade_and_last_signal_count(spark):
    graded = {"x": ({"fit__port": .9}, AVG, .8, None)}
    again = {"x": ({}, GOOD, .8, None)}
    grades = grades_of(spark, graded).withColumn("seq", F.lit(1)).unionByName(
        grades_of(spark, again).withColumn("seq", F.lit(2)))
    signals = [*PARSED.signals, J.Signal("fit", "port", "Owns a port", "moderate")]
    rows = J.decide(answers_of(spark, graded), grades, signals).collect()
    assert [(r.domain, r.fitment) for r in rows] == [("x", "Good")]
    assert [s.text for s in rows[0].signals_present] == ["Owns a port"]


def test_decision_table(spark):
    got = {r.domain: r for r in J.decide(answers_of(spark, TABLE), grades_of(spark, TABLE), PARSED.signals).collect()}
    for name, (*_, fitment, ranking, review) in TABLE.items():
        r = got[name]
        assert (r.fitment, r.ranking, r.needs_review) == (fitment, ranking, review), name
    assert got["disqualified"].disqualified_by == "rival" and got["disqualified"].why == "disqualified by rival"
    assert got["torn"].why == "fitment Good p=0.45; torn with Avg p=0.40, took the lower grade; no momentum signal"
    assert got["strong_anti"].why == "fitment Good p=0.80; strong anti-fit agency"
    assert got["good_momentum"].why == "fitment Good p=0.80; momentum names"
    assert {(s.kind, s.id) for s in got["good_momentum"].signals_present} == {("fit", "port"), ("momentum", "names")}
    assert len(got["torn"].signals) == len(PARSED.signals)


def test_missing_answer_stays_pending(spark):
    skip = {("torn", "mom__hiring")}
    got = J.decide(answers_of(spark, TABLE, skip), grades_of(spark, TABLE), PARSED.signals)
    assert {r.domain for r in got.collect()} == set(TABLE) - {"torn"}


def test_latest_answer_counts(spark):
    again = spark.createDataFrame([("good_calm", "dq__rival", .99, 5), ("good_calm", "dq__rival", .01, 3)],
                                  "domain string, qid string, noul double, seq bigint")
    got = J.decide(answers_of(spark, TABLE).unionAll(again), grades_of(spark, TABLE), PARSED.signals)
    assert got.where("domain = 'good_calm'").first().fitment == "Unfit"


def test_one_shuffle_of_answers(spark):
    plan = J.answers_wide(answers_of(spark, TABLE), PARSED.signals)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" in plan and "SortAggregate" not in plan


def test_questions(spark):
    got = {r.qid: r for r in J.build_questions(*rubric_tables(spark, PARSED, "k")).collect()}
    assert set(got) == {"dq__rival", "fit__port", "fit__paper", "anti__agency", "anti__metal",
                        "mom__hiring", "mom__names", "fitment"}
    assert "product page for cranes" in json.loads(got["dq__rival"].criteria)["true"]
    assert all("`website`" in r.instructions for r in got.values())
    grade = json.loads(got["fitment"].criteria)
    assert list(grade) == C.GRADES and grade["Good"] == {"definition": "Port operator", "look_for": ["Runs a port"]}
    assert grade["Unfit"]["definition"] == C.DEFAULT_TIERS["Unfit"] and grade["Unfit"]["look_for"] == ["Design agency", "Only metal parts"]
    assert json.loads(got["fitment"].instructions)["what_we_sell"] == RUBRIC["offering_summary"]

    def whole(r):
        text = r.instructions if r.type == "noul" else json.loads(r.instructions)
        return {"type": r.type, "instructions": text, "criteria": json.loads(r.criteria)}

    full = json.dumps({q: whole(r) for q, r in got.items()}, ensure_ascii=False)
    total = J.questions_chars(J.build_questions(*rubric_tables(spark, PARSED, "k"))).first()
    assert total.question_chars == len(full)


def test_bare_rubric_uses_defaults(spark):
    bare = parse_rubric({"fit_signals": [{"id": "m", "signal": "Moderate only", "weight": "moderate"}]})
    (row,) = J.build_questions(*rubric_tables(spark, bare)).where("qid = 'fitment'").collect()
    grade = json.loads(row.criteria)
    assert "look_for" not in grade["Unfit"] and grade["Avg"]["definition"] == C.DEFAULT_TIERS["Avg"]
    assert grade["Good"]["look_for"] == ["Moderate only"] and "what_we_sell" not in row.instructions
    full = json.dumps({"fitment": {"type": "choice", "instructions": json.loads(row.instructions), "criteria": grade}})
    assert row.chars == len(full) - 2


def test_states_and_tokens(spark):
    cases = [("DOMAIN: a\nHOME: \"x\"\t\\ é", "Company=A"), ("x", ""), ("", None), (None, "c")]
    df = spark.createDataFrame(cases, "d string, x string")
    got = df.select(J.build_state(c("d"), c("x")).alias("s"), J.estimate_tokens(c("d"), c("x"), F.lit(101)).alias("t")).collect()
    for (d, x), r in zip(cases, got):
        state = {"website": d or ""} | ({"lead_record": x} if x else {})
        assert json.loads(r.s) == state
        assert r.t == (len(json.dumps(state, ensure_ascii=False)) + 101) // 4


def test_budget(spark):
    df = spark.createDataFrame([(10.0, 20.0), (16.0, 20.0), (15.0, 20.0), (None, 20.0), (3.0, 0.0), (3.0, None)], "u double, l double")
    assert [r.ok for r in df.select(J.budget_headroom(c("u"), c("l")).alias("ok")).collect()] == [True, False, False, True, True, True]
    flags = J.spend_guard(df, c("u")).select("allowed").collect()
    assert [r.allowed for r in flags] == [False, False, False, None, True, True]


def test_rubric_file(spark, tmp_path):
    (tmp_path / "rubric.json").write_text(json.dumps(RUBRIC))
    rubric = load_rubric(spark, str(tmp_path / "rubric.json"))
    assert [r.id for r in rubric.rules] == ["geo"] and len(rubric.signals) == 7
    assert rubric.sha == rubric_sha(dict(reversed(RUBRIC.items()))) and rubric.sha != rubric_sha({})


ATTEMPT = "domain string, tier string, gate_ok boolean, chars bigint, seq bigint, status string"


def test_cascade(spark):
    tiers = ["a", "b", "c"]
    rows = [(f"d{i}.com", t, (t == tiers[i % 3]), 10 * i + j, 3 * i + j, "thin")
            for i in range(30) for j, t in enumerate(tiers) if j <= i % 3]
    rows += [("dead.com", "b", False, 5, 900, "thin"), ("dead.com", "a", False, 9, 901, "timeout"), ("dead.com", "c", False, 9, 902, "thin"),
             ("both.com", "c", True, 5, 903, "ok"), ("both.com", "b", True, 1, 904, "ok")]
    attempts = spark.createDataFrame(rows, ATTEMPT)
    wanted = spark.createDataFrame([(d,) for d in {r[0] for r in rows} | {"never.com"}], "domain string")
    got = {r.domain: r for r in Sites.resolve_cascade(attempts, tiers, wanted).collect()}
    assert len(got) == 33 and all(got[f"d{i}.com"].gate_ok for i in range(30))
    assert (got["dead.com"].tier, got["dead.com"].seq) == ("a", 901) and got["both.com"].tier == "b"
    assert (got["never.com"].status, got["never.com"].error) == ("no_url", "no tiers ran")
    left = {r.domain: r for r in Sites.untried_tiers(wanted, attempts, tiers).collect()}
    assert left["d0.com"].untried == ["b", "c"] and left["dead.com"].exhausted and left["never.com"].untried == tiers
    assert {r.domain for r in Sites.unattempted(wanted, attempts, "a").collect()} == {"never.com", "both.com"}
    stored = Sites.resolve_cascade(attempts, tiers)
    for mode, actions in {"first": ("serve", "serve", "fetch"), "escalate": ("serve", "fetch", "skip"), "refresh": ("fetch",) * 3}.items():
        plan = {r.domain: r.action for r in Sites.plan_fetches(wanted, stored, mode).collect()}
        assert (plan["d0.com"], plan["dead.com"], plan["never.com"]) == actions


VERDICT = "row_idx bigint, domain string, fitment string, ranking string, comments string, crawl_status string, source_tier string, judge string, seq bigint"


def test_merge_precedence_and_headers(spark):
    leads = spark.createDataFrame([(0, "a.com", "x"), (1, "a.com", "y"), (2, "b.com", ""), (3, "", "z"), (4, "n/a", "w")],
                                  "row_idx bigint, Website string, Fitment string")
    verdicts = spark.createDataFrame([
        (0, "a.com", "Unfit", "3", "row rule", "not_crawled", "prefilter", None, 1),
        (None, "a.com", "gOOD", "0", "old", "", "plain", "model", 2),
        (None, "a.com", "good", "1", " new " + "y" * 200, "", "plain", "", 3)], VERDICT)
    results = spark.createDataFrame([("a.com", "ok", 1), ("b.com", "timeout", 1), ("", "x", 1)], "domain string, status string, seq bigint")
    merged = V.merge_verdicts(leads, verdicts, results, "Website")
    rows = V.qualified(merged).orderBy("row_idx").collect()
    assert merged.columns[:7] == ["row_idx", "Website", "Fitment", "Fitment_2", "Ranking", "Comments", "Crawl_Status"]
    assert [r.Fitment for r in rows] == ["x", "y", "", "z", "w"]
    assert [(r.Fitment_2, r.Ranking, r.Comments[:8], r.Crawl_Status) for r in rows] == [
        ("Unfit", 3, "row rule", "not_crawled"), ("Good", 1, "new yyyy", "ok"), ("Unfit", 3, "Not asse", "timeout"),
        ("Unfit", 3, "Not asse", "not_crawled"), ("Unfit", 3, "Not asse", "not_crawled")]
    assert len(rows[1].Comments) == 120
    report = {(r.section, r.key): r.n for r in R.merge_report(merged).collect()}
    assert report["rows", "unassessed"] == 3 and report["judge", "rule"] == 1 and report["judge", "manual"] == 1
    assert report["reason", "row rule"] == 1 and report["fitment", "Good"] == 1
    assert "Crawl_Status" not in V.merge_verdicts(leads, verdicts, results, "Website", status=False).columns


def test_unique_header():
    assert V.unique_header("A", ["B"]) == "A" and V.unique_header("A", ["A", "A_2"]) == "A_3"


@pytest.mark.parametrize("given, want", [
    (("good", "1"), ("Good", 1, False, False)), ((" AVG ", " 2 "), ("Avg", 2, False, False)),
    (("best", "7"), ("Unfit", 3, True, True)), ((None, None), ("Unfit", 3, False, False)),
    (("", "0"), ("Unfit", 3, False, False)), (("Unfit", "high"), ("Unfit", 3, False, False)), (("  ", "-1"), ("Unfit", 3, True, True))])
def test_coercion(spark, given, want):
    df = spark.createDataFrame([(*given, "c")], "fitment string, ranking string, comments string")
    r = V.coerce_verdict(df).first()
    assert (r.fitment, r.ranking, r.bad_fitment, r.bad_ranking) == want


def test_row_verdicts_do_not_close_a_domain(spark):
    """One disqualified row must not keep the other rows of its domain from being judged."""
    verdicts = spark.createDataFrame([(0, "a.com", "Unfit", "3", "c", "", "prefilter", "rule", 1)], VERDICT)
    results = spark.createDataFrame([("a.com", False, "thin:3_chars", "plain", "thin")],
                                    "domain string, gate_ok boolean, gate_reason string, source_tier string, status string")
    assert V.resolve_failed(results, verdicts).count() == 1
    assert pending(results, V.domain_verdicts(verdicts)).count() == 1


def test_round_trip(spark):
    leads = spark.createDataFrame([(0, "Acme", "acme.com", "France"), (1, "Brandly", "brandly.com", "Spain"),
                                   (2, "Gone", "gone.com", "Spain"), (3, "Far", "far.com", "Peru"), (4, "Acme again", "www.acme.com", "France")],
                                  "row_idx bigint, Company string, Website string, Country string")
    results = spark.createDataFrame(
        [(d, ok, "ok" if ok else "dns_fail", "pass" if ok else "status:dns_fail", "plain") for d, ok in
         (("acme.com", True), ("brandly.com", True), ("gone.com", False))],
        "domain string, gate_ok boolean, status string, gate_reason string, source_tier string")
    table = {"acme.com": ({"fit__port": .9, "mom__hiring": .85}, GOOD, .8, None),
             "brandly.com": ({"anti__agency": .9}, GOOD, .8, None), "gone.com": ({}, GOOD, .8, None)}
    comments = "domain string, comments string, evidence string, disagree boolean, seq bigint, fitment string"
    first = spark.createDataFrame([("acme.com", " Runs a port ", "HOME", None, 1, "Unfit")], comments)
    args = answers_of(spark, table), grades_of(spark, table)
    assert [r.domain for r in judge(results, *args, first, PARSED).collect()] == ["acme.com"]
    more = first.unionAll(spark.createDataFrame([("brandly.com", "Studio", None, True, 1, None)], comments))
    models = judge(results, *args, more, PARSED)
    by_domain = {r.domain: r for r in models.collect()}
    assert (by_domain["acme.com"].fitment, by_domain["acme.com"].ranking, by_domain["acme.com"].comments) == ("Good", "1", "Runs a port")
    assert by_domain["brandly.com"].disagree and by_domain["brandly.com"].judge == "model"
    merged = qualify(leads, "Website", PARSED, results, models)
    rows = V.qualified(merged).orderBy("row_idx").collect()
    assert [(r.Fitment, r.Ranking, r.Comments) for r in rows] == [
        ("Good", 1, "Runs a port"), ("Unfit", 3, "Studio"), ("Unfit", 3, "Domain does not resolve - not verified"),
        ("Unfit", 3, "Country = Peru (not in target list)"), ("Unfit", 3, "Not assessed")]
    report = {(r.section, r.key): r.n for r in R.merge_report(merged).collect()}
    assert report["judge", "model"] == 2 and report["judge", "rule"] == 2 and report["rows", "disagree"] == 1


def test_stored_decisions_and_manual_verdicts(spark, tmp_path):
    results = spark.createDataFrame([(d, True, "ok", "pass", "plain") for d in ("acme.com", "brandly.com")],
                                    "domain string, gate_ok boolean, status string, gate_reason string, source_tier string")
    table = {d: ({"fit__port": .9, "mom__hiring": .85}, GOOD, .8, None) for d in ("acme.com", "brandly.com")}
    args = answers_of(spark, table), grades_of(spark, table)
    manual = spark.createDataFrame([("acme.com", "Avg", "2", "By hand", "ok", "plain", "", 5)],
                                   "domain string, fitment string, ranking string, comments string, crawl_status string, "
                                   "source_tier string, judge string, seq bigint").withColumn("row_idx", F.lit(None).cast("bigint"))
    first = decide_new(results, *args, PARSED, verdicts=manual, model="m-1")
    first.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    assert [(r.domain, r.seq, r.model, r.rubric_sha) for r in log.collect()] == [("brandly.com", 1, "m-1", PARSED.sha)]
    assert decide_new(results, *args, PARSED, log, manual).count() == 0
    again = decide_new(results, *args, PARSED, log, manual, rejudge=True)
    assert [(r.domain, r.seq) for r in again.collect()] == [("acme.com", 2)]
    comments = spark.createDataFrame([("brandly.com", "Studio", "", None, 1, None)],
                                     "domain string, comments string, evidence string, disagree boolean, seq bigint, fitment string")
    models = judge(results, *args, comments, PARSED, log, manual)
    leads = spark.createDataFrame([(0, "acme.com", "France"), (1, "brandly.com", "France"), (2, "far.com", "Peru")],
                                  "row_idx bigint, Website string, Country string")
    rows = qualify(leads, "Website", PARSED, results, models, manual).orderBy("row_idx").collect()
    assert [(r.Fitment, r.Comments, r["_judge"]) for r in rows[:2]] == [("Avg", "By hand", "manual"), ("Good", "Studio", "model")]
    assert rows[2].Comments.startswith("Country = Peru")
    assert {r.domain for r in requested_domains(leads, "Website", PARSED).collect()} == {"acme.com", "brandly.com"}


def test_decisions_are_not_repeated(spark):
    sites = spark.createDataFrame([(n, True) for n in TABLE], "domain string, gate_ok boolean")
    args = answers_of(spark, TABLE), grades_of(spark, TABLE)
    none = sites.limit(0)
    first = J.incremental_decide(sites, *args, none, PARSED.signals)
    assert first.count() == len(TABLE)
    assert J.incremental_decide(sites, *args, first, PARSED.signals).count() == 0
