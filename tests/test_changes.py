"""Batches that count once, counts that follow changes, profiles that merge, values that occur most often."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from leadsieve.operators import profile as P, reports as R, selection as Sel
from leadsieve.plans.campaign import crawl_planned, fetch_plan
from leadsieve.plans.progress import ProgressStore
from leadsieve.sources.commits import BatchLog, Taken, put_once
from leadsieve.sources.store import SiteStore

LOG = "domain string, n bigint"


def rows(spark, *made, schema=LOG):
    return spark.createDataFrame(list(made), schema)


def read(log):
    return sorted(tuple(r) for r in log.read().collect())


# --- logs -------------------------------------------------------------------------

def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), LOG)
    assert read(log) == [] and not log.holds("r/1", 0)
    first = rows(spark, ("a", 1), ("a", 1), (None, None)).withColumn("more", F.lit(1))
    assert log.append(first, "r/1", 0) and not log.append(first, "r/1", 0)
    assert log.append(rows(spark, ("b", 2)), "r/1", 1) and log.append(rows(spark, ("b", 2)), "r", 1)
    assert log.append(rows(spark), "empty") and log.holds("empty", 0)
    got = log.read()
    assert got.columns == ["domain", "n"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows(
        spark, ("a", 1), ("a", 1), (None, None), ("b", 2), ("b", 2)).collect()))
    with pytest.raises(ValueError):
        log.append(first, "")


def test_rows_of_a_failed_task_are_never_read(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), LOG)
    log.append(rows(spark, ("a", 1)), "r", 0)
    many = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("domain"), F.col("id").alias("n"))
    broken = many.withColumn("n", F.when(F.col("n") == 399, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("n")))
    with pytest.raises(Exception):
        log.append(broken, "r", 1)
    assert read(log) == [("a", 1)] and not log.holds("r", 1)
    # A run that wrote its rows and was lost before its commit.
    many.write.parquet(str(tmp_path / "log" / "parts" / "orphan"))
    assert read(log) == [("a", 1)]
    assert log.append(many, "r", 1) and len(read(log)) == 401
    log.vacuum()
    assert len(read(log)) == 401 and not os.path.exists(tmp_path / "log" / "parts" / "orphan")


def test_of_two_commits_of_one_batch_one_counts(spark, tmp_path, monkeypatch):
    log = BatchLog(spark, str(tmp_path / "log"), LOG)
    with monkeypatch.context() as m:
        m.setattr(BatchLog, "holds", lambda *_: False)  # both looked before either had committed
        assert log.append(rows(spark, ("first", 1)), "r", 0)
        assert not log.append(rows(spark, ("second", 2)), "r", 0)
    assert read(log) == [("first", 1)] and len(glob.glob(f"{tmp_path}/log/parts/*")) == 1
    put_once(spark, f"{tmp_path}/x", "one")
    with pytest.raises(Taken):
        put_once(spark, f"{tmp_path}/x", "two")
    assert open(tmp_path / "x").read() == "one" and len(glob.glob(f"{tmp_path}/.*")) <= 1  # a checksum at most


def test_batches_merge_and_stay_known(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path / "log"), LOG)
    for k in range(3):
        log.append(rows(spark, (f"d{k}", k)), "r", k)
    assert sorted(tuple(r) for r in log.read_batches("r", after=0).collect()) == [("d1", 1), ("d2", 2)]
    assert log.compact() and not log.compact()
    assert not log.append(rows(spark, ("d0", 0)), "r", 0)
    log.append(rows(spark, ("d3", 3)), "r", 3)
    assert read(log) == [(f"d{k}", k) for k in range(4)] and log.compact()
    log.vacuum()
    assert read(log) == [(f"d{k}", k) for k in range(4)] and len(glob.glob(f"{tmp_path}/log/parts/*")) == 1
    assert log.holds("r", 2) and log.read_batches("r", after=3).isEmpty()
    with pytest.raises(ValueError):
        log.read_batches("r", after=1)


def test_a_replayed_streaming_batch_adds_nothing(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "state")
    log = BatchLog(spark, str(tmp_path / "log"), LOG)

    def run():
        log.append_stream(spark.readStream.schema(LOG).parquet(source), "intake", checkpoint).awaitTermination()

    rows(spark, ("a", 1)).write.mode("append").parquet(source)
    run()
    rows(spark, ("b", 2)).write.mode("append").parquet(source)
    run()
    for name in glob.glob(f"{checkpoint}/commits/1") + glob.glob(f"{checkpoint}/commits/.1.crc"):
        os.remove(name)  # the driver was lost after the batch was written, before the stream knew
    run()
    assert read(log) == [("a", 1), ("b", 2)]


# --- counts -----------------------------------------------------------------------

SITES, VERDICTS = "domain string, gate_ok boolean", "row_idx bigint, domain string"
DECISIONS = "domain string, seq bigint, rubric_sha string"


def test_counts_follow_random_changes(spark, tmp_path):
    pick = random.Random(5)
    counts = ProgressStore(spark, str(tmp_path / "counts"), buckets=4)
    sites, verdicts, decisions = {}, [], []
    for batch in range(1, 5):
        name = lambda: f"d{pick.randrange(30)}.com"
        new_sites = {name(): pick.random() < 0.6 for _ in range(8)}
        new_verdicts = [(None if pick.random() < 0.7 else 3, name()) for _ in range(5)] + [(None, ""), (None, None)]
        new_decisions = [(name(), batch * 100 + k, pick.choice(["aaaa", "bbbb", None])) for k in range(6)]
        new_decisions += [(f"late{batch}.com", None, "bbbb"), ("", 5, "aaaa"), (None, 6, "aaaa")]
        if batch == 4:  # older ones come late
            new_decisions += [("d1.com", 1, "old"), ("late1.com", 2, "aaaa")]
        sites |= new_sites
        verdicts += new_verdicts
        decisions += new_decisions
        given = (rows(spark, *new_sites.items(), schema=SITES), rows(spark, *new_verdicts, schema=VERDICTS),
                 rows(spark, *new_decisions, schema=DECISIONS))
        assert counts.update(batch, *given)
        assert not counts.update(batch, *given)
        whole = R.progress(rows(spark, *sites.items(), schema=SITES), rows(spark, *verdicts, schema=VERDICTS),
                           rows(spark, *decisions, schema=DECISIONS), "aaaa").first()
        assert counts.report("aaaa").first().asDict() == whole.asDict()
    assert counts.store.read().count() == len({d for d in [*sites, *[v[1] for v in verdicts if v[0] is None],
                                                           *[d[0] for d in decisions]] if d})


def test_an_update_lost_before_its_commit_changes_no_count(spark, tmp_path, monkeypatch):
    counts = ProgressStore(spark, str(tmp_path / "counts"), buckets=2)
    assert counts.report("a").first().crawled == 0 and not counts.update(1)
    counts.update(1, rows(spark, ("a.com", True), schema=SITES))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SiteStore, "_commit", lost)
        with pytest.raises(RuntimeError):
            counts.update(2, rows(spark, ("a.com", False), ("b.com", True), schema=SITES))
    assert counts.report("a").first().asDict()["passed"] == 1 and counts.report("a").first().failed == 0
    counts.update(2, rows(spark, ("a.com", False), ("b.com", True), schema=SITES))
    got = counts.report("a").first()
    assert (got.crawled, got.passed, got.failed, got.pending) == (2, 1, 1, 1)


def test_counts_worked_out_from_an_old_version_are_not_committed(spark, tmp_path):
    store = SiteStore(spark, str(tmp_path / "sites"), buckets=2)
    made = lambda d: rows(spark, (d, 1), schema="domain string, version bigint")
    store.upsert(made("a.com"), notes={"x": 1, "y": 1}, onto=0)
    store.upsert(made("b.com"), notes={"x": 2})
    with pytest.raises(Taken):
        store.upsert(made("c.com"), notes={"x": 9}, onto=1)
    assert store.manifest()["notes"] == {"x": 2, "y": 1} and store.read().count() == 2


# --- profiles ---------------------------------------------------------------------

LEADS = "row_idx bigint, Company string, Website string, Country string, Notes string"


def leads(spark, n=90):
    web = ["https://a{}.com/", "www.b{}.com", " ", None, "no host", "a{}.com", "n/a"]
    made = [(k, f" c{k} " if k % 3 else None, web[k % 7] and web[k % 7].format(k % 10), ["US", "DE", "", "FR", "US"][k % 5], "")
            for k in range(n)]
    return rows(spark, *made, schema=LEADS)


@pytest.mark.parametrize("cuts", [[0, 90], [0, 40, 90], [0, 1, 1, 2, 90]])
def test_facts_of_parts_are_those_of_the_whole(spark, cuts):
    whole, facts = leads(spark), None
    for part, (begin, end) in reversed(list(enumerate(zip(cuts, cuts[1:])))):
        mine = whole.where(F.col("row_idx").between(begin, end - 1)).withColumn("row_idx", F.col("row_idx") - begin)
        one = P.profile_facts(mine, "Website", part)
        facts = one if facts is None else facts.unionAll(one)
    known = lambda df: sorted(map(str, df.collect()))
    want = P.profile_columns(whole)
    assert known(P.merged_profile(facts).select(*want.columns)) == known(want)
    assert P.merged_url_health(facts).first() == P.url_health(whole, "Website").first()


def test_the_profile_of_an_empty_table(spark):
    none = leads(spark).limit(0)
    facts = P.profile_facts(none, "Website")
    got = {r.column: (r.filled_pct, r.samples, r.n_distinct) for r in P.merged_profile(facts).collect()}
    assert got == {c: (0, None, None) for c in ("Company", "Website", "Country", "Notes")}
    assert P.merged_url_health(facts).first() == P.url_health(none, "Website").first()


def test_the_rows_behind_the_counts(spark):
    table = leads(spark, 20)
    health = P.url_health(table, "Website").first()
    bad, again = P.unparseable_cells(table, "Website").collect(), P.repeated_domains(table, "Website").collect()
    assert len(bad) == health.unparseable and {(r.row_idx, r.line, r.value) for r in bad} >= {(4, 6, "no host"), (6, 8, "n/a")}
    assert len(again) == health.duplicate_domains and sum(r.n for r in again) == health.duplicate_rows


# --- values -----------------------------------------------------------------------

def test_frequent_values_equal_the_full_count(spark):
    few = F.concat(F.lit("v"), (F.col("id") % 7).cast("string"))
    many = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, few).when(F.col("id") % 9 == 0, F.lit(None))
                                      .otherwise(F.col("id").cast("string")).alias("v"))
    for k, tracked in ((8, 200), (8, 8), (30, 200), (3, 4000)):  # some of these can't be proved and count all
        assert Sel.frequent(many, "v", k, tracked).collect() == Sel.top_k(many, "v", k).collect()
    flat = spark.range(500).select(F.col("id").cast("string").alias("v"))
    assert Sel.frequent(flat, "v", 5, 50).collect() == Sel.top_k(flat, "v", 5).collect()
    assert Sel.frequent(flat.limit(0), "v", 5).collect() == []


# --- plans ------------------------------------------------------------------------

def test_a_planned_crawl_serves_what_is_stored_and_stores_what_is_fetched(spark, tmp_path):
    store = SiteStore(spark, str(tmp_path / "sites"), buckets=4)
    wanted = rows(spark, ("a.com", 0), ("b.com", 1), ("c.com", 2), schema="domain string, first_row bigint")
    letters = "abcdefghij"
    text = " ".join(f"<p>Our {a}mill{b}er works with {b}loom{a}ing parts.</p>" for a in letters for b in letters)
    html = f"<html><head><title>Company of machines</title></head><body><h1>We build machines</h1>{text}</body></html>"
    pages = spark.createDataFrame([(k, f"https://{d}/{p}", html) for k, (d, p) in enumerate(
        [("a.com", ""), ("a.com", "about"), ("b.com", ""), ("b.com", "about"), ("x.com", "")])],
        "page_id bigint, url string, html string")
    nothing = rows(spark, schema="domain string, gate_ok boolean")
    got = crawl_planned(store, fetch_plan(wanted, nothing), pages, 1).collect()
    assert {r.domain: r.gate_ok for r in got} == {"a.com": True, "b.com": True, "c.com": False}
    # Only the failed one is tried again, and fails again; the others are served.
    plan = fetch_plan(wanted, store.read(), "escalate", paid=True)
    assert {r.domain: r.action for r in plan.collect()} == {"a.com": "serve", "b.com": "serve", "c.com": "fetch"}
    got = crawl_planned(store, plan, pages, 2).collect()
    assert {r.domain: r.version for r in got} == {"a.com": 1, "b.com": 1, "c.com": 2}
    assert {r.domain: r.version for r in store.read().collect()} == {"a.com": 1, "b.com": 1, "c.com": 2}
    # A refresh of at most one domain defers the others.
    plan = {r.domain: r.action for r in fetch_plan(wanted, store.read(), "refresh", paid=True, most=1).collect()}
    assert plan == {"a.com": "fetch", "b.com": "defer", "c.com": "defer"}
