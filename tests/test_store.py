"""Sites in place, page choice, positions and joins that follow what changes."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from leadsieve.operators import selection as Sel, sites as Sites, verdicts as V
from leadsieve.plans.campaign import crawl_results
from leadsieve.sources.pages import ingest_first_pages
from leadsieve.sources.store import SiteStore
from leadsieve.streaming.incremental import current_sites, incremental_pages


def rows(spark, *made):
    return spark.createDataFrame(list(made), "domain string, status string, version bigint")


def files(root):
    return set(glob.glob(f"{root}/data/*/bucket=*/*.parquet"))


def test_an_update_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "sites")
    store = SiteStore(spark, root, buckets=8)
    assert store.upsert(rows(spark, *[(f"d{k}.com", "old", 1) for k in range(200)])) == 1
    before = files(root)
    new = rows(spark, ("d7.com", "new", 2), ("d7.com", "older", 1), ("d9.com", "stale", 0), ("x.com", "none", None), ("", "-", 9))
    touched = store.touched(new.where("domain <> ''"))
    assert store.upsert(new) == 2 and 0 < len(touched) < 8
    added = files(root) - before
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in added} == set(touched) and len(added) == len(touched)
    got = {r.domain: (r.status, r.version) for r in store.read().collect()}
    assert got == {f"d{k}.com": ("old", 1) for k in range(200)} | {"d7.com": ("new", 2), "x.com": ("none", None)}
    assert {r.status for r in store.read(version=1).collect()} == {"old"}
    store.vacuum()
    assert store.versions() == [2] and before - files(root) and store.read().count() == 201


def test_a_lost_run_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = SiteStore(spark, str(tmp_path / "sites"), buckets=4)
    store.upsert(rows(spark, ("a.com", "old", 1)))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(SiteStore, "_commit", lost)
        with pytest.raises(RuntimeError):
            store.upsert(rows(spark, ("a.com", "new", 2)))
    assert [r.status for r in store.read().collect()] == ["old"]
    with pytest.raises(Exception):
        store._commit(1, {})  # a committed version is not replaced
    store.upsert(rows(spark, ("a.com", "new", 2)))
    assert [r.status for r in store.read().collect()] == ["new"]
    assert [r.domain for r in store.lookup(rows(spark, ("a.com", "", 0), ("b.com", "", 0))).collect()] == ["a.com"]


def test_stored_text_is_not_aggregated(spark, tmp_path):
    store = SiteStore(spark, str(tmp_path / "sites"), buckets=2)
    store.upsert(rows(spark, ("a.com", "old", 1)))
    log = spark.read.parquet(*[os.path.dirname(f) for f in files(store.root)])
    plan = Sel.latest_stored(log, "domain", "version")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    comments = spark.createDataFrame([("a.com", "said", None, None, 1)],
                                     "domain string, comments string, evidence string, disagree boolean, seq bigint")
    decisions = spark.createDataFrame([("a.com", "Good", 1, 1)], "domain string, fitment string, ranking int, seq bigint")
    final = V.finalize(decisions, comments, spark.createDataFrame([], "domain string, row_idx bigint"))
    assert "SortAggregate" not in final._jdf.queryExecution().executedPlan().toString() and final.count() == 1


@pytest.mark.parametrize("kind", ["bigint", "int", "double"])
def test_latest_in_two_phases_is_latest_in_one(spark, kind):
    df = spark.range(600).select(
        F.concat(F.lit("k"), F.col("id") % 40).alias("domain"), F.col("id").alias("v"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 40 == 3, -(1 << 31)).otherwise(F.col("id") * 31 % 601).cast(kind).alias("seq"))
    df = df.unionAll(df).unionAll(df.limit(1).select(F.lit(""), "v", "seq"))
    one, two = (sorted(map(tuple, f(df, "domain", "seq").select("domain", "seq").collect()), key=repr) for f in (Sel.latest_by, Sel.latest_stored))
    assert one == two and len(two) == 40
    extremes = spark.createDataFrame([("a", 1, None), ("a", 2, -(1 << 63)), ("b", 3, (1 << 63) - 1), ("b", 4, 0), ("c", 5, None)],
                                     "domain string, v int, seq bigint")
    assert {r.v for r in Sel.latest_stored(extremes, "domain").collect()} == {2, 3, 5}


HTML = "<title>t</title><p>{}</p>"
PAGES = "page_id bigint, url string, html string, version bigint"


def crawled(spark):
    pages = [(None, "https://noid.com/", "only"), (None, "https://half.com/", "home"), (3, "https://half.com/about", "about")]
    pages += [(7, f"https://same.com/p{k}", f"page {k}") for k in range(10)]
    pages += [(k, "https://again.com/", f"crawl {k}") for k in (1, 1, 1)] + [(2, "https://again.com/", "other")]
    made = [(i, u, HTML.format(t), 0) for i, u, t in pages]
    return spark.createDataFrame(made + [(1, "https://again.com/", HTML.format("latest"), 5), (1, "https://again.com/", HTML.format("early"), None)], PAGES)


def test_null_and_repeated_ids(spark):
    got = {}
    for r in ingest_first_pages(crawled(spark)).orderBy("depth", "no_id", "place_id", "url").collect():
        got.setdefault(r.domain, []).append(r.text)
    assert got == {"noid.com": ["only"], "half.com": ["home", "about"], "same.com": [f"page {k}" for k in range(5)],
                   "again.com": ["latest", "other"]}
    sites = {r.domain: r.pages for r in crawl_results(crawled(spark)).collect()}
    assert sites == {"noid.com": 1, "half.com": 2, "same.com": 5, "again.com": 2}


def test_html_of_other_pages_is_dropped_at_the_scan(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://a.com/p"), "id").alias("url"),
                             F.concat(F.lit("<p>"), F.sha2(F.col("id").cast("string"), 512)).alias("html")).write.parquet(path)
    plan = ingest_first_pages(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    # From the scan up: nothing that carries HTML is exchanged before the filter by the chosen keys.
    lines = plan.splitlines()
    joins = [k for k, line in enumerate(lines) if "_leaf" in line and "BroadcastHashJoin" in line]
    assert len(joins) == 1
    below = "\n".join(lines[joins[0]:])
    assert "html" in below and not re.search(r"Exchange hashpartitioning\(.*\n.*html", below)
    keys = spark.createDataFrame([("a.com", k) for k in range(5)], "domain string, page_id bigint")
    wide = spark.range(3000).select(F.lit("a.com").alias("domain"), F.col("id").alias("page_id"))
    assert 5 <= Sel.may_hold(wide, keys, ["domain", "page_id"]).count() <= 60
    assert Sel.may_hold(wide, keys, ["domain", "page_id"], filter_bytes=10).count() == 3000
    assert Sel.fetch_rows(wide, keys, ["domain", "page_id"], filter_bytes=10).count() == 5
    assert Sel.fetch_rows(wide, keys, ["domain", "page_id"]).count() == 5


def test_three_batches_out_of_order_equal_the_whole(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("version", F.lit(0).cast("bigint"))
    pages = given.unionAll(crawled(spark))
    for k in (2, 0, 1):
        pages.where(f"pmod(hash(url, html, version), 3) = {k}").write.mode("append").parquet(landing)
        incremental_pages(spark, landing, out, f"{out}/progress", PAGES)
    versions = SiteStore(spark, out).versions()
    incremental_pages(spark, landing, out, f"{out}/progress", PAGES)
    assert versions == [1, 2, 3] == SiteStore(spark, out).versions()
    columns = ["domain", "status", "gate_reason", "chars", "digest"]
    got, want = (sorted(tuple(r) for r in df.select(*columns).collect()) for df in (current_sites(spark, out), crawl_results(pages)))
    assert got == want


def test_positions_leave_no_copy(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.concat(F.lit("t"), "id").alias("text"))
    folder = spark.sparkContext.getCheckpointDir()
    before = set(glob.glob(f"{folder.removeprefix('file:')}/*")) if folder else set()
    numbered = Sel.with_row_index(df, "k", total="n")
    got = sorted((r.row_idx, r.k, r.n) for r in numbered.collect())
    assert [g[1] for g in got] == sorted(r.k for r in df.collect())
    assert [g[0] for g in got] == list(range(5000)) and {g[2] for g in got} == {5000}
    folder = spark.sparkContext.getCheckpointDir()
    assert (set(glob.glob(f"{folder.removeprefix('file:')}/*")) if folder else set()) == before
    # A plan made again, as after a lost executor, and one over other partitions give the same numbers.
    again = Sel.with_row_index(df.repartition(3), "k", total="n")
    assert sorted((r.row_idx, r.k, r.n) for r in again.collect()) == got
    index = Sel.key_index(df, "k", ranges=16)
    assert len(index.borders) == 15 and max(b - a for a, b in zip(index.before, index.before[1:])) < 5000 / 8
    assert Sel.with_row_index(df.limit(0), "k").count() == 0
    assert [r.row_idx for r in Sel.with_row_index(df.limit(1), "k").collect()] == [0]


def test_a_hot_owner_is_dealt_over_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    pages = spark.range(9000).select(F.col("id").alias("page_id"), F.lit("some text").alias("text"), F.concat(
        F.lit("https://www."), F.when(F.col("id") % 3 == 0, "hot.com").otherwise(F.concat(F.lit("d"), F.col("id") % 900, F.lit(".com"))),
        F.lit("/p"), "id").alias("url"))
    domains = spark.range(1000).select(F.concat(F.lit("d"), "id", F.lit(".com")).alias("domain"), F.col("id").alias("seq")) \
        .unionAll(spark.createDataFrame([("hot.com", 1), ("www.hot.com", 2)], "domain string, seq bigint"))
    try:
        for k, v in zip(old, ("false", "-1", "16"), strict=True):
            spark.conf.set(k, v)
        given = Sites.assign_pages(pages, domains)
        sizes = sorted(r["count"] for r in given.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == 9000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert given.where("domain = 'www.hot.com'").count() == 3000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_leads_may_have_any_column_names(spark):
    names = ["_status", "_key", "_domain", "_row_v", "_tier", "v", "lead", "status", "key", "domain", "_fitment", "a.b"]
    leads = spark.createDataFrame([(0, "a.com", *names), (1, "b.com", *names), (2, "", *names)],
                                  ", ".join(["row_idx bigint", "Website string", *[f"`{n}` string" for n in names]]))
    verdicts = spark.createDataFrame([(None, "a.com", None, "Good", "1", "fits"), (1, None, None, "Avg", "2", "row"), (1, None, -5, "Unfit", "9", "newer")],
                                     "row_idx bigint, domain string, seq bigint, fitment string, ranking string, comments string")
    results = spark.createDataFrame([("a.com", "ok", None), ("b.com", "thin", 3)], "domain string, status string, seq bigint")
    merged = V.merge_verdicts(leads, verdicts, results, "Website")
    out = V.qualified(merged).orderBy("row_idx")
    assert out.columns == ["row_idx", "Website", *names, "Fitment", "Ranking", "Comments", "Crawl_Status"]
    got = out.collect()
    assert all(list(r)[2:2 + len(names)] == names for r in got)
    assert [(r.Fitment, r.Ranking, r.Comments, r.Crawl_Status) for r in got] == [
        ("Good", 1, "fits", "ok"), ("Unfit", 3, "newer", "thin"), ("Unfit", 3, "Not assessed", "not_crawled")]
    assert [tuple(r)[:3] for r in V.malformed(merged).collect()] == [(1, False, True)]
