"""Lead files, pre-filter, profile, positions."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from leadsieve.operators import profile as P, selection as Sel, sites as Sites
from leadsieve.operators.rules import Rule, prefilter, rule_hits
from leadsieve.sources.leads import read_leads, write_qualified
from leadsieve.sources.logs import append_log, read_log, read_table

c = F.col
ROWS = [  # company, website, country, employees
    ("Alder", "alder.com", "United States", "5000"), ("Birch", "https://www.birch.com/", "Canada", "10,000"),
    ("Cedar", "cedar.com", "India", "60"), ("Elm, \"Inc\"", "www.elm.io", "united states ", "800"),
    ("Fir\nSons", "https://fir.com", "United States", "1200"), ("Gum", "f@gum.com", "Ireland", "900"),
    ("Holly", "holly.co.uk", "United Kingdom", "3000"), ("Ivy", "ivy.com", "United States", "700"),
    ("Juniper", "juniper.com", "United States", "1"), ("Kauri", "nosuchhost123.com", "United States", "10"),
    ("Cedar Two", "cedar.com", "India", "60"), ("Larch", "", "Germany", "50"),
    ("Maple", "N/A", "France", "20"), ("Nutmeg", "nutmeg.com", "", "n/k"),
]
RULES = [Rule("geo", "Country", accept_values=["United States", "Canada"], comment="Outside target geography"),
         Rule("tiny", "Employees", min=50, comment="Below minimum headcount")]


@pytest.fixture()
def leads(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)],
                                 "row_idx bigint, Company string, Website string, Country string, Employees string")


@pytest.fixture()
def lead_file(tmp_path):
    path = tmp_path / "leads.csv"
    with open(path, "w", encoding="utf-8-sig", newline="") as fh:
        out = csv.writer(fh, delimiter=";")
        out.writerow(["Company", "Website", "Country", "Employees"])
        out.writerows(ROWS)
    return str(path)


def test_read_leads(spark, lead_file):
    got = read_leads(spark, lead_file).orderBy("row_idx").collect()
    assert [tuple(r) for r in got] == [(i, *r) for i, r in enumerate(ROWS)]


def test_read_leads_numbers_many_files_in_order(spark, tmp_path):
    for part, size in enumerate([3, 700, 1, 40]):
        with open(tmp_path / f"part{part}.csv", "w") as fh:
            fh.write("Company,N\n" + "".join(f"c{part},{i}\n" for i in range(size)))
    for multi in (True, False):
        got = read_leads(spark, str(tmp_path), multi_line=multi).orderBy("row_idx").collect()
        assert [r.row_idx for r in got] == list(range(744))
        assert [(r.Company, int(r.N)) for r in got] == [
            (f"c{p}", i) for p, size in enumerate([3, 700, 1, 40]) for i in range(size)]


def test_delivery_keeps_every_cell(spark, leads, tmp_path):
    out = str(tmp_path / "out")
    write_qualified(leads.withColumn("Fitment", F.lit("Good")).withColumn("_tier", F.lit("x")), out, one_file=True)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfCompany,")
    with open(part, encoding="utf-8-sig", newline="") as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == ["Company", "Website", "Country", "Employees", "Fitment"]
    assert [tuple(r) for r in rows[1:]] == [(*r, "Good") for r in ROWS]
    write_qualified(leads.repartition(3), str(tmp_path / "parts"))
    for multi in (True, False):
        again = read_leads(spark, str(tmp_path / "parts"), sep=",", multi_line=multi)
        assert again.columns == ["row_idx", "Company", "Website", "Country", "Employees"]
    again = read_leads(spark, str(tmp_path / "parts"), sep=",").orderBy("row_idx").collect()
    assert [tuple(r)[1:] for r in again] == ROWS


def test_rule_hits_in_order(spark):
    rule = Rule("r", "X", ["Bad"], ["Good", "Bad"], ["rot"], 5, 10)
    df = spark.createDataFrame([(v,) for v in [" bad ", "other", "", "Good"]], "x string")
    assert [r.w for r in df.select(rule_hits(rule, c("x")).alias("w")).collect()] == [
        "X = bad", "X = other (not in target list)", None, None]
    free = Rule("r", "X", reject_contains=["ROT"], min=5, max=10.5)
    df = spark.createDataFrame([(v,) for v in ["carrot 1", "3 men", "11", "1,000", "7", None, "x"]], "x string")
    assert [r.w for r in df.select(rule_hits(free, c("x")).alias("w")).collect()] == [
        "X contains 'ROT'", "X = 3 men (below 5)", "X = 11 (above 10.5)", "X = 1,000 (above 10.5)", None, None, None]


def test_prefilter(spark, leads):
    got = {r.row_idx: r for r in prefilter(leads, RULES, "Website").collect()}
    assert sorted(i for i, r in got.items() if "geo" in r.evidence) == [2, 5, 6, 10, 11, 12]
    assert sorted(i for i, r in got.items() if "tiny" in r.evidence) == [8, 9]
    assert got[2].domain == "cedar.com" and got[11].domain == "" and got[2].comments == "Outside target geography"
    judged = spark.createDataFrame([(2,), (None,)], "row_idx bigint")
    assert 2 not in [r.row_idx for r in prefilter(leads, RULES, "Website", judged).collect()]
    with pytest.raises(ValueError):
        prefilter(leads, [Rule("x", "Nope", min=1)], "Website")
    assert prefilter(leads, [], "Website").count() == 0


def test_a_domain_is_skipped_only_if_all_its_rows_are(spark):
    rows = spark.createDataFrame([(0, "a.com"), (1, "a.com"), (2, "b.com"), (3, "")], "row_idx bigint, domain string")
    out = spark.createDataFrame([(0, "prefilter"), (2, "prefilter"), (1, "plain")], "row_idx bigint, source_tier string")
    assert [tuple(r) for r in Sites.skip_disqualified(rows, out).collect()] == [("a.com", 0)]


def test_profile(spark, leads):
    got = {r.column: r for r in P.profile_columns(leads).collect()}
    assert got["Website"].filled_pct == 92 and got["Company"].samples == "Alder | Birch | Cedar"
    assert got["Website"].n_distinct is None and got["Country"].n_distinct == 8
    assert got["Country"].top_values == "United States (5) | India (2) | Canada (1) | united states (1)"
    best = P.score_url_columns(leads).where("best").first()
    assert (best.column, best.score) == ("Website", 50 + int(60 * 12 / 13))
    h = P.url_health(leads, "Website").first()
    assert tuple(h) == (12, 11, 1, 1, 1, 2)
    context = {r.domain: r.context for r in P.lead_context(leads, "Website").collect()}
    assert context["cedar.com"] == "Company=Cedar | Country=India | Employees=60"
    assert context["nutmeg.com"] == "Company=Nutmeg | Employees=n/k"


def test_collect_domains(leads):
    got = Sites.collect_domains(leads, "Website").orderBy("first_row").collect()
    assert [r.domain for r in got][:3] == ["alder.com", "www.birch.com", "cedar.com"]
    assert {r.domain: r.n_rows for r in got}["cedar.com"] == 2


def test_row_index_matches_sorting(spark):
    rng = random.Random(1)
    keys = [(rng.choice(["hot", "a", "b"]) if rng.random() < .7 else "hot", i) for i in range(3000)]
    df = spark.createDataFrame(keys, "k string, i int").repartition(7)
    got = {(r.k, r.i): r.row_idx for r in Sel.with_row_index(df, "k", "i").collect()}
    assert got == {key: n for n, key in enumerate(sorted(keys))}
    one = Sel.cap_share(df.limit(1), "k", "i", share=.3)
    assert one.count() == 1
    assert Sel.cap_share(df, "k", "i", share=.3).count() == 900
    assert Sel.cap_share(df, "k", "i", share=.3, cap=5).count() == 5
    batches = Sel.chunk(df, "k", "i", size=20).groupBy("batch").count().collect()
    assert len(batches) == 150 and all(r["count"] == 20 for r in batches)


def test_latest_folds_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("", 9, "z"), (None, 8, "w"), ("b", 2, "v")],
                               "domain string, seq int, v string")
    got = Sel.latest_by(df, "domain")
    assert {r.domain: r.v for r in got.collect()} == {"a": "y", "b": "v"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "domain string, n int"
    assert read_log(spark, path, schema).count() == 0
    append_log(spark.createDataFrame([("a", 1)], schema), path)
    append_log(spark.createDataFrame([("b", 2)], schema), path)
    (tmp_path / "log" / "noise.json").write_text('\n{"domain": "c", "n": 3}\nnot json\n{"domain": \n'
                                                '{"domain": "d", "n": "4"}\n{"domain": 5, "n": "x"}\n')
    assert sorted(tuple(r) for r in read_log(spark, path, schema).collect()) == [
        ("5", None), ("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    table = str(tmp_path / "table")
    assert read_table(spark, table, schema).count() == 0
    append_log(spark.createDataFrame([("a", 1)], schema), table, "parquet")
    assert read_table(spark, table, schema).count() == 1
