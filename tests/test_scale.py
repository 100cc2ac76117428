"""Plans that must hold when one key owns a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers the queries
from checks.registry import QUERIES
from leadsieve.operators import sites as Sites, verdicts as V

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def conf(spark):
    old = {}

    def put(key, value):
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_domain_is_split_in_the_merge(spark, conf):
    conf("spark.sql.shuffle.partitions", "32")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    leads = spark.range(60000).select(
        F.col("id").alias("row_idx"), F.when(F.col("id") % 3 == 0, "hot.com").otherwise(
            F.concat(F.lit("d"), F.col("id"), F.lit(".com"))).alias("Website"),
        F.sha2(F.col("id").cast("string"), 512).alias("Note"))
    verdicts = spark.range(60000).select(
        F.lit(None).cast("bigint").alias("row_idx"), F.when(F.col("id") == 0, "hot.com").otherwise(
            F.concat(F.lit("d"), F.col("id"), F.lit(".com"))).alias("domain"), F.lit(1).alias("seq"),
        F.lit("Good").alias("fitment"), F.lit("1").alias("ranking"), F.lit("c").alias("comments"),
        F.lit("ok").alias("crawl_status"), F.lit("plain").alias("source_tier"), F.lit("model").alias("judge"))
    results = verdicts.select("domain", F.lit("ok").alias("status"), "seq")
    merged = V.merge_verdicts(leads.repartition(12), verdicts, results, "Website")
    assert "skew=true" in final_plan(merged)
    assert merged.groupBy("Fitment").count().collect()[0]["count"] == 60000


def test_leads_without_website_do_not_meet(spark):
    leads = spark.range(1000).select(F.col("id").alias("row_idx"), F.lit("").alias("Website"))
    none = spark.createDataFrame([], "row_idx bigint, domain string, seq int, fitment string, ranking string, "
                                     "comments string, crawl_status string, source_tier string, judge string")
    merged = V.merge_verdicts(leads, none, none.selectExpr("domain", "crawl_status status", "seq"), "Website")
    plan = merged._jdf.queryExecution().analyzed().toString()
    assert re.search(r"cast\(row_idx#\d+L as string\)\) END AS key", plan)
    assert merged.count() == 1000 and merged.where("_assessed").count() == 0


def test_scans_read_only_what_they_need(spark):
    def schema(name):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"ReadSchema: struct<([^>]*)", plan)

    assert all("html" not in s for s in schema("path_of"))
    assert all("props" not in s for s in schema("resolve_cascade"))
    assert all(s.count(":") <= 2 for s in schema("distinct_content_words"))


def test_attempts_are_read_once(spark):
    attempts = spark.read.parquet(f"{SF}/events.parquet").select(
        "event_type", F.col("event_id").alias("seq"), F.lit(False).alias("gate_ok"), F.lit(1).alias("chars"),
        F.col("event_type").alias("tier"), F.col("user_id").cast("string").alias("domain"))
    wanted = spark.range(10).select(F.col("id").cast("string").alias("domain"))
    plan = Sites.resolve_cascade(attempts, ["view"], wanted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
