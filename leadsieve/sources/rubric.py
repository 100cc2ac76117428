"""Rubric files."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leadsieve.operators.decide import Signal
from leadsieve.operators.rules import Rule


@dataclass
class Rubric:
    """The parsed rubric: ordered CSV rules and ordered signals."""

    rules: list[Rule] = field(default_factory=list)
    signals: list[Signal] = field(default_factory=list)
    evidence: dict[str, str] = field(default_factory=dict)
    tiers: dict[str, str] = field(default_factory=dict)
    offering: str = ""
    sha: str = ""


def rubric_sha(content: dict) -> str:
    """Twelve digits that change with the rubric's content, not with its key order."""
    text = json.dumps(content, sort_keys=True, ensure_ascii=False)
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:12]


def with_sha(rubrics: DataFrame, content: str = "content", column: str = "rubric_sha") -> DataFrame:
    """Add the fingerprint of each rubric document (JSON text); text that is no JSON gets null."""
    import pyarrow as pa
    schema = StructType([*rubrics.schema.fields, StructField(column, StringType())])
    place = rubrics.columns.index(content)

    def sha(text: str | None) -> str | None:
        try:
            return rubric_sha(json.loads(text))
        except (TypeError, ValueError):
            return None

    def run(batches):
        for batch in batches:
            made = pa.array([sha(t) for t in batch.column(place).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=schema.names)

    return rubrics.mapInArrow(run, schema)


def parse_rubric(content: dict) -> Rubric:
    """A rule needs a column to be checked on leads, a crawl rule an id, a signal both
    an id and a text."""
    out = Rubric(tiers=content.get("tier_definitions") or {},
                 offering=content.get("offering_summary") or "", sha=rubric_sha(content))
    for d in content.get("disqualifiers") or []:
        if d.get("checkable_from") == "csv" and d.get("column"):
            out.rules.append(Rule(
                str(d.get("id")), d["column"], d.get("reject_values") or [],
                d.get("accept_values") or [], d.get("reject_contains") or [],
                d.get("min"), d.get("max"), d.get("comment") or ""))
        elif d.get("checkable_from") == "crawl" and d.get("id"):
            out.signals.append(Signal("disqualifier", d["id"], d.get("rule") or ""))
            out.evidence[d["id"]] = d.get("evidence") or ""
    for kind, key in (("fit", "fit_signals"), ("anti-fit", "antifit_signals"),
                      ("momentum", "momentum_signals")):
        out.signals += [Signal(kind, s["id"], s["signal"], s.get("weight") or "")
                        for s in content.get(key) or [] if s.get("id") and s.get("signal")]
    return out


def load_rubric(spark: SparkSession, path: str) -> Rubric:
    """Read a rubric, a single small JSON document."""
    return parse_rubric(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def rubric_tables(spark: SparkSession, rubric: Rubric,
                  campaign: str = "") -> tuple[DataFrame, DataFrame]:
    """The signals and the rubric row that `build_questions` reads."""
    signals = [(campaign, s.kind, i, s.id, s.text, s.weight, rubric.evidence.get(s.id, ""))
               for i, s in enumerate(rubric.signals)]
    row = (campaign, rubric.offering, *(rubric.tiers.get(g) for g in ("Good", "Avg", "Unfit")))
    return (spark.createDataFrame(signals, "campaign string, kind string, ord int, id string, "
                                           "text string, weight string, evidence string"),
            spark.createDataFrame([row], "campaign string, offering string, good string, "
                                         "avg string, unfit string"))


_RULE = ("struct<id:string,rule:string,checkable_from:string,column:string,evidence:string,"
         "comment:string,reject_values:array<string>,accept_values:array<string>,"
         "reject_contains:array<string>,min:double,max:double>")
_SIGNAL = "struct<id:string,signal:string,weight:string>"
RUBRIC_TYPE = (f"struct<offering_summary:string,disqualifiers:array<{_RULE}>,"
               f"fit_signals:array<{_SIGNAL}>,antifit_signals:array<{_SIGNAL}>,"
               f"momentum_signals:array<{_SIGNAL}>,tier_definitions:map<string,string>>")


def explode_rubrics(documents: DataFrame, json_col: str = "rubric") -> tuple[DataFrame, DataFrame]:
    """Many rubric documents (campaign, json) as one table of CSV rules and one of signals.

    A rule needs a column to be checked on leads; a crawl rule needs an id, a signal both
    an id and a text. `ord` keeps the document's order within each kind.
    """
    parsed = documents.select("campaign", F.from_json(json_col, RUBRIC_TYPE).alias("r"))
    listed = parsed.select("campaign", F.posexplode("r.disqualifiers").alias("ord", "d"))
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    rules = listed.where((F.col("d.checkable_from") == "csv") & given("d.column")) \
        .select("campaign", "ord", "d.*")
    crawl = listed.where((F.col("d.checkable_from") == "crawl") & given("d.id")).select(
        "campaign", F.lit("disqualifier").alias("kind"), "ord", "d.id",
        F.coalesce("d.rule", F.lit("")).alias("text"), F.lit("").alias("weight"),
        F.coalesce("d.evidence", F.lit("")).alias("evidence"))

    def tagged(kind: str, field: str) -> Column:
        return F.transform(F.coalesce(F.col(f"r.{field}"), F.array().cast(f"array<{_SIGNAL}>")),
                           lambda s, i: F.struct(F.lit(kind).alias("kind"), i.alias("ord"), s["id"].alias("id"),
                                                 s["signal"].alias("text"), s["weight"].alias("weight")))

    every = F.concat(tagged("fit", "fit_signals"), tagged("anti-fit", "antifit_signals"),
                     tagged("momentum", "momentum_signals"))
    signals = parsed.select("campaign", F.explode(every).alias("s")).select("campaign", "s.*") \
        .where(given("id") & given("text")).withColumn("evidence", F.lit(""))
    return rules, crawl.unionByName(signals)
