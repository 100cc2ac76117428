"""Rubric rules and the pre-filter."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import normalize_domain
from leadsieve.functions.text import strip, to_number


@dataclass(frozen=True)
class Rule:
    """A disqualifier one lead column can answer."""

    id: str
    column: str
    reject_values: list[str] = field(default_factory=list)
    accept_values: list[str] = field(default_factory=list)
    reject_contains: list[str] = field(default_factory=list)
    min: float | None = None
    max: float | None = None
    comment: str = ""


def _key(text: str) -> str:
    return str(text).strip().lower()


def rule_hits(rule: Rule, value: Column) -> Column:
    """Why a value trips the rule, null if it does not. The first test that trips tells."""
    raw = strip(F.coalesce(value, F.lit("")))
    low, number = F.lower(raw), to_number(raw)
    told = F.concat(F.lit(f"{rule.column} = "), raw)
    tests = []
    if rule.reject_values:
        tests.append(F.when(low.isin([_key(v) for v in rule.reject_values]), told))
    if rule.accept_values:
        tests.append(F.when((low != "") & ~low.isin([_key(v) for v in rule.accept_values]),
                            F.concat(told, F.lit(" (not in target list)"))))
    for part in rule.reject_contains:
        tests.append(F.when(low.contains(_key(part)), F.lit(f"{rule.column} contains {part!r}")))
    if rule.min is not None:
        tests.append(F.when(number < float(rule.min), F.concat(told, F.lit(f" (below {rule.min})"))))
    if rule.max is not None:
        tests.append(F.when(number > float(rule.max), F.concat(told, F.lit(f" (above {rule.max})"))))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def prefilter(leads: DataFrame, rules: list[Rule], url_col: str,
              judged: DataFrame | None = None) -> DataFrame:
    """Row-level Unfit verdicts for rows that trip a rule; the first rule in order counts.

    The rubric's rules become one projection: no join and no shuffle.
    """
    missing = [r.column for r in rules if r.column not in leads.columns]
    if missing:
        raise ValueError(f"rules name columns the leads lack: {missing}")
    if judged is not None:
        done = judged.where(F.col("row_idx").isNotNull()).select("row_idx").distinct()
        leads = leads.join(done, "row_idx", "left_anti")
    hits = [F.when(why.isNotNull(), F.struct(
        F.lit(r.id).alias("id"), F.lit(r.comment).alias("comment"), why.alias("why")))
        for r in rules for why in [rule_hits(r, F.col(r.column))]]
    if not hits:
        leads, hits = leads.limit(0), [F.struct(F.lit("").alias("id"), F.lit("").alias("comment"),
                                                F.lit("").alias("why"))]
    tripped = leads.select("row_idx", F.col(url_col).alias("_url"), F.coalesce(*hits).alias("_hit")) \
        .where(F.col("_hit").isNotNull())
    why = F.col("_hit.why")
    comment = F.when(F.col("_hit.comment") != "", F.col("_hit.comment")).otherwise(why)
    return tripped.select(
        "row_idx", normalize_domain(F.col("_url")).alias("domain"),
        F.lit("Unfit").alias("fitment"), F.lit("3").alias("ranking"),
        F.left(comment, F.lit(C.RULE_COMMENT_CHARS)).alias("comments"),
        F.concat(F.lit("pre-filter rule "), F.col("_hit.id"), F.lit(": "), why).alias("evidence"),
        F.lit("not_crawled").alias("crawl_status"), F.lit("prefilter").alias("source_tier"),
        F.lit("rule").alias("judge"))
