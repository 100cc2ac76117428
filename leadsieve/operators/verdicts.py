"""Verdict logs and their way back onto the leads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import normalize_domain
from leadsieve.functions.text import comment_for, strip
from leadsieve.operators.selection import latest_stored, order_value

NEW_COLUMNS = ["Fitment", "Ranking", "Comments", "Crawl_Status"]


def domain_verdicts(verdicts: DataFrame) -> DataFrame:
    """Domain-level verdicts only; a pre-filtered row says nothing about its domain."""
    return verdicts.where("row_idx is null and coalesce(domain, '') <> ''")


def resolve_failed(results: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Unfit verdicts naming the data problem of failed domains without a verdict."""
    failed = results.where("not gate_ok").join(
        domain_verdicts(verdicts).select("domain"), "domain", "left_anti")
    return failed.select(
        "domain", F.lit("Unfit").alias("fitment"), F.lit("3").alias("ranking"),
        comment_for(F.col("gate_reason")).alias("comments"),
        F.concat(F.lit("gate="), F.col("gate_reason"), F.lit(" tier="),
                 F.coalesce("source_tier", F.lit(""))).alias("evidence"),
        F.col("status").alias("crawl_status"),
        F.coalesce(F.nullif(F.col("source_tier"), F.lit("")), F.lit("none")).alias("source_tier"),
        F.lit("rule").alias("judge"))


def _commented(comments: DataFrame) -> DataFrame:
    return latest_stored(comments, "domain").where(strip(F.coalesce("comments", F.lit(""))) != "")


def finalize(decisions: DataFrame, comments: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts of decided and commented domains; the grade comes from the decision only."""
    said = _commented(comments).select(
        "domain", strip(F.col("comments")).alias("comments"),
        F.coalesce("evidence", F.lit("")).alias("evidence"),
        F.coalesce("disagree", F.lit(False)).alias("disagree"))
    open_decisions = latest_stored(decisions, "domain").join(
        domain_verdicts(verdicts).select("domain"), "domain", "left_anti")
    joined = open_decisions.drop("comments", "evidence", "disagree").join(said, "domain")
    extra = [c for c in ("crawl_status", "source_tier", "model", "needs_review")
             if c in decisions.columns]
    return joined.select("domain", "fitment", F.col("ranking").cast("string").alias("ranking"),
                         "comments", "evidence", *extra, F.lit("model").alias("judge"), "disagree")


def missing_comments(decisions: DataFrame, comments: DataFrame,
                     verdicts: DataFrame | None = None) -> DataFrame:
    """Decided domains that still need a comment."""
    decided = latest_stored(decisions, "domain").join(
        _commented(comments).select("domain"), "domain", "left_anti")
    if verdicts is not None:
        decided = decided.join(domain_verdicts(verdicts).select("domain"), "domain", "left_anti")
    return decided


def orphan_comments(decisions: DataFrame, comments: DataFrame) -> DataFrame:
    """Commented domains without a decision."""
    return latest_stored(comments, "domain").join(
        decisions.select("domain"), "domain", "left_anti")


def both_progress(decisions: DataFrame, comments: DataFrame, verdicts: DataFrame) -> DataFrame:
    """How many domains are decided, decided and commented, decided and finalized."""
    # Tags instead of joins: one shuffle, and repeats fold before it.
    tags = [df.where("coalesce(domain, '') <> ''").select("domain", F.lit(t).alias("tag"))
            for df, t in ((decisions, "d"), (comments, "c"), (domain_verdicts(verdicts), "v"))]
    flags = reduce(DataFrame.unionAll, tags).groupBy("domain").agg(
        *[F.bool_or(F.col("tag") == t).alias(t) for t in "dcv"])
    return flags.agg(F.count_if("d").alias("decided"),
                     F.count_if(F.col("d") & F.col("c")).alias("commented"),
                     F.count_if(F.col("d") & F.col("v")).alias("finalized"))


def all_verdicts(*logs: DataFrame) -> DataFrame:
    """One verdict table from pre-filter, resolved, finalized and manual logs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def judge_of(judge: Column, tier: Column) -> Column:
    return F.coalesce(F.nullif(judge, F.lit("")),
                      F.when(tier == "prefilter", "rule").otherwise("manual"))


def coerce_fitment(fitment: Column) -> tuple[Column, Column]:
    """A valid grade, and whether the given one was invalid."""
    raw = F.lower(strip(F.coalesce(F.nullif(fitment, F.lit("")), F.lit("Unfit"))))
    known = F.coalesce(*[F.when(raw == g.lower(), F.lit(g)) for g in C.GRADES])
    return F.coalesce(known, F.lit("Unfit")), known.isNull()


def coerce_ranking(ranking: Column) -> tuple[Column, Column]:
    """A wave of 1 to 3, and whether a whole number outside that range was given.

    Blank, zero and non-numeric values become 3 without a flag.
    """
    text = strip(F.coalesce(ranking, F.lit("")))
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("decimal(38,0)"))
    number = F.when(number != 0, number)
    bad = F.coalesce(~number.isin(1, 2, 3), F.lit(False))
    return F.when(bad | number.isNull(), 3).otherwise(number.cast("int")), bad


def coerce_verdict(df: DataFrame) -> DataFrame:
    """Valid fitment, ranking and comments, with flags for malformed values."""
    fitment, bad_fitment = coerce_fitment(F.col("fitment"))
    ranking, bad_ranking = coerce_ranking(F.col("ranking"))
    comments = F.left(strip(F.coalesce("comments", F.lit(""))), F.lit(C.COMMENT_CHARS))
    given = df.select("*", F.struct(
        fitment.alias("fitment"), ranking.alias("ranking"), comments.alias("comments"),
        bad_fitment.alias("bad_fitment"), bad_ranking.alias("bad_ranking")).alias("_v"))
    return given.drop("fitment", "ranking", "comments").select("*", "_v.*").drop("_v")


def unique_header(name: str, taken: list[str]) -> str:
    """The name, or the first of name_2, name_3, ... the source does not use."""
    n, free = 2, name
    while free in taken:
        free, n = f"{name}_{n}", n + 1
    return free


#: What the report needs to know of each lead. The columns are named with a leading underscore, or more of them
#: where the leads have such a column; their metadata says which is which.
AUDIT = ["tier", "judge", "flagged", "disagree", "assessed", "bad_fitment", "bad_ranking", "fitment", "ranking", "comments"]
_ROLE = "leadsieve.audit"
_VERDICT = ["fitment", "ranking", "comments", "crawl_status", "source_tier", "judge",
            "needs_review", "disagree"]


def audit_of(merged: DataFrame) -> dict[str, str]:
    """The audit columns of a merged table by what they hold."""
    found = {f.metadata[_ROLE]: f.name for f in merged.schema.fields
             if _ROLE in (f.metadata or {}) and f.name.lstrip("_") == f.metadata[_ROLE] and f.name[0] == "_"}
    return found or {role: f"_{role}" for role in AUDIT}


def merge_verdicts(leads: DataFrame, verdicts: DataFrame, results: DataFrame, url_col: str,
                   status: bool = True) -> DataFrame:
    """Every lead with its verdict columns, plus audit columns for the report.

    A row verdict beats a domain verdict; a lead with neither is 'Not assessed'. Of several, the one with the
    largest seq counts; a null seq comes before all others. Only row number and host of a lead meet the
    verdicts, row verdicts and domain verdicts fold into one narrow row per lead, and the whole leads shuffle
    once, by row. Leads without a website get a key of their own and spread evenly; a domain with very
    many leads is split by adaptive skew-join handling. Leads may have columns of any name but `row_idx`.
    """
    types = {"needs_review": "boolean", "disagree": "boolean"}
    have = set(verdicts.columns)

    def field(c: str) -> Column:
        if c not in have:
            return F.lit(None).cast(types.get(c, "string")).alias(c)
        if c == "needs_review" and verdicts.schema[c].dataType.typeName() == "array":
            return (F.size(c) > 0).alias(c)
        return F.col(c).alias(c)

    packed = verdicts.select("row_idx", "domain", order_value(verdicts, "seq").alias("seq"),
                             F.struct(*map(field, _VERDICT)).alias("v"))
    by_row = packed.where("row_idx is not null").groupBy("row_idx").agg(F.max_by("v", "seq").alias("row_v"))
    by_domain = domain_verdicts(packed).groupBy("domain").agg(F.max_by("v", "seq").alias("dom_v"))
    crawled = results.where("coalesce(domain, '') <> ''").groupBy("domain").agg(
        F.max_by("status", order_value(results, "seq")).alias("status"))
    known = by_domain.join(crawled, "domain", "full").withColumnRenamed("domain", "key")

    original = [c for c in leads.columns if c != "row_idx"]
    domain = normalize_domain(F.col(f"`{url_col}`"))
    keyed = leads.select("row_idx", domain.alias("host")).select("row_idx", F.when(
        F.col("host") != "", F.col("host")).otherwise(F.concat(F.lit("\x00"), F.col("row_idx").cast("string"))).alias("key"))
    told = keyed.join(known, "key", "left").select("row_idx", "dom_v", "status")
    # The lead's own columns travel as one struct, so no name of theirs meets one of ours.
    whole = leads.select("row_idx", F.struct(*[F.col(f"`{c}`") for c in original]).alias("lead")) \
        if original else leads.select("row_idx", F.lit(None).alias("lead"))
    chosen = whole.join(told, "row_idx").join(by_row, "row_idx", "left").select(
        "row_idx", "lead", "status", F.coalesce("row_v", "dom_v").alias("v")).withColumn("assessed", F.col("v").isNotNull())
    default = {"fitment": "Unfit", "ranking": "3", "comments": "Not assessed",
               "source_tier": "none", "judge": "none"}

    def value(c: str) -> Column:
        return F.when(F.col("assessed"), F.col(f"v.{c}")).otherwise(F.lit(default.get(c)).cast("string"))

    fitment, bad_fitment = coerce_fitment(value("fitment"))
    ranking, bad_ranking = coerce_ranking(value("ranking"))
    comments = F.left(strip(F.coalesce(value("comments"), F.lit(""))), F.lit(C.COMMENT_CHARS))
    found = F.when(F.col("assessed"), F.coalesce(
        F.nullif(F.col("v.crawl_status"), F.lit("")), F.nullif(F.col("status"), F.lit("")), F.lit(""))) \
        .otherwise(F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("not_crawled")))
    taken, appended = list(original), []
    for name, col in zip(NEW_COLUMNS if status else NEW_COLUMNS[:-1],
                         [fitment, ranking, comments, found]):
        free = unique_header(name, taken)
        taken.append(free)
        appended.append(col.alias(free))
    audit = {"tier": F.coalesce(F.nullif(value("source_tier"), F.lit("")), F.lit("none")),
             "judge": judge_of(value("judge"), value("source_tier")),
             "flagged": F.coalesce(F.col("v.needs_review"), F.lit(False)),
             "disagree": F.coalesce(F.col("v.disagree"), F.lit(False)), "assessed": F.col("assessed"),
             "bad_fitment": bad_fitment, "bad_ranking": bad_ranking,
             "fitment": fitment, "ranking": ranking, "comments": comments}
    mark = "_"
    while any(f"{mark}{role}".lower() in {c.lower() for c in taken} for role in AUDIT):
        mark += "_"
    return chosen.select("row_idx", *[F.col("lead").getField(c).alias(c) for c in original], *appended,
                         *[audit[role].alias(f"{mark}{role}", metadata={_ROLE: role}) for role in AUDIT])


def qualified(merged: DataFrame) -> DataFrame:
    """The merged table as delivered: original columns and verdict columns."""
    return merged.drop(*[f"{c}" for c in audit_of(merged).values()])


def malformed(merged: DataFrame) -> DataFrame:
    """The rows behind the count of malformed verdicts: row_idx, what was wrong, and what stands there now."""
    at = audit_of(merged)
    return merged.where(F.col(at["bad_fitment"]) | F.col(at["bad_ranking"])).select(
        "row_idx", F.col(at["bad_fitment"]).alias("bad_fitment"), F.col(at["bad_ranking"]).alias("bad_ranking"),
        F.col(at["fitment"]).alias("fitment"), F.col(at["ranking"]).alias("ranking"), F.col(at["judge"]).alias("judge"))
