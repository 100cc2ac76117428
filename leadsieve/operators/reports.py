"""Reports as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import normalize_domain
from leadsieve.functions.text import reason_family
from leadsieve.operators.profile import lead_context
from leadsieve.operators.selection import LOWEST, latest_stored, top_k
from leadsieve.operators.verdicts import audit_of, domain_verdicts, judge_of
from leadsieve.session import checkpointed


def _over_all(col: Column) -> Column:
    """An aggregate over all rows of a result that holds a few lines."""
    return col.over(Window.partitionBy())


def _percent(n: Column, total: Column) -> Column:
    return n * F.lit(100.0) / F.greatest(total, F.lit(1))


def crawl_report(results: DataFrame, top: int = 12) -> DataFrame:
    """Passed and failed counts, accepted tiers with average text, failure families.

    One pass over the results; its few groups are checkpointed and feed every section.
    """
    groups = checkpointed(results.groupBy(
        "gate_ok", F.coalesce("source_tier", F.lit("")).alias("tier"),
        reason_family(F.col("gate_reason")).alias("family")).agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars")))
    gate = groups.groupBy(F.when(F.col("gate_ok"), "passed").otherwise("failed").alias("key")) \
        .agg(F.sum("n").alias("n"))
    shares = gate.select(F.lit("gate").alias("section"), "key", "n",
                         _percent(F.col("n"), _over_all(F.sum("n"))).alias("value"))
    tiers = groups.where("gate_ok").groupBy(F.col("tier").alias("key")).agg(
        F.sum("n").alias("n"), (F.sum("chars") / F.sum("n")).alias("value")).select(
        F.lit("accepted by tier").alias("section"), "key", "n", "value")
    families = groups.where("not gate_ok").groupBy(F.col("family").alias("key")).agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(top).select(
        F.lit("failure").alias("section"), "key", "n", F.lit(None).cast("double").alias("value"))
    return shares.unionAll(tiers).unionAll(families)


def tally(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def merge_report(merged: DataFrame, top: int = 8) -> DataFrame:
    """Distributions and warnings of a merged table, as (section, key, n, pct).

    One aggregate over grades, tiers and judges, whose few groups are checkpointed and feed every section but
    the reasons. These are texts without bound: they fold in each task, only their counts are
    shuffled, and the most frequent are taken without storing the others.
    """
    at = audit_of(merged)
    rows = merged.select(
        F.col(at["fitment"]).alias("fitment"), F.col(at["ranking"]).cast("string").alias("ranking"),
        F.col(at["tier"]).alias("tier"), F.col(at["judge"]).alias("judge"),
        F.when(F.col(at["tier"]) == "prefilter", F.col(at["comments"])).alias("reason"),
        (((F.col(at["fitment"]) == "Good") & (F.col(at["ranking"]) != 1))
         | ((F.col(at["fitment"]) == "Unfit") & (F.col(at["ranking"]) != 3))).alias("divergent"),
        F.col(at["flagged"]).alias("flagged"), F.col(at["disagree"]).alias("disagree"),
        (~F.col(at["assessed"])).alias("unassessed"),
        (F.col(at["bad_fitment"]).cast("int") + F.col(at["bad_ranking"]).cast("int")).alias("bad"))
    keys, warned = ["fitment", "ranking", "tier", "judge"], ["divergent", "flagged", "disagree", "unassessed"]
    groups = checkpointed(rows.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(c) for c in warned], F.sum("bad").alias("bad")))
    spread = [groups.groupBy(F.col(k).alias("key")).agg(F.sum("n").alias("n")).select(F.lit(k).alias("section"), "key", "n")
              for k in keys]
    reasons = top_k(rows.where(F.col("reason").isNotNull()), "reason", top).select(
        F.lit("reason").alias("section"), F.col("reason").alias("key"), "n")
    warnings = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*warned, "bad")]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("key"), F.col(c).cast("bigint").alias("n")) for c in (*warned, "bad")])).alias("w")).select(
        F.lit("rows").alias("section"), "w.key", "w.n")
    # A few dozen lines are left; every row has one fitment.
    lines = reduce(DataFrame.unionAll, [*spread, reasons, warnings])
    counted = _over_all(F.sum(F.when(F.col("section") == "fitment", F.col("n"))))
    return lines.select("section", "key", "n", _percent(F.col("n"), counted).alias("pct"))


# --- two judges ---------------------------------------------------------------

def _label(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("None"))


def judged_by_both(verdicts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Domains with a domain-level manual verdict and a model decision, side by side."""
    manual = latest_stored(domain_verdicts(verdicts).where(
        judge_of(F.col("judge"), F.col("source_tier")) == "manual"), "domain")
    model = latest_stored(decisions, "domain")
    return manual.select(
        "domain", F.initcap(F.lower(_label(F.col("fitment")))).alias("manual_fitment"),
        _label(F.col("ranking")).alias("manual_ranking"), "comments").join(
        model.select("domain", F.col("fitment").alias("model_fitment"),
                     _label(F.col("ranking")).alias("model_ranking"), "why",
                     F.col("fitment_probabilities")["Good"].alias("p_good"),
                     (F.size("needs_review") > 0).alias("flagged")), "domain")


def agreement_matrix(pairs: DataFrame, manual: str, model: str, labels: list[str]) -> DataFrame:
    """Counts of label pairs (rows manual, columns model) with the overall agreement share."""
    cells = pairs.groupBy(F.col(manual).alias("manual"), F.col(model).alias("model")).agg(
        F.count("*").alias("n"))
    # Few label pairs are left.
    agreed = F.when((F.col("manual") == F.col("model")) & F.col("manual").isin(labels), F.col("n")) \
        .otherwise(0)
    shared = cells.withColumn("agree_share", _over_all(F.sum(agreed)) / _over_all(F.sum("n")))
    return shared.where(F.col("manual").isin(labels)).groupBy("manual", "agree_share") \
        .pivot("model", labels).agg(F.sum("n")).na.fill(0, subset=labels)


def mean_probability_by_grade(pairs: DataFrame) -> DataFrame:
    """Average model probability of Good for each manual grade."""
    return pairs.where(F.col("manual_fitment").isin(C.GRADES)).groupBy("manual_fitment").agg(
        F.count("*").alias("n"), F.avg(F.coalesce("p_good", F.lit(0.0))).alias("mean_p_good"))


def review_agreement(pairs: DataFrame) -> DataFrame:
    """Flagged decisions, and how many of them differ from the manual grade."""
    differs = F.col("manual_fitment") != F.col("model_fitment")
    return pairs.agg(F.count_if("flagged").alias("flagged"),
                     F.count_if(F.col("flagged") & differs).alias("flagged_differing"))


def disagreements(pairs: DataFrame, n: int) -> DataFrame:
    """The first n domains whose grade or wave differs."""
    return pairs.where((F.col("manual_fitment") != F.col("model_fitment"))
                       | (F.col("manual_ranking") != F.col("model_ranking"))) \
        .orderBy("domain").limit(n)


# --- progress -------------------------------------------------------------------

def stale_decisions(decisions: DataFrame, sha: str) -> DataFrame:
    """Latest decisions made with another rubric."""
    return latest_stored(decisions, "domain").where(~F.col("rubric_sha").eqNullSafe(F.lit(sha)))


def progress(sites: DataFrame, verdicts: DataFrame, decisions: DataFrame, sha: str) -> DataFrame:
    """Crawled, passed, failed, assessed, pending and stale domains in one row."""
    tagged = [
        sites.select("domain", F.lit("s").alias("tag"), "gate_ok",
                     F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("sha")),
        domain_verdicts(verdicts).select("domain", F.lit("v"), F.lit(None).cast("boolean"),
                                         F.lit(None).cast("bigint"), F.lit(None).cast("string")),
        decisions.where("coalesce(domain, '') <> ''").select(
            "domain", F.lit("d"), F.lit(None).cast("boolean"), F.coalesce(F.col("seq").cast("bigint"), F.lit(LOWEST)), "rubric_sha"),
    ]
    # One shuffle for all three logs; repeats of a domain fold before it.
    per_domain = reduce(DataFrame.unionAll, tagged).groupBy("domain").agg(
        F.bool_or("gate_ok").alias("passed"), F.bool_or(F.col("tag") == "v").alias("assessed"),
        F.bool_or(F.col("tag") == "d").alias("decided"),
        F.max_by(F.when(F.col("tag") == "d", F.coalesce("sha", F.lit(""))), "seq").alias("sha"))
    passed = F.coalesce("passed", F.lit(False))
    return per_domain.agg(
        F.count("passed").alias("crawled"), F.count_if(passed).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"), F.count_if("assessed").alias("assessed"),
        F.count_if(passed & ~F.col("assessed")).alias("pending"),
        F.count_if(F.col("decided")).alias("decided"),
        F.count_if(F.col("decided") & (F.col("sha") != sha)).alias("stale"))


def decision_report(decisions: DataFrame) -> DataFrame:
    """Grades, waves, flagged decisions, tokens and price in one row."""
    tokens = F.coalesce(F.sum("input_tokens"), F.lit(0))
    return decisions.agg(
        F.count("*").alias("decided"), tokens.alias("tokens"),
        (tokens * F.lit(C.USD_PER_MILLION_TOKENS) / F.lit(1e6)).alias("usd"),
        *[F.count_if(F.col("fitment") == g).alias(g.lower()) for g in C.GRADES],
        *[F.count_if(F.col("ranking").cast("int") == r).alias(f"wave_{r}") for r in (1, 2, 3)],
        F.count_if(F.size("needs_review") > 0).alias("flagged"))


# --- work sheets ------------------------------------------------------------------

def next_batch(sites: DataFrame, done: DataFrame, leads: DataFrame, url_col: str,
               n: int = C.REVIEW_BATCH, failed: bool = False) -> DataFrame:
    """The next n passed domains without a verdict, in lead order, with context and digest.

    sites: (domain, first_row, gate_ok, digest, ...). `failed` takes domains that did not
    pass the gate instead. The n chosen rows are checkpointed, so the sites are read once,
    and only they meet the leads.
    """
    wanted = ~F.coalesce("gate_ok", F.lit(False)) if failed else F.col("gate_ok")
    batch = checkpointed(sites.where(wanted).join(
        domain_verdicts(done).select("domain"), "domain", "left_anti")
        .orderBy("first_row").limit(n))
    return _with_context(batch, leads, url_col)


def _with_context(batch: DataFrame, leads: DataFrame, url_col: str) -> DataFrame:
    """Add the lead context to a batch of a fixed number of domains."""
    chosen = batch.select(F.col("domain").alias("_wanted"))
    keyed = leads.withColumn("_wanted", normalize_domain(F.col(f"`{url_col}`")))
    mine = keyed.join(chosen, "_wanted", "left_semi").drop("_wanted")
    context = lead_context(mine, url_col).select("domain", "context")
    return batch.join(context, "domain", "left")


def comment_sheet(decisions: DataFrame, comments: DataFrame, sites: DataFrame,
                  verdicts: DataFrame, leads: DataFrame, url_col: str,
                  n: int = C.REVIEW_BATCH) -> DataFrame:
    """The next n decided domains without a comment: verdict, signals, notes, context, digest.

    Domains come in the order of their first decision; what the sheet shows is the latest.
    """
    first = decisions.groupBy("domain").agg(F.min(F.coalesce(F.col("seq").cast("bigint"), F.lit(LOWEST))).alias("_first"))
    open_decisions = latest_stored(decisions, "domain").join(first, "domain") \
        .join(comments.select("domain"), "domain", "left_anti") \
        .join(domain_verdicts(verdicts).select("domain"), "domain", "left_anti")
    batch = checkpointed(open_decisions.orderBy("_first", "domain").limit(n).drop("_first"))

    def texts(kind: str) -> Column:
        mine = F.filter("signals_present", lambda s: s["kind"] == kind)
        return F.array_join(F.transform(mine, lambda s: s["text"]), " | ")

    sheet = batch.select(
        "domain", "seq", F.concat_ws(" / ", "fitment", F.col("ranking").cast("string")).alias("verdict"),
        "why", *[texts(k).alias(k.replace("-", "_")) for k in ("disqualifier", "fit", "anti-fit", "momentum")],
        F.array_join("needs_review", "; ").alias("review"))
    found = sites.join(sheet.select("domain"), "domain", "left_semi") \
        .select("domain", "source_tier", "chars", "digest")
    return _with_context(sheet.join(found, "domain", "left"), leads, url_col)
