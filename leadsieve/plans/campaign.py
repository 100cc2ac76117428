"""The stages of a campaign as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadsieve import constants as C
from leadsieve.functions.domains import offdomain_mark
from leadsieve.operators.decide import incremental_decide
from leadsieve.operators.gate import build_digest, quality_gate
from leadsieve.operators.rules import prefilter
from leadsieve.operators.selection import cap_share, latest_by
from leadsieve.operators.sites import domain_rows, list_sites, plan_fetches, skip_disqualified
from leadsieve.operators.verdicts import (all_verdicts, domain_verdicts, finalize, merge_verdicts,
                                          resolve_failed)
from leadsieve.session import stored
from leadsieve.sources.pages import ORDER, ingest_first_pages, linked_pages
from leadsieve.sources.rubric import Rubric
from leadsieve.sources.store import SiteStore


def gated_sites(pages: DataFrame, requested: DataFrame | None = None, links: bool = False) -> DataFrame:
    """Raw pages as gated sites; with `requested` (domain), one for each of its domains and no others.

    A requested domain without pages is `thin` and fails the gate with `no_pages`. Its pages are those of least depth, or
    with `links` those that its homepage's best links lead to.
    """
    sites = list_sites(linked_pages(pages, requested), "place") if links else list_sites(ingest_first_pages(pages, requested), *ORDER)
    if requested is not None:
        found = requested.select("domain").distinct().join(sites, "domain", "left")
        none = F.array().cast(sites.schema["pages"].dataType)
        sites = found.withColumns({"pages": F.coalesce("pages", none), "chars": F.coalesce("chars", F.lit(0)),
                                   "status": F.coalesce("status", F.lit("thin"))})
    return quality_gate(sites)


def crawl_results(pages: DataFrame, tier: str = "plain", requested: DataFrame | None = None, links: bool = False) -> DataFrame:
    """Gated sites with digest, as the crawl log records them; see `gated_sites` for `requested` and `links`.

    `error` tells of sites without pages and of homepages on another owner's domain, which keep their status.
    """
    gated = build_digest(gated_sites(pages, requested, links))
    away = offdomain_mark(F.col("domain"), F.col("pages")[0]["url"])
    return gated.select("domain", "status", "gate_ok", "gate_reason",
                        F.lit(tier).alias("source_tier"), F.size("pages").alias("pages"),
                        "chars", F.when(F.size("pages") == 0, "no pages").otherwise(away).alias("error"),
                        "digest")


def requested_domains(leads: DataFrame, url_col: str, rubric: Rubric) -> DataFrame:
    """The domains to crawl for the leads (domain, first_row): those with a row that no rule rejects."""
    return skip_disqualified(domain_rows(leads, url_col), prefilter(leads, rubric.rules, url_col))


def fetch_plan(wanted: DataFrame, sites: DataFrame, mode: str = "first", paid: bool = False,
               most: int | None = None) -> DataFrame:
    """What to do with each wanted domain (domain, first_row, action): `serve`, `fetch`, `skip` or `defer`.

    `wanted` and `sites` hold a domain once, first rows differ. Modes are those of `plan_fetches`. Of paid fetches only the
    first `most` in lead order are made now, or a share of all wanted domains, and the others deferred.
    """
    planned = wanted.select("domain", "first_row").join(plan_fetches(wanted, sites, mode), "domain")
    if not paid:
        return planned
    todo = planned.where("action = 'fetch'").select("domain", "first_row")
    now = cap_share(todo, "first_row", share=C.ESCALATION_SHARE, of=wanted, cap=most).select("domain", F.lit(True).alias("_now"))
    late = (F.col("action") == "fetch") & F.col("_now").isNull()
    return planned.join(now, "domain", "left").withColumn("action", F.when(late, "defer").otherwise(F.col("action"))).drop("_now")


def crawl_planned(store: SiteStore, plan: DataFrame, pages: DataFrame, version: int, tier: str = "plain") -> DataFrame:
    """Results of the domains of a `fetch_plan`: those to serve as stored, those to fetch from `pages`, which replace stored ones.

    Pages of other domains are left out. A domain that was to be fetched and has no pages is stored as failed. The new
    results are written once, and read from there for the store and for what is returned.
    """
    plan = stored(plan, "plan")
    fresh = stored(crawl_results(pages, tier, plan.where("action = 'fetch'").select("domain"))
                   .withColumn("version", F.lit(version).cast("bigint")), "fresh")
    kept = store.lookup(plan.where("action = 'serve'").select("domain"))
    served = fresh.limit(0) if kept is None else stored(kept, "served")
    store.upsert(fresh)
    return served.unionByName(fresh, allowMissingColumns=True)


def decide_new(results: DataFrame, answers: DataFrame, grades: DataFrame, rubric: Rubric,
               decisions: DataFrame | None = None, verdicts: DataFrame | None = None,
               model: str = "", rejudge: bool = False) -> DataFrame:
    """Records for the decision log: passed domains that `decisions`, the log so far, does not hold.

    Domains with a domain-level verdict are left out, unless `rejudge`. Records of one run share
    a seq above all stored ones. model and input_tokens come from the grades where these hold them.
    """
    passed = latest_by(_numbered(results.where("gate_ok")), "domain")
    log = passed.select("domain", "seq").limit(0) if decisions is None else decisions
    done = None if rejudge or verdicts is None else domain_verdicts(verdicts)
    usage = [c for c in ("model", "input_tokens") if c in grades.columns]
    decided = incremental_decide(passed, answers, grades.drop(*usage), log, rubric.signals, done)
    asked = latest_by(_numbered(grades), "domain").select("domain", *usage)
    run = F.lit(1) if decisions is None else \
        log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).scalar()
    facts = passed.select("domain", F.col("status").alias("crawl_status"), "source_tier")
    given = {"model": F.coalesce("model", F.lit(model)) if "model" in usage else F.lit(model),
             "rubric_sha": F.lit(rubric.sha), "decided_at": F.current_timestamp(),
             "seq": run.cast("bigint")}
    return decided.join(facts, "domain").join(asked, "domain").withColumns(given)


def judge(results: DataFrame, answers: DataFrame, grades: DataFrame, comments: DataFrame,
          rubric: Rubric, decisions: DataFrame | None = None,
          verdicts: DataFrame | None = None) -> DataFrame:
    """Model verdicts of passed sites whose decision and comment are complete.

    `decisions` is the stored log, which then is all that counts; without it, what can be
    decided is decided here. `verdicts` are stored ones, whose domains are not finalized again.
    """
    if decisions is None:
        decisions = decide_new(results, answers, grades, rubric, verdicts=verdicts)
    if verdicts is None:
        verdicts = decisions.limit(0).select("domain", F.lit(None).cast("bigint").alias("row_idx"))
    return finalize(decisions, comments, verdicts)


def qualify(leads: DataFrame, url_col: str, rubric: Rubric, results: DataFrame,
            model_verdicts: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Every lead with its verdict: pre-filter, failed sites, model and manual verdicts merged.

    Where both judges know a domain, the larger `seq` counts; a log without the column has 0,
    and of equal numbers the manual verdict counts. Pre-filter verdicts belong to rows and come first.
    """
    early = _numbered(prefilter(leads, rubric.rules, url_col))
    models = _numbered(model_verdicts)
    logs = [models.withColumn("row_idx", F.lit(None).cast("bigint"))]
    if manual is not None:
        logs.append(_numbered(manual))
        if "row_idx" not in manual.columns:
            logs[-1] = logs[-1].withColumn("row_idx", F.lit(None).cast("bigint"))
    # Twice the number, and one more for manual verdicts: they win ties.
    ranked = [log.withColumn("seq", F.col("seq") * 2 + k) for k, log in enumerate(logs)]
    told = all_verdicts(*ranked)
    crawled = latest_by(_numbered(results).select("domain", "gate_ok", "gate_reason", "source_tier",
                                                  "status", "seq"), "domain")
    failed = _numbered(resolve_failed(crawled, told))
    return merge_verdicts(leads, all_verdicts(early, failed, told), crawled, url_col)


def _numbered(log: DataFrame) -> DataFrame:
    return log if "seq" in log.columns else log.withColumn("seq", F.lit(0).cast("bigint"))
