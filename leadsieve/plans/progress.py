"""Counts of a campaign that follow its logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadsieve.operators.selection import LOWEST
from leadsieve.operators.verdicts import domain_verdicts
from leadsieve.session import stored
from leadsieve.sources.store import BUCKETS, SiteStore

#: What counts of a domain: whether it passed the gate (null if it has no site), is assessed, and the rubric of its decision.
CLASS = ["gate_ok", "assessed", "rubric_sha"]


class ProgressStore:
    """`reports.progress` kept up to date from new log rows alone.

    One row per domain holds what counts of it; an update looks up the domains of the new rows, in their buckets, and
    adds one to the class a domain comes into and takes one from the class it leaves. The counts of the classes
    are committed in the manifest with the rows, so both are of one version, and a repeated batch changes nothing.

    Rows without a domain don't count. A site replaces the domain's site of an earlier batch; sites of one domain in one
    batch pass if one of them does. Of decisions the largest seq counts (null is below all others), of equal ones the
    larger rubric fingerprint; a decision without a fingerprint has the empty one.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.store = SiteStore(spark, root, buckets)

    def _notes(self) -> dict:
        return self.store.manifest().get("notes", {})

    def update(self, batch: int, sites: DataFrame | None = None, verdicts: DataFrame | None = None,
               decisions: DataFrame | None = None) -> bool:
        """Take in the new rows of the logs. Batches have growing numbers; False if this one was taken in before.

        Another run that updates at the same time makes one of the two raise; it can be repeated.
        """
        at = (self.store.versions() or [0])[-1]
        notes = self.store.manifest(at).get("notes", {})
        if batch <= notes.get("batch", -1):
            return False
        changes = self._changes(sites, verdicts, decisions)
        if changes is None:
            return False
        changes = stored(changes, "changes")
        old = self.store.lookup(changes)
        if old is None:
            old = changes.limit(0)
        old = old.select("domain", *[F.col(c).alias(f"_{c}") for c in ("gate_ok", "assessed", "decision")])
        come = changes.join(old, "domain", "left").select(
            "domain", F.coalesce("gate_ok", "_gate_ok").alias("gate_ok"),
            (F.col("assessed") | F.coalesce("_assessed", F.lit(False))).alias("assessed"),
            F.greatest("decision", "_decision").alias("decision"), F.lit(batch).cast("bigint").alias("version"),
            F.col("_assessed").isNotNull().alias("_known"), "_gate_ok", "_assessed", "_decision")
        come = stored(come, "progress")
        counts = {tuple(key): n for *key, n in notes.get("counts", [])}
        for key, n in self._deltas(come):
            counts[key] = counts.get(key, 0) + n
        kept = [[*key, n] for key, n in counts.items() if n]
        self.store.upsert(come.select("domain", "gate_ok", "assessed", "decision", "version"),
                          notes={"batch": batch, "counts": kept}, onto=at)
        return True

    def _changes(self, sites, verdicts, decisions) -> DataFrame | None:
        """domain, gate_ok, assessed, decision (seq, sha) of the domains with new rows; repeats fold before the shuffle."""
        no_gate, no_decision = F.lit(None).cast("boolean"), F.lit(None).cast("struct<seq:bigint,sha:string>")
        parts = []
        if sites is not None:
            parts.append(sites.select("domain", "gate_ok",
                                      F.lit(False).alias("assessed"), no_decision.alias("decision")))
        if verdicts is not None:
            parts.append(domain_verdicts(verdicts).select("domain", no_gate, F.lit(True), no_decision))
        if decisions is not None:
            parts.append(decisions.select("domain", no_gate, F.lit(False), F.struct(
                F.coalesce(F.col("seq").cast("bigint"), F.lit(LOWEST)).alias("seq"), F.coalesce("rubric_sha", F.lit("")).alias("sha"))))
        if not parts:
            return None
        return reduce(DataFrame.unionAll, parts).where("coalesce(domain, '') <> ''").groupBy("domain").agg(
            F.bool_or("gate_ok").alias("gate_ok"), F.bool_or("assessed").alias("assessed"), F.max("decision").alias("decision"))

    def _deltas(self, come: DataFrame):
        """Classes and by how much their counts change: as many rows as a few for each rubric."""
        signed = F.explode(F.array(
            F.struct("gate_ok", "assessed", F.col("decision.sha").alias("rubric_sha"), F.lit(1).alias("n")),
            F.when(F.col("_known"), F.struct(F.col("_gate_ok").alias("gate_ok"), F.col("_assessed").alias("assessed"),
                                             F.col("_decision.sha").alias("rubric_sha"), F.lit(-1).alias("n")))))
        sums = come.select(signed.alias("c")).where("c is not null").groupBy(*[F.col(f"c.{k}") for k in CLASS]).agg(F.sum("c.n").alias("n"))
        return [(tuple(r[k] for k in CLASS), r["n"]) for r in sums.where("n <> 0").collect()]

    def report(self, sha: str) -> DataFrame:
        """The row of `reports.progress`; decisions by another rubric than `sha` are stale."""
        counts = self._notes().get("counts", [])

        def total(test) -> int:
            return sum(n for gate_ok, assessed, rubric, n in counts if test(gate_ok, assessed, rubric))

        row = {"crawled": total(lambda g, a, r: g is not None), "passed": total(lambda g, a, r: g is True),
               "failed": total(lambda g, a, r: g is False), "assessed": total(lambda g, a, r: a),
               "pending": total(lambda g, a, r: g is True and not a), "decided": total(lambda g, a, r: r is not None),
               "stale": total(lambda g, a, r: r not in (None, sha))}
        return self.spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} bigint" for c in row))
