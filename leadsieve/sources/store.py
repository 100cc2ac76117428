"""A table of sites, one row per domain, that is updated in place."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from leadsieve.operators.selection import latest_stored
from leadsieve.sources.commits import put_once

BUCKETS = 64


class SiteStore:
    """Sites in buckets of domains, with a manifest for each version.

    A version's manifest names the folder that holds each bucket. An update writes the buckets that its domains
    belong to into a new folder and then commits a manifest that names them; all other buckets stay
    where they are. Readers follow the latest manifest, so a run that is lost before its commit leaves
    the old version as it was, and two runs can't both commit the same version.

    Layout: `manifest/<version>.json`, `data/<folder>/bucket=<n>/`.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._hadoop.Path(f"{self.root}/{path}")

    @property
    def _files(self):
        return self._path("").getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        folder = self._path("manifest")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """{buckets, schema, held: bucket to folder, notes} of a version, the latest by default."""
        known = self.versions()
        if not known or version == 0:
            return {"buckets": self._buckets, "schema": None, "held": {}, "notes": {}}
        stream = self._files.open(self._path(f"manifest/{known[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        """The file appears whole or not at all; an existing one is not replaced."""
        put_once(self.spark, f"{self.root}/manifest/{version}.json", json.dumps(manifest))

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64("domain"), F.lit(buckets)).cast("int")

    def _load(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame | None:
        held = {b: folder for b, folder in manifest["held"].items() if buckets is None or int(b) in buckets}
        if not held:
            return None
        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}/bucket={b}" for b, f in sorted(held.items())])

    def read(self, version: int | None = None) -> DataFrame:
        """All sites of a version, the latest by default."""
        manifest = self.manifest(version)
        found = self._load(manifest)
        if found is None:
            raise ValueError(f"{self.root} holds no sites")
        return found

    def touched(self, domains: DataFrame) -> list[int]:
        """The buckets that domains belong to."""
        rows = domains.select(self._bucket(self.manifest()["buckets"]).alias("bucket")).distinct().collect()  # at most all buckets
        return sorted(r["bucket"] for r in rows)

    def lookup(self, domains: DataFrame) -> DataFrame | None:
        """The stored sites of some domains; only their buckets are read."""
        found = self._load(self.manifest(), self.touched(domains))
        return None if found is None else found.join(domains.select("domain").distinct(), "domain", "left_semi")

    def upsert(self, sites: DataFrame, version: str = "version", notes: dict | None = None, onto: int | None = None) -> int:
        """Store new sites; one of a domain replaces an older or equally old one. Returns the version committed.

        `sites` is read several times, so pass a stored table. Stored rows are only compared by domain and
        version; columns that one side lacks are null there. Rows with a blank domain are dropped.
        `notes` are small facts that the manifest keeps with the sites; those of the version before stay where
        they aren't named. If they were worked out from a version, `onto` (0 for none), another run's commit on it raises.
        """
        before = self.manifest(onto)
        new = latest_stored(sites, "domain", version)
        touched = self.touched(new)
        number = ((self.versions() or [0])[-1] if onto is None else onto) + 1
        if not touched:
            return number - 1
        merged, old = new, self._load(before, touched)
        if old is not None:
            at = F.struct(F.col(version).isNotNull(), F.col(version))  # a null version is the oldest
            theirs, mine = new.select("domain", at.alias("_new")), old.select("domain", at.alias("_old"))
            stay = old.join(theirs, "domain", "left").where(F.col("_new").isNull() | (at > F.col("_new"))).drop("_new")
            come = new.join(mine, "domain", "left").where(F.col("_old").isNull() | (F.col("_old") <= at)).drop("_old")
            merged = stay.unionByName(come, allowMissingColumns=True)
        folder = f"{number}-{uuid.uuid4().hex}"
        merged.withColumn("bucket", self._bucket(before["buckets"])).repartition(len(touched), "bucket") \
            .write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        self._commit(number, {"buckets": before["buckets"], "schema": merged.schema.jsonValue(),
                              "held": before["held"] | {str(b): folder for b in touched},
                              "notes": before.get("notes", {}) | (notes or {})})
        return number

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the last versions and the buckets that only they use. Not while an update or an older reader runs."""
        known = self.versions()
        used = {(f, f"bucket={b}") for v in known[-keep:] for b, f in self.manifest(v)["held"].items()}
        for version in known[:-keep]:
            self._files.delete(self._path(f"manifest/{version}.json"), False)
        for folder in self._files.listStatus(self._path("data")) if known else []:
            name = folder.getPath().getName()
            kept = {b for f, b in used if f == name}
            gone = [f.getPath() for f in self._files.listStatus(folder.getPath()) if f.getPath().getName() not in kept]
            for path in gone if kept else [folder.getPath()]:
                self._files.delete(path, True)
