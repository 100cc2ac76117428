"""Logs whose batches count once, and the commit files that tell which do."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from leadsieve.sources.logs import path_exists

RECORD = "run string, batch bigint, folder string, covers array<string>"
#: The run that commits of `compact` belong to.
COMPACTION = ""


class Taken(RuntimeError):
    """Another run has committed under this name."""


def put_once(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all; an existing one is not replaced, which raises `Taken`."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    final = hadoop.Path(path)
    draft = hadoop.Path(final.getParent(), f".{uuid.uuid4().hex}")
    files = final.getFileSystem(conf)
    files.mkdirs(final.getParent())
    stream = files.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(final.toUri(), conf).rename(draft, final, options)
    except Exception as error:
        files.delete(draft, False)
        if files.exists(final):
            raise Taken(path) from error
        raise


class BatchLog:
    """A log that is appended to in batches, each of which counts once.

    A batch is known by its run and its number. Its rows go to a folder of their own; then a commit record,
    which no second one can replace, names that folder. Readers follow the records, so neither parts of a
    lost run nor a repeated batch are ever read.

    Layout: `commits/<run>~<batch>.json`, `parts/<folder>/`.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | str):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _record(self, run: str, batch: int) -> str:
        return f"{self.root}/commits/{quote(run, safe='')}~{batch}.json"

    def _records(self):
        """All commit records, one short line for each batch."""
        if not path_exists(self.spark, f"{self.root}/commits"):
            return []
        return self.spark.read.schema(RECORD).json(f"{self.root}/commits").collect()

    def holds(self, run: str, batch: int) -> bool:
        """Whether a batch is committed."""
        return path_exists(self.spark, self._record(run, batch))

    def append(self, rows: DataFrame, run: str, batch: int = 0) -> bool:
        """Store a batch and commit it; False, and nothing stored, if it was committed before."""
        if not run:
            raise ValueError("a run needs a name")
        return self._append(rows, run, batch, [])

    def _append(self, rows: DataFrame, run: str, batch: int, covers: list[str]) -> bool:
        if self.holds(run, batch):
            return False
        folder = uuid.uuid4().hex
        rows.select(*[f"`{f.name}`" for f in self.schema]).write.parquet(f"{self.root}/parts/{folder}")
        try:
            put_once(self.spark, self._record(run, batch),
                     json.dumps({"run": run, "batch": batch, "folder": folder, "covers": covers}))
        except Taken:
            self._drop(folder)
            return False
        return True

    def append_stream(self, rows: DataFrame, run: str, checkpoint: str) -> StreamingQuery:
        """Append what a streaming table has now, batch by batch; a replayed batch adds nothing."""
        return rows.writeStream.foreachBatch(lambda part, number: self.append(part, run, number) and None) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def _live(self, records) -> list[str]:
        covered = {f for r in records for f in r["covers"] or []}
        return sorted(r["folder"] for r in records if r["folder"] not in covered)

    def read(self) -> DataFrame:
        """The rows of all committed batches."""
        live = self._live(self._records())
        if not live:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/parts/{f}" for f in live])

    def read_batches(self, run: str, after: int = -1) -> DataFrame:
        """The rows of a run's batches above a number, for readers that follow the log.

        A batch whose folder `vacuum` has deleted can't be told from others any more, which raises.
        """
        wanted = [r for r in self._records() if r["run"] == run and r["batch"] > after]
        gone = [r["batch"] for r in wanted if not path_exists(self.spark, f"{self.root}/parts/{r['folder']}")]
        if gone:
            raise ValueError(f"batches {gone} of {run} are merged with others")
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/parts/{r['folder']}" for r in wanted])

    def compact(self) -> bool:
        """Write the rows of all batches so far into one folder that stands for theirs.

        Records stay, so their batches are still known as committed; batches that come meanwhile are read beside it.
        """
        records = self._records()
        live = self._live(records)
        number = max((r["batch"] for r in records if r["run"] == COMPACTION), default=-1) + 1
        if len(live) < 2:
            return False
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/parts/{f}" for f in live])
        return self._append(rows, COMPACTION, number, live)

    def vacuum(self) -> None:
        """Delete folders that no reader of today follows. Not while an append or an older reader runs."""
        live = set(self._live(self._records()))
        parts = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/parts")
        files = parts.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in files.listStatus(parts) if files.exists(parts) else []:
            if found.getPath().getName() not in live:
                self._drop(found.getPath().getName())

    def _drop(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/parts/{folder}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
