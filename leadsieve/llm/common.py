"""What several operators need: folders all executors share, staged tables, row filters by identity."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group of texts.
ROW_GROUP = 8 << 20

_made: list[tuple[str, str]] = []
_named: list[tuple[str, str]] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session without that setting gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="leadsieve-")
        spark.conf.set("spark.checkpoint.dir", root)
    folder = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append((spark.sparkContext.applicationId, folder))
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table once into the shared folder and read it from there: cuts lineage, survives lost executors."""
    folder = shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bucketed(df: DataFrame, label: str, by: str) -> DataFrame:
    """`staged`, in buckets by a column of which each task holds one value: a join by it moves none of these rows.

    Spark keeps buckets of named tables alone, so the folder gets a name, which `release` drops. Row groups are small:
    a reader takes a column of one of them at once, in memory outside the heap.
    """
    spark = df.sparkSession
    name, folder = f"{label}_{uuid.uuid4().hex}", shared_folder(spark, label)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", folder).option("parquet.block.size", ROW_GROUP).bucketBy(buckets, by).saveAsTable(name)
    _named.append((spark.sparkContext.applicationId, name))
    return spark.table(name)


def release(spark: SparkSession) -> None:
    """Delete the staged tables of this session; call it once the results made from them are written."""
    for entry in [n for n in _named if n[0] == spark.sparkContext.applicationId]:
        spark.sql(f"DROP TABLE IF EXISTS {entry[1]}")
        _named.remove(entry)
    mine = [m for m in _made if m[0] == spark.sparkContext.applicationId]
    for entry in mine:
        path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _made.remove(entry)


def whole(text) -> F.Column:
    """A text column with null as empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fingerprint(text) -> F.Column:
    """32 bytes that stand for a text exactly as it is."""
    return F.unhex(F.sha2(whole(text), 256))


def keep_rows(docs: DataFrame, keepers: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of docs, all columns as they are, that keepers name by (doc_id, print, same).

    print is the text's fingerprint and same the number of rows of docs with this id and text. Where that is over 1,
    one of these rows stays; it is chosen by an aggregate that folds in every task, so that many of them meet nowhere.
    """
    # The row travels as one column, so that no name of its columns meets one of ours.
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                         fingerprint(F.col(f"`{text}`")).alias("print"))
    named = keepers.select(F.col("doc_id").alias("k_id"), F.col("print").alias("k_print"), "same")
    stay = marked.join(named, marked["id"].eqNullSafe(named["k_id"]) & (marked["print"] == named["k_print"]))
    repeated = stay.filter("same > 1").groupBy("id", "print").agg(F.first("row").alias("row"))
    return stay.filter("same = 1").select("row.*").unionByName(repeated.select("row.*"))
