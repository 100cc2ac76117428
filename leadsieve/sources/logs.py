"""Append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines; blank lines and lines that are no JSON are skipped, a missing path is empty.

    Fields are read as text and cast, so a value of another type is cast if it can be
    and null if not; its line stays.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    texts = StructType([StructField(f.name, StringType()) for f in fields])
    lines = spark.read.schema(texts).option("mode", "DROPMALFORMED").json(path)

    def typed(f: StructField) -> Column:
        text = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.from_json(text, f.dataType).alias(f.name)
        return text.try_cast(f.dataType).alias(f.name)

    return lines.select(*map(typed, fields))


def append_log(df: DataFrame, path: str, format: str = "json") -> None:
    """Append rows to a log folder."""
    df.write.mode("append").format(format).save(path)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet log; a missing path is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
