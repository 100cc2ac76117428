"""Lead tables in and out."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from leadsieve.operators.verdicts import qualified

SNIFF_BYTES = 64 * 1024
BOM = "﻿"


def _head(spark: SparkSession, file: str) -> str:
    """The first 64 KiB of a file as text, decompressed if its name ends like a known codec."""
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(spark._jvm.java.net.URI(file))
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        head = (codec.createInputStream(stream) if codec else stream).readNBytes(SNIFF_BYTES)
    finally:
        stream.close()
    return bytes(head).decode("utf-8", "ignore").lstrip(BOM)


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator of a CSV from the first 64 KiB of its first file, a comma if unclear."""
    sample = _head(spark, min(spark.read.text(path).inputFiles()))
    try:
        return csv.Sniffer().sniff(sample, delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def read_leads(spark: SparkSession, path: str, sep: str | None = None,
               multi_line: bool = True) -> DataFrame:
    """A header CSV as text columns; blanks are '' and row_idx is the input position.

    A quoted field may span lines, so each file is read by one task; pass many files,
    or multi_line=False where no field holds a line break, to read in parallel.
    """
    raw = spark.read.csv(path, header=True, sep=sep or sniff_separator(spark, path), quote='"',
                         escape='"', multiLine=multi_line, inferSchema=False,
                         encoding="UTF-8", ignoreLeadingWhiteSpace=False,
                         ignoreTrailingWhiteSpace=False)
    named = raw.toDF(*[c.lstrip(BOM).strip('"') if i == 0 else c for i, c in enumerate(raw.columns)])
    text = named.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in named.columns],
                        F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_start"))
    return index_scan(text, "_file", "_start")


def index_scan(scan: DataFrame, file: str, start: str) -> DataFrame:
    """Number the rows of a file scan in file order, without a shuffle of the rows.

    Rows of one split are in file order; only one count per split is exchanged.
    """
    placed = scan.withColumn("_id", F.monotonically_increasing_id())
    splits = placed.groupBy(file, start).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy(file, start).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(file, start, "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per file split; Spark's size check decides how they meet the rows.
    data = [f"`{c}`" for c in scan.columns if c not in (file, start)]
    return placed.join(offsets, [file, start]).select(
        (F.col("_id") - F.col("_first") + F.col("_before")).alias("row_idx"), *data)


_CSV = dict(header=True, quote='"', escape='"', emptyValue="", nullValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_qualified(merged: DataFrame, path: str, one_file: bool = False) -> None:
    """Deliver the merged leads as UTF-8 CSV with BOM, in input order over sorted files.

    `one_file` is for receivers that take a single file; one task then writes it all.
    """
    out = qualified(merged).orderBy("row_idx").drop("row_idx")
    marked = out.toDF(BOM + out.columns[0], *out.columns[1:])
    files = marked.coalesce(1) if one_file else marked
    files.write.mode("errorifexists").csv(path, **_CSV)
