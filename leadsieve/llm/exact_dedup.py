"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame functions only.

Every input partition belongs to one of RADIX**ROUNDS runs. In a round, each run hands its digests to the RADIX runs
that differ from it in one digit of their number: the digit is replaced by a digit of the digest, and equal digests that
meet are merged into the one with the best identifier. After the last round a run holds one slice of the digest space, so
no task ever holds all digests, and a digest with very many copies has at most one row in each run of a round.

Digests are SHA-256 of the normalised text. What merges must also agree in length and in a second, unrelated hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import keep_rows, staged, whole

RADIX = 8
ROUNDS = 3
#: Texts are compared without these characters.
SPACES = r"[\x20\x09-\x0D]+"
KEY = ("digest", "plain_bytes", "proof")


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radix: int = RADIX,
                rounds: int = ROUNDS) -> DataFrame:
    """One narrow row per document: run, row, doc_id, points (code points), print, digest, plain_bytes, proof."""
    plain = docs.select(
        F.pmod(F.spark_partition_id(), F.lit(radix ** rounds)).alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"), whole(text).alias("text"),
        F.regexp_replace(whole(text), SPACES, "").alias("plain"))
    return plain.select(
        "run", "row", "doc_id", F.length("text").alias("points"), F.unhex(F.sha2("text", 256)).alias("print"),
        F.unhex(F.sha2("plain", 256)).alias("digest"), F.octet_length("plain").alias("plain_bytes"),
        F.xxhash64("plain").alias("proof"))


def _merged(rows: DataFrame, node: F.Column) -> DataFrame:
    return (rows.withColumn("node", node).groupBy("node", *KEY)
            .agg(F.min("best").alias("best"), F.sum("n").alias("n")))


def merge_runs(rows: DataFrame, radix: int = RADIX, rounds: int = ROUNDS) -> DataFrame:
    """One row per digest: the best identifier among all rows (most code points, then smallest id) and the count."""
    best = F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id"), F.col("print"), F.col("row"))
    runs = _merged(rows.withColumns({"best": best, "n": F.lit(1).cast("long")}), F.col("run"))
    for k in range(rounds):
        place = radix ** k
        own = F.floor(F.col("node") / place) % radix
        given = F.pmod(F.floor(F.pmod(F.xxhash64("digest"), F.lit(radix ** rounds)) / place), F.lit(radix))
        runs = _merged(runs, (F.col("node") + (given - own) * place).cast("int"))
    return runs.drop("node")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radix: int = RADIX,
                rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, print (of the text as it is).

    Texts are equal when equal without the characters of SPACES. The row with most code points stays, then the smallest
    id (a null id comes last), then the smallest fingerprint of the text; of rows equal in all that, exactly one. Null
    text is empty text; empty texts form one group. Other columns are ignored, whatever their names. An empty table
    gives no rows.
    """
    rows = staged(digest_rows(docs, doc_id, text, radix, rounds), "digests")
    groups = merge_runs(rows, radix, rounds).withColumnRenamed("n", "group_size")
    # Back down: a run has one row per digest to fetch the group's result with, and documents take it from their run.
    local = rows.select("run", *KEY).distinct()
    told = local.join(groups, list(KEY)).select("run", *KEY, "best", "group_size")
    return rows.join(told, ["run", *KEY]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "print")


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, all columns as they are, whatever their names.

    Of equal texts the row that `deduplicate` keeps stays; of rows equal in id and text, one. Null text is empty text, null
    ids come last. An empty table gives no rows.
    """
    found = deduplicate(docs, doc_id, text).groupBy("doc_id", "print").agg(
        F.count(F.lit(1)).alias("same"), F.max("kept").alias("kept"))
    return keep_rows(docs, found.filter("kept"), doc_id, text)
