"""Interaction of filters: what each one removes in every order, from one pass over the texts.

A document fails some of the filters; that set is its mask. Documents are counted by part, mask and label, so a part has
at most 32 cells whatever its size. A walk over all subsets of filters in Gray-code order toggles one filter at a time:
each cell has a counter of active filters that it fails, and its documents join or leave the running survivors when the
counter leaves or reaches zero. The survivors of all 32 states are stored; the steps of all 120 orders are differences
of two of them.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import fingerprint, staged, whole

SPACES = r"[\x20\x09-\x0D]+"
#: Failure conditions by filter: of a text, its number of words and of distinct words. The last filter, COPIES, fails
#: documents whose text a smaller id has too.
CHECKS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "A": lambda text, words, distinct: words < 100,
    "B": lambda text, words, distinct: 100 * distinct < 80 * words,
    "C": lambda text, words, distinct: 100 * (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", "")))
    > 10 * F.length(text),
    "D": lambda text, words, distinct: text.rlike(r"[#$%&*|]"),
}
COPIES = "E"
#: What is counted of documents: all, of good quality, toxic.
COUNTS = ("n", "good", "toxic")


def failures(docs: DataFrame, doc_id: str, text: str, part: str, checks=CHECKS) -> DataFrame:
    """doc_id, print, part, mask (bit k: the k-th check fails), n: rows equal in all that."""
    own = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("print"),
                      F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole(text).alias("text"))
    words = own.withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    sizes = words.select("doc_id", "print", "part", "text", F.size("words").alias("words"),
                         F.size(F.array_distinct("words")).alias("distinct"))
    mask = F.lit(0)
    for k, fails in enumerate(checks.values()):
        mask = mask + F.when(fails(F.col("text"), F.col("words"), F.col("distinct")), 1 << k).otherwise(0)
    return (sizes.select("doc_id", "print", "part", mask.alias("mask"))
            .groupBy("doc_id", "print", "part", "mask").agg(F.count(F.lit(1)).alias("n")))


def cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
          checks=CHECKS) -> DataFrame:
    """part, mask (with COPIES as the highest bit), n, good, toxic: documents, and those with label quality or toxic 1.

    Rows that don't fail COPIES are those of a text's smallest id, found by an aggregate; all others are the rest, so that
    the rows of a very frequent text never meet in one place.
    """
    flags = (labels.select(F.col("doc_id").alias("l_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
             .filter("l_id is not null and (good or toxic)")
             .groupBy("l_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"),
                                  F.max(F.coalesce("toxic", F.lit(False))).alias("toxic")))
    rows = failures(docs, doc_id, text, part, checks)
    rows = staged(rows.join(flags, rows["doc_id"] == flags["l_id"], "left").select(
        "doc_id", "print", "part", "mask", "n", F.when(F.col("good"), F.col("n")).otherwise(0).alias("good"),
        F.when(F.col("toxic"), F.col("n")).otherwise(0).alias("toxic")), "failures")
    firsts = rows.groupBy("print").agg(F.min("doc_id").alias("least")).select(F.col("print").alias("f_print"), "least")
    sums = [F.sum(c).alias(c) for c in COUNTS]
    first = (rows.join(firsts, (rows["print"] == firsts["f_print"]) & rows["doc_id"].eqNullSafe(firsts["least"]), "left_semi")
             .groupBy("part", "mask").agg(*sums))
    all_rows = rows.groupBy("part", "mask").agg(*sums)
    minus = first.select("part", "mask", *[(-F.col(c)).alias(c) for c in COUNTS])
    copies = all_rows.unionByName(minus).groupBy("part", "mask").agg(*sums).withColumn("mask", F.col("mask") + (1 << len(checks)))
    return first.unionByName(copies).filter("n > 0")


def gray_walk(failing: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters: row s counts the documents of cells that fail no filter of the set bits of s."""
    states = np.zeros((1 << filters, counts.shape[1]), dtype=np.int64)
    active = np.zeros(len(failing), dtype=np.int64)
    survivors, subset = counts.sum(axis=0), 0
    states[0] = survivors
    for step in range(1, 1 << filters):
        k = (step & -step).bit_length() - 1  # the bit that changes in the Gray code
        subset ^= 1 << k
        hit = (failing >> k & 1) == 1
        if subset >> k & 1:
            survivors = survivors - counts[hit & (active == 0)].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            survivors = survivors + counts[hit & (active == 0)].sum(axis=0)
        states[subset] = survivors
    return states


def steps(failing: np.ndarray, counts: np.ndarray, names: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order of the filters."""
    states = gray_walk(failing, counts, len(names))
    fails = [int(counts[failing >> k & 1 == 1, 0].sum()) for k in range(len(names))]
    alone = [int(counts[failing == 1 << k, 0].sum()) for k in range(len(names))]
    rows, shapley = [], [0] * len(names)
    for order in itertools.permutations(range(len(names))):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            lost = states[before] - states[after]
            shapley[k] += int(lost[0])
            rows.append((order, step, k, int(states[after][0]), *map(int, lost)))
            before = after
    for order, step, k, kept, removed, good, toxic in rows:
        yield "".join(names[i] for i in order), step, kept, removed, fails[k] - removed, alone[k], good, toxic, shapley[k]


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
          checks=CHECKS) -> DataFrame:
    """One row per part, order of filters and step: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    Null text is empty text, which fails no share; a null part is the empty string. A document fails COPIES if its text
    belongs to a smaller id anywhere in the table; a null id is larger than every other. Rows equal in id and text fail
    alike. An id labelled twice has a label that one of its rows gives; labels without a document and null ids in labels
    count nothing. Very long texts count whole; other columns are ignored. An empty table gives no rows.
    """
    import pyarrow as pa
    names = "".join(checks) + COPIES
    fields = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
              "good_lost long, toxic_lost long, shapley long")
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    titles = [f.split()[0] for f in fields.split(", ")]
    cell = F.struct("mask", *COUNTS)
    parts = cells(docs, labels, doc_id, text, part, checks).groupBy("part").agg(F.collect_list(cell).alias("cells"))  # 32 at most

    def run(batches):
        for batch in batches:
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                failing = np.array([c["mask"] for c in own])
                counts = np.array([[c[k] for k in COUNTS] for c in own], dtype=np.int64)
                made = [(name, *row) for row in steps(failing, counts, names)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds, strict=True)],
                                                 names=titles)

    return parts.mapInArrow(run, fields)
