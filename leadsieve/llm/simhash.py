"""SimHash near-duplicates: fingerprints of three-word shingles, linked through an inverted index of byte positions.

Of two fingerprints of eight bytes that differ in at most three bits, at least five bytes are equal at their position.
So the two share all of one of eight chosen sets of three positions: any five of eight positions hold one of these sets
whole. A list of the index holds the fingerprints with the same bytes at one such set of positions; a list of one
position alone would hold a 256th of all. Of the pairs in a list, the equal positional bytes are tallied, pairs with
fewer than five left out, and the bits of the rest compared. Equal fingerprints are one entry from the first step on.
Large lists are cut into blocks, and pairs of blocks are units of bounded size; out of a unit comes one row per
fingerprint, the smallest it is connected to, not its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsieve.llm.common import staged, whole
from leadsieve.llm.components import components
from leadsieve.llm.pieces import slices

WORDS = 3
SEED = 42
BITS = 3
BYTES = 8
#: Equal bytes of linked fingerprints at least: each differing bit spoils one byte at most.
EQUAL = BYTES - BITS
#: Fingerprints of a block at most.
BLOCK = 1024
#: Shingles hashed at once.
STEP = 4096
#: Parts of equal documents that take their group's result as one row each.
PARTS = 64


def position_sets() -> list[tuple[int, ...]]:
    """Sets of three positions of which any five positions hold one whole.

    The least number of such sets is eight. Positions lie in two halves of four; five positions have three at least in one
    half, and each half's four sets are all it has.
    """
    return [s for half in (range(4), range(4, 8)) for s in itertools.combinations(half, 3)]


def fingerprint64(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Bit k is 1 if it is 1 in over half of the shingles' hashes, repeats included; a text without words has 0."""
    found = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    n = min(words, len(found))
    shingles = map(b" ".join, zip(*(found[k:] for k in range(n)), strict=False))
    hashes, count, total = map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.zeros(64, dtype=np.int64), 0
    while len(part := np.fromiter(itertools.islice(hashes, STEP), dtype="<u8")):
        count += np.unpackbits(part.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """part, doc_id, print (the fingerprint as a signed number) of each document."""
    import pyarrow as pa
    narrow = docs.select(F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"), F.col(doc_id).alias("doc_id"),
                         whole(text).alias("text"))
    schema = T.StructType([*narrow.schema.fields[:2], T.StructField("print", T.LongType())])

    def run(batches):
        for batch in slices(batches):
            made = np.fromiter((fingerprint64(t, words, seed) for t in batch.column(2).to_pylist()), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made.view(np.int64))], names=schema.names)

    return narrow.mapInArrow(run, schema)


def _postings(prints: DataFrame) -> DataFrame:
    """set, key (the bytes at the set's positions), print."""
    masks = [sum(0xFF << 8 * p for p in s) for s in position_sets()]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return prints.select("print", F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in signed])).alias("set", "key"))


def _units(prints: DataFrame, block: int) -> DataFrame:
    """Members of each pair of blocks of a list. Lists with the same members count once; lists of one link nothing."""
    postings = _postings(prints)
    mark = F.xxhash64("print")
    lists = postings.groupBy("set", "key").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(mark).alias("marks"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("more"))
    lists = staged(lists.filter("members > 1").groupBy("members", "marks", "more")
                   .agg(F.min(F.struct("set", "key")).alias("at")).select("at.*", "members"), "lists")
    members = postings.join(lists, ["set", "key"]).withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("print", "set"), F.col("blocks")).cast("int"))
    return members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "set", "key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "print")


def linked(prints: np.ndarray, bits: int = BITS, equal: int = EQUAL) -> np.ndarray:
    """For each fingerprint of a unit, the smallest one it is connected to through links within the unit."""
    prints = np.sort(prints)
    links = [np.zeros((0, 2), dtype=np.int64)]
    for at in range(0, len(prints), 64):
        apart = prints[at:at + 64, None] ^ prints[None, :]
        tally = (apart.view(np.uint8).reshape(*apart.shape, BYTES) == 0).sum(axis=2)
        a, b = np.nonzero(tally >= equal)
        near = np.bitwise_count(apart[a, b]) <= bits
        links.append(np.stack([a[near] + at, b[near]], axis=1))
    a, b = np.concatenate(links).T
    label = np.arange(len(prints))
    while True:
        after = label.copy()
        np.minimum.at(after, a, label[b])
        after = after[after]
        if (after == label).all():
            return np.stack([prints, prints[label]])
        label = after


def _links(units: DataFrame) -> DataFrame:
    """a, b: fingerprints and the smallest other one each is connected to within a unit."""
    import pyarrow as pa
    unit = ("set", "key", "left", "right")

    def rows(members: list[int]) -> np.ndarray:
        found = linked(np.array(members, dtype=np.int64).view(np.uint64)).view(np.int64)
        return found[:, found[0] != found[1]]

    def run(batches) -> Iterator[pa.RecordBatch]:
        flat = (r for batch in slices(batches, 4096)
                for r in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True))
        for _, group in itertools.groupby(flat, key=lambda r: r[:4]):
            members = [r[4] for r in group]  # of two blocks
            if len(members) > 1 and (found := rows(members)).shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "a long, b long")


def group_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED,
               block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most BITS bits are linked, and so are chains of them; component_id is the
    smallest id of all documents connected, null only where none of them has an id. Null text is empty text. Texts without
    words (null, empty, white space) have fingerprint 0 and are linked like any other; texts of fewer words than a shingle
    are one shingle. Repeated rows and null ids stay rows; other columns are ignored. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, doc_id, text, words, seed), "fingerprints")
    # Equal ones fold in each part first, so that a fingerprint that many documents have is no hot key.
    local = staged(rows.groupBy("part", "print").agg(F.min("doc_id").alias("least")), "distinct")
    prints = local.groupBy("print").agg(F.min("least").alias("least"))
    classes = components(_links(_units(prints.select("print"), block)))
    named = prints.join(classes.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("label", "print").alias("label"))
    heads = named.groupBy("label").agg(F.min("least").alias("component_id"))
    told = local.select("part", "print").join(named.select("print", "label").join(heads, "label"), "print")
    return rows.join(told.select("part", "print", "component_id"), ["part", "print"]).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
