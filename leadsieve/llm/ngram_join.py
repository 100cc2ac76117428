"""Similarity join on Jaccard similarity of word n-grams: MinHash banding, then verification on the full n-gram sets.

Documents with the same set of n-grams are one set from the first step on; hot groups of copies fold there. Sets that
share the hash of a band meet in a bucket. Buckets with the same members count once. A large bucket is cut into blocks, and
each pair of blocks is a unit of work of bounded size, so a group of thousands of near copies is spread over many tasks.
A pair is verified in the first band it shares and nowhere else; out of a unit come one row per set, not its pairs: how
many documents it links to, and the smallest set it is connected to. Connected components of these give the classes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsieve.llm.common import fingerprint, keep_rows, staged, whole
from leadsieve.llm.components import components
from leadsieve.llm.pieces import Kept, slices

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
HASHES = 64
#: A block holds at most so many sets, and about so many n-grams.
BLOCK_SETS = 512
BLOCK_GRAMS = 1_000_000
#: n-grams hashed at once.
STEP = 2048


def bands_for(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest false candidates) whose bands reach the recall within so many hashes."""
    best = None
    for rows in range(1, hashes + 1):
        chance = similarity ** rows
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-chance))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing steps of a common integer hash)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word n-grams as sorted 64-bit hashes. Words are lower-cased runs without white space."""

    def __init__(self, words: int):
        self.words = words
        self.of_word = Kept(lambda w: xxhash.xxh3_64_intdigest(w))

    def grams(self, text: str) -> np.ndarray:
        """A text of fewer words than n has one n-gram, all its words; one without words has none."""
        found = text.lower().split()
        if not found:
            return np.zeros(0, dtype=np.uint64)
        hashes = np.fromiter(map(self.of_word.__getitem__, found), dtype=np.uint64, count=len(found))
        n = min(self.words, len(found))
        total = np.full(len(found) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(found) - n + 1 + k])
        return np.unique(total)


class Bander:
    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        seeds = np.random.default_rng(20240229).integers(1, 1 << 63, size=(2, bands * rows), dtype=np.uint64)
        self.times, self.plus = seeds[0] | np.uint64(1), seeds[1]

    def hashes(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(grams), STEP):
            part = grams[at:at + STEP, None] * self.times + self.plus
            np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
        out = np.zeros(self.bands, dtype=np.uint64)
        for column in _mix(least).reshape(self.bands, self.rows).T:
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
        return out.view(np.int64)


def _signed(docs: DataFrame, doc_id: str, text: str, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, print, set_id (of the n-gram set), grams (their number), bands (a hash each), per document."""
    import pyarrow as pa
    narrow = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("print"), whole(text).alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], *T.StructType.fromDDL(
        "print binary, set_id binary, grams long, bands array<long>").fields])

    def run(batches):
        shingler, bander = Shingler(words), Bander(bands, rows)
        for batch in slices(batches):
            ids, sizes, made = [], [], []
            for t in batch.column(2).to_pylist():
                grams = shingler.grams(t)
                ids.append(xxhash.xxh3_128_digest(grams.tobytes()))
                sizes.append(len(grams))
                made.append(bander.hashes(grams))
            flat = pa.array(np.concatenate(made))
            offsets = pa.array(np.arange(len(made) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, flat)], names=schema.names)

    return narrow.mapInArrow(run, schema)


def _grams_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """set_id and the n-gram set as bytes, for wanted (doc_id, print, set_id)."""
    import pyarrow as pa
    named = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("print"), whole(text).alias("text"))
    rows = named.join(wanted.withColumnsRenamed({"doc_id": "w_id", "print": "w_print"}),
                      named["doc_id"].eqNullSafe(F.col("w_id")) & (named["print"] == F.col("w_print"))).select("set_id", "text")

    def run(batches):
        shingler = Shingler(words)
        for batch in slices(batches):
            sets = [shingler.grams(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["set_id", "set"])

    return rows.mapInArrow(run, "set_id binary, set binary").groupBy("set_id").agg(F.first("set").alias("set"))


class _Unit:
    """Sets of one pair of blocks of a bucket."""

    def __init__(self, rows: list[dict], similarity: float):
        self.similarity = similarity
        self.ids = [r["set_id"] for r in rows]
        self.sets = [np.frombuffer(r["set"], dtype=np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in self.sets])
        self.copies = np.array([r["copies"] for r in rows])
        self.bands = np.array([r["bands"] for r in rows])
        self.band, self.sides = rows[0]["band"], np.array([r["block"] for r in rows])
        self.across = rows[0]["left"] != rows[0]["right"]

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each set, the later ones it links to: first shared band is this one, similar enough, in the other block."""
        _, codes = np.unique(np.concatenate(self.sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        present = np.zeros(codes.max() + 1, dtype=np.int32)
        for k in range(len(self.ids) - 1):
            rest = np.arange(k + 1, len(self.ids))
            if self.across:
                rest = rest[self.sides[rest] != self.sides[k]]
            small, large = np.minimum(self.sizes[rest], self.sizes[k]), np.maximum(self.sizes[rest], self.sizes[k])
            rest = rest[small >= self.similarity * large]
            rest = rest[~(self.bands[rest, :self.band] == self.bands[k, :self.band]).any(axis=1)]
            if not len(rest):
                continue
            own = codes[starts[k]:starts[k] + self.sizes[k]]
            present[own] = 1
            if len(rest) < 8:
                shared = np.array([present[codes[starts[j]:starts[j] + self.sizes[j]]].sum() for j in rest])
            else:
                shared = np.add.reduceat(present[codes], starts)[rest]
            present[own] = 0
            yield k, rest[shared >= self.similarity * (self.sizes[rest] + self.sizes[k] - shared)]

    def rows(self) -> Iterator[tuple[bytes, bytes, int]]:
        """set_id, smallest set it is connected to here, documents linked here; sets without link are left out."""
        root, linked = list(range(len(self.ids))), np.zeros(len(self.ids), dtype=np.int64)

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for k, found in self.links():
            linked[k] += self.copies[found].sum()
            linked[found] += self.copies[k]
            for j in found:
                a, b = top(k), top(int(j))
                if a != b:
                    root[max(a, b)] = min(a, b)
        least: dict[int, bytes] = {}
        for k in range(len(self.ids)):
            if linked[k]:
                least[top(k)] = min(least.get(top(k), self.ids[k]), self.ids[k])
        for k in range(len(self.ids)):
            if linked[k]:
                yield self.ids[k], least[top(k)], int(linked[k])


def _verified(units: DataFrame, similarity: float) -> DataFrame:
    import pyarrow as pa
    key = ("band", "hash", "left", "right")

    def run(batches):
        rows = itertools.chain.from_iterable(b.to_pylist() for b in slices(batches))
        out = []
        for _, group in itertools.groupby(rows, key=lambda r: tuple(r[k] for k in key)):
            members = list(group)  # of two blocks
            if len(members) > 1:
                out += _Unit(members, similarity).rows()
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "linked"), o, strict=True)) for o in out])
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "linked"), o, strict=True)) for o in out])

    return (units.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "a binary, b binary, linked long"))


def _units(sets: DataFrame, buckets: DataFrame, grams: DataFrame, block_sets: int, block_grams: int) -> DataFrame:
    """Members of each pair of blocks of a bucket, with their n-grams."""
    members = sets.select("set_id", "copies", "bands", F.posexplode("bands").alias("band", "hash"))
    members = members.join(buckets.select("band", "hash", "members", "grams"), ["band", "hash"])
    blocks = F.greatest(F.ceil(F.col("members") / block_sets), F.ceil(F.col("grams") / block_grams)).cast("int")
    members = members.withColumn("blocks", F.least(blocks, F.col("members").cast("int"))).withColumn(
        "block", F.pmod(F.xxhash64("set_id", "band"), F.col("blocks")).cast("int"))
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "set_id", "copies", "bands", "band", "hash", "block",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"))
    return pairs.join(grams, "set_id")


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY,
         recall: float = RECALL, block_sets: int = BLOCK_SETS, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_id, n_copies, print.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams is at least `similarity`; the chance
    that a pair right at that bound is found is at least `recall`, and higher above it. n_links is the number of other
    documents a document is linked to. class_id is the smallest id of all documents connected by links, copy_id the
    smallest with the very same set, n_copies their number. Documents without words (null, empty, white space) have the
    same, empty set. Null ids come last; repeated rows stay rows. Columns besides the two are ignored. An empty table
    gives no rows.
    """
    return _classed(docs, doc_id, text, words, similarity, recall, block_sets, block_grams).drop("label")


def _classed(docs: DataFrame, doc_id: str, text: str, words: int = WORDS, similarity: float = SIMILARITY,
             recall: float = RECALL, block_sets: int = BLOCK_SETS, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """As link, and label: the class itself, which an id that several classes share doesn't tell."""
    bands, rows = bands_for(similarity, recall)
    signed = staged(_signed(docs, doc_id, text, words, bands, rows), "signatures")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print"))
    sets = staged(signed.groupBy("set_id").agg(
        F.count(F.lit(1)).alias("copies"), least.alias("least"), F.first("grams").alias("grams"),
        F.first("bands").alias("bands")), "sets")
    mark = F.xxhash64("set_id")
    buckets = (sets.filter("grams > 0").select("set_id", "grams", F.posexplode("bands").alias("band", "hash"))
               .groupBy("band", "hash")
               .agg(F.count(F.lit(1)).alias("members"), F.sum("grams").alias("grams"),
                    F.bit_xor(mark).alias("marks"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("more"))
               .filter("members > 1"))
    buckets = staged(buckets.groupBy("members", "grams", "marks", "more")
                     .agg(F.min(F.struct("band", "hash")).alias("at")).select("members", "grams", "at.*"), "buckets")
    met = sets.select("set_id", "least", F.posexplode("bands").alias("band", "hash")).join(
        buckets.select("band", "hash"), ["band", "hash"], "left_semi").groupBy("set_id").agg(F.first("least").alias("least"))
    grams = _grams_of(docs, met.select("least.doc_id", "least.print", "set_id"), doc_id, text, words)
    found = staged(_verified(_units(sets, buckets, grams, block_sets, block_grams), similarity), "links")
    classes = components(found.select("a", "b"))
    linked = found.groupBy("a").agg(F.sum("linked").alias("linked")).withColumnRenamed("a", "set_id")
    known = sets.select("set_id", "copies", F.col("least.doc_id").alias("copy_id")).join(linked, "set_id", "left").join(
        classes.withColumnRenamed("node", "set_id"), "set_id", "left")
    heads = known.filter("label is not null").groupBy("label").agg(F.min("copy_id").alias("head"))
    known = known.join(heads, "label", "left").select(
        "set_id", "copy_id", F.col("copies").alias("n_copies"), F.coalesce("head", "copy_id").alias("class_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "set_id").alias("label"))
    return signed.select("doc_id", "print", "set_id").join(known, "set_id").select(
        "doc_id", "class_id", "n_links", "copy_id", "n_copies", "print", "label")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of docs without those of a class that isn't its head: the row with the class's smallest id stays.

    Of several texts with that id in one class, the one with the smallest fingerprint stays, once.
    """
    found = staged(_classed(docs, doc_id, text, **how), "classes")
    same = found.groupBy("label", "doc_id", "print").agg(F.count(F.lit(1)).alias("same"))
    heads = same.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print", "same")).alias("best"))
    return keep_rows(docs, heads.select("best.doc_id", "best.print", "best.same"), doc_id, text)
