"""Approximate nearest neighbours by cross-polytope hashing with multiprobe, and exact reranking.

A table rotates vectors by three rounds of random signs and fast Hadamard transforms and hashes each to the signed axis
nearest to it; `hashes` of these make a bucket. For largest inner products vectors are first put on a sphere by one more
component, so that the nearest axis depends on direction and length alike; each range of lengths has a sphere of its own,
so that a few long vectors don't push all others to the extra axis. A query looks into the buckets of its nearest
axes in every table, and at every vector of a range that holds only a few. Where they meet, inner products are exact.
Queries that find fewer than the limit that way meet all vectors. Buckets are cut into blocks of bounded size on both
sides, whose pairs are independent units of work; nothing is capped.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadsieve.llm.common import staged

TABLES = 10
PROBES = 20
#: Axes that make a bucket; a bucket holds about rows / (2 * dimension) ** hashes vectors.
HASHES = 1
#: Lengths of one range differ by this factor at most; ranges of so few vectors aren't hashed.
RANGE = 1.1
SCANNED = 1024
VECTORS_IN_BLOCK = 4096
QUERIES_IN_BLOCK = 1024
SEED = 20240301
#: Candidates beyond the limit that are scored exactly in a block.
SPARE = 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (their length a power of two), scaled to keep lengths."""
    x, n, step = x.copy(), x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Length of each row (rows x 1); squares of very large or small components stay within a double."""
    most = np.abs(vectors).max(axis=1, keepdims=True)
    return most * np.linalg.norm(vectors / most, axis=1, keepdims=True)


class Tables:
    """The rotations of all tables for vectors of one dimension; largest: the length of the longest vector."""

    def __init__(self, dimension: int, largest: float, tables: int, hashes: int, seed: int = SEED):
        self.size = 1 << int(np.ceil(np.log2(dimension + 1))) if dimension & (dimension - 1) or dimension < 2 else dimension
        self.dimension, self.largest, self.hashes = dimension, largest, hashes
        if self.size == dimension:  # one more component would double a power of two; it takes the place of a sum instead
            self.size = dimension * 2
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, hashes, 3, self.size))

    def on_sphere(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(vectors), self.size))
        own = lengths(vectors)
        out[:, :self.dimension] = vectors / own
        if not query:  # on the sphere of its range, whose radius is the longest a vector of the range can be
            steps = np.maximum(0, (np.log(self.largest) - np.log(own)) / np.log(RANGE))
            out[:, :self.dimension] *= RANGE ** (np.floor(steps) - steps)
            out[:, self.dimension] = np.sqrt(np.maximum(0, 1 - (out ** 2).sum(axis=1)))
        return out

    def axes(self, placed: np.ndarray, table: int, hash_: int) -> np.ndarray:
        """Nearness of each row to each of the 2 x size signed axes."""
        for signs in self.signs[table, hash_]:
            placed = hadamard(placed * signs)
        return np.concatenate([placed, -placed], axis=1)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket of each row (rows x tables)."""
        placed = self.on_sphere(vectors, query=False)
        out = np.zeros((len(vectors), len(self.signs)), dtype=np.int64)
        for t, h in itertools.product(range(len(self.signs)), range(self.hashes)):
            out[:, t] = out[:, t] * 2 * self.size + self.axes(placed, t, h).argmax(axis=1)
        return out

    def probes(self, queries: np.ndarray, count: int) -> np.ndarray:
        """The buckets nearest to each row (rows x tables x count, or all buckets if there are fewer)."""
        count = min(count, (2 * self.size) ** self.hashes)
        placed = self.on_sphere(queries, query=True)
        out = np.zeros((len(queries), len(self.signs), count), dtype=np.int64)
        for t in range(len(self.signs)):
            near, bucket = np.zeros((len(queries), 1)), np.zeros((len(queries), 1), dtype=np.int64)
            for h in range(self.hashes):
                axes = self.axes(placed, t, h)
                best = np.argsort(-axes, axis=1, kind="stable")[:, :count]
                near = (near[:, :, None] + np.take_along_axis(axes, best, axis=1)[:, None, :]).reshape(len(queries), -1)
                bucket = (bucket[:, :, None] * 2 * self.size + best[:, None, :]).reshape(len(queries), -1)
                keep = np.argsort(-near, axis=1, kind="stable")[:, :count]
                near, bucket = np.take_along_axis(near, keep, axis=1), np.take_along_axis(bucket, keep, axis=1)
            out[:, t] = bucket
        return out


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, each pair once."""
    own = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), own.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    whole = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(whole & F.exists("vector", lambda x: x != 0)).distinct()


def _hashed(rows: DataFrame, tables: Tables, probes: int) -> DataFrame:
    """vec_id, vector as bytes, table, bucket; probes 0: of a stored vector, else of a query."""
    import pyarrow as pa
    sent = rows.sparkSession.sparkContext.broadcast(tables)  # signs only

    def run(batches):
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 512):
                batch = whole_batch.slice(at, 512)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                made = sent.value.probes(flat, probes) if probes else sent.value.buckets(flat)[:, :, None]
                each = made.shape[1] * made.shape[2]
                ids = np.repeat(batch.column(0).to_numpy(), each)
                shown = [v.tobytes() for v in flat]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array([s for s in shown for _ in range(each)], pa.binary()),
                     pa.array(np.tile(np.repeat(np.arange(made.shape[1], dtype=np.int32), made.shape[2]), len(flat))),
                     pa.array(made.reshape(-1))], names=["vec_id", "vector", "table", "bucket"])

    return rows.select("vec_id", "vector").mapInArrow(run, "vec_id long, vector binary, table int, bucket long")


def _whole(rows: DataFrame) -> DataFrame:
    """As _hashed, with all rows in one bucket of a table of its own."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in flat], pa.binary())],
                                             names=["vec_id", "vector"])

    return rows.select("vec_id", "vector").mapInArrow(run, "vec_id long, vector binary").select(
        "vec_id", "vector", F.lit(-1).alias("table"), F.lit(0).cast("long").alias("bucket"))


def _in_blocks(own: DataFrame, sizes: DataFrame, mine: str, other: str) -> DataFrame:
    """A row's block by its id, next to every block of the other side."""
    return (own.join(sizes, ["table", "bucket"])
            .withColumn(mine, F.pmod(F.xxhash64("vec_id"), F.col(f"{mine}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("vblocks", "qblocks"))


def _nearest(limit: int):
    def run(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if stored.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        v = np.frombuffer(b"".join(stored["vector"]), dtype=np.float64).reshape(len(stored), -1)
        q = np.frombuffer(b"".join(asked["vector"]), dtype=np.float64).reshape(len(asked), -1)
        ids, names, out = stored["vec_id"].to_numpy(), asked["vec_id"].to_numpy(), []
        products = q @ v.T
        products[names[:, None] == ids[None, :]] = -np.inf
        # The order of summation moves the last digits: a few more than the limit are scored anew, and where the last of
        # them still ties with the limit, all of that row.
        few, repeated = min(limit + SPARE, len(ids)), len(np.unique(ids)) < len(ids)
        near = np.argpartition(-products, few - 1, axis=1)[:, :few]
        rough = -np.sort(-np.take_along_axis(products, near, axis=1), axis=1)
        scores = np.where(np.take_along_axis(products, near, axis=1) == -np.inf, -np.inf,
                          (v[near] * q[:, None, :]).sum(axis=2))
        for k in range(len(q)):
            at, score = near[k], scores[k]
            if repeated:  # a row per id, its best
                at = np.flatnonzero(products[k] > -np.inf)
                score = (v[at] * q[k]).sum(axis=1)
                order = np.lexsort((ids[at], -score))
                at, score = at[order], score[order]
                firsts = np.sort(np.unique(ids[at], return_index=True)[1])
                at, score = at[firsts], score[firsts]
            elif few > limit and rough[k, -1] > -np.inf and rough[k, limit - 1] - rough[k, -1] < 1e-9 * (1 + abs(rough[k, -1])):
                at = np.flatnonzero(products[k] > -np.inf)
                score = (v[at] * q[k]).sum(axis=1)
            best = np.lexsort((ids[at], -score))[:limit]
            best = best[score[best] > -np.inf]
            out.append((np.full(len(best), names[k]), ids[at][best], score[best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return run


def _met(stored: DataFrame, probed: DataFrame, limit: int, vectors_in_block: int, queries_in_block: int) -> DataFrame:
    """query_id, vec_id, score: at least the nearest `limit` of each query among the rows of its buckets."""
    count = lambda own, block: F.ceil(F.count(F.lit(1)) / block).cast("int").alias(own)
    sizes = stored.groupBy("table", "bucket").agg(count("vblocks", vectors_in_block)).join(
        probed.groupBy("table", "bucket").agg(count("qblocks", queries_in_block)), ["table", "bucket"])
    sizes = staged(sizes, "sizes")
    key = ["table", "bucket", "vblock", "qblock"]
    left, right = _in_blocks(stored, sizes, "vblock", "qblock"), _in_blocks(probed, sizes, "qblock", "vblock")
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _nearest(limit), "query_id long, vec_id long, score double")
    return near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))


def search(vectors: DataFrame, queries: DataFrame, limit: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           tables: int = TABLES, probes: int = PROBES, hashes: int = HASHES, vectors_in_block: int = VECTORS_IN_BLOCK,
           queries_in_block: int = QUERIES_IN_BLOCK, scanned: int = SCANNED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest rows of vectors found for each row of queries.

    Nearest means the largest inner product, in double precision; ties go to the smaller vec_id. Rows with the query's own
    id aren't its neighbours. Null ids, null vectors, vectors that are zero or hold null or non-finite components, and
    those whose length isn't the most common one take no part. Repeated rows count once; two vectors under one id are
    two rows, of which a query reports the nearer. Other columns are ignored. Empty tables give no rows.
    """
    rows = staged(usable(vectors, vec_id, vector), "vectors")
    most = F.array_max(F.transform("vector", F.abs))
    rows = rows.withColumn("most", most).withColumn(
        "length", F.col("most") * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(x / F.col("most"), 2))))
    shape = (rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("most"))
             .orderBy(F.desc("n"), "d").first())
    spark = vectors.sparkSession
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    made = Tables(shape["d"], shape["most"] * (1 + 1e-12), tables, hashes)
    steps = (F.log(F.lit(made.largest)) - F.log("length")) / float(np.log(RANGE))
    rows = rows.filter(F.size("vector") == shape["d"]).withColumn("range", F.greatest(F.lit(0), F.floor(steps).cast("int")))
    asked = staged(usable(queries, vec_id, vector).filter(F.size("vector") == shape["d"]), "queries")
    ranges = rows.groupBy("range").count().collect()  # a range per step of the lengths' logarithm
    short = [r["range"] for r in ranges if r["count"] <= scanned]
    hashed = len(short) < len(ranges)
    stored, probed = [], []
    if hashed:
        stored.append(_hashed(rows.filter(~F.col("range").isin(short)), made, 0))
        probed.append(_hashed(asked, made, probes))
    if short:
        stored.append(_whole(rows.filter(F.col("range").isin(short))))
        probed.append(_whole(asked))
    stored = staged(functools.reduce(DataFrame.unionByName, stored), "buckets")
    probed = staged(functools.reduce(DataFrame.unionByName, probed), "probes")
    near = _met(stored, probed, limit, vectors_in_block, queries_in_block)
    if hashed:
        near = staged(near, "near")
        full = near.groupBy("query_id").count().filter(F.col("count") >= limit).select(F.col("query_id").alias("vec_id"))
        left = staged(asked.join(full, "vec_id", "left_anti"), "unfinished")
        if not left.isEmpty():
            rest = _met(staged(_whole(rows), "all"), staged(_whole(left), "rest"), limit, vectors_in_block, queries_in_block)
            near = near.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").unionByName(rest)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= limit).select("query_id", "rank", "vec_id", "score")
