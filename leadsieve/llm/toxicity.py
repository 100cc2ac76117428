"""Toxicity by the nearest labelled examples in exact TF-IDF cosine, found with a block-max inverted index.

Learning takes a bounded sample of labelled rows. Terms whose presence goes with the label are chosen from it by a
likelihood-ratio test; their document frequencies are counted over all documents. An example is the TF-IDF vector of its
text over these terms; examples with one vector are one entry with counts. The index keeps, for each term and block of
entries, the largest weight; a query visits blocks by falling upper bound and stops when no block can hold a nearer
entry, so the neighbours are exact. Their votes, weighted by similarity, are calibrated on the examples with each one
taken out of its own entry. A score depends on nothing but the text.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import whole
from leadsieve.llm.pieces import Kept, slices

#: Labelled rows of each class to learn from, at most; the smallest by a hash of their id.
EXAMPLES = 5_000
#: The least likelihood ratio (G squared) of a term that is more common with label 1.
LEAST_G2 = 20.0
NEIGHBOURS = 16
BLOCK = 256
#: Blocks scored first.
FIRST = 4
#: Weight of the prior in a vote, in examples of similarity 1.
PRIOR = 0.5
REJECT = 0.7
EVIDENCE = 3
NONE = -1

_EDGES = ".,;:!?\"'()[]{}<>«»¡¿|*_-"


def term_of(word: str) -> str:
    """A word without marks at its ends."""
    return word.strip(_EDGES)


def words_of(text: str) -> list[str]:
    """Lower-cased runs without white space."""
    return text.lower().split()


def held_out(doc_id) -> F.Column:
    """Whether a row's label is never learnt from: CRC-32 of its id as text leaves remainder 1 by 3. A null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    weights: tuple[float, float]
    entries: list[tuple[tuple[tuple[int, int], ...], int, int, int | None]]
    bare: tuple[int, int]
    neighbours: int
    """terms, their inverse frequencies, weight of an example by label, entries (vector, negatives, positives, smallest
    id), examples without a term by label, entries asked."""

    def __post_init__(self):
        self.prior = _share(self.weights, self._total())
        self.index = Index([self.vector(e[0]) for e in self.entries], len(self.idf))
        raw, hit, weight = [], [], []
        for vector, negatives, positives, _ in self.entries:
            found = self.index.nearest(self.vector(vector), self.neighbours)
            for label, count in enumerate((negatives, positives)):
                if count:
                    raw.append(self.vote(vector, found, without=label))
                    hit.append(label)
                    weight.append(count * self.weights[label])
        self.steps = _isotonic(np.array(raw), np.array(hit, dtype=float), np.array(weight), self.prior)
        self.known = Kept(self._score, 50_000)

    def _total(self) -> tuple[int, int]:
        return tuple(self.bare[k] + sum(e[1 + k] for e in self.entries) for k in (0, 1))

    def vector(self, counts) -> list[tuple[int, float]]:
        """Unit TF-IDF vector of (term, count) pairs."""
        raw = [(t, (1 + math.log(c)) * self.idf[t]) for t, c in counts]
        norm = math.sqrt(sum(w * w for _, w in raw))
        return [(t, w / norm) for t, w in raw]

    def vote(self, counts, found: list[tuple[int, float]], without: int | None = None) -> float:
        """Share of positives among the found entries, by similarity; without: one example of that label is left out."""
        total, positive = PRIOR, PRIOR * self.prior
        for entry, near in found:
            vector, negatives, positives, _ = self.entries[entry]
            if without is not None and vector == counts:
                negatives, positives = negatives - (without == 0), positives - (without == 1)
            for label, count in enumerate((negatives, positives)):
                total += near * near * count * self.weights[label]
                positive += near * near * count * self.weights[label] * label
        return positive / total

    def _score(self, counts) -> tuple[float, tuple]:
        if not counts:
            return _share(self.weights, self.bare, self.prior), ()
        near = self.index.nearest(self.vector(counts), self.neighbours)
        return float(np.interp(self.vote(counts, near), *self.steps)), tuple(self.entries[e][3] for e, _ in near[:EVIDENCE])


def _share(weights, counts, prior: float = 0.5) -> float:
    """Share of positives among weighted examples, with one example's worth of prior."""
    negatives, positives = (w * c for w, c in zip(weights, counts, strict=True))
    return (positives + prior) / (negatives + positives + 1)


class Index:
    """Postings by term, in order of entry, with the largest weight of each block of entries."""

    def __init__(self, vectors: list[list[tuple[int, float]]], terms: int):
        self.count = len(vectors)
        self.blocks = -(-self.count // BLOCK)
        self.most = np.zeros((terms, self.blocks))
        made: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for entry, vector in enumerate(vectors):
            for t, w in vector:
                made[t].append((entry, w))
                self.most[t, entry // BLOCK] = max(self.most[t, entry // BLOCK], w)
        self.entries = [np.array([e for e, _ in m], dtype=np.int64) for m in made]
        self.weights = [np.array([w for _, w in m]) for m in made]
        edges = np.arange(self.blocks + 1) * BLOCK
        self.edges = [np.searchsorted(e, edges) for e in self.entries]

    def _scores(self, query: list[tuple[int, float]], blocks: np.ndarray, apart: bool) -> np.ndarray:
        """Cosines of the entries of some blocks, one by one or all from the first to the last; 0 for others."""
        scores = np.zeros(self.count)
        runs = [(b, b + 1) for b in blocks] if apart else [(blocks[0], blocks[-1] + 1)]
        for t, w in query:
            entries, weights, edges = self.entries[t], self.weights[t], self.edges[t]
            for first, last in runs:
                here = slice(edges[first], edges[last])
                scores[entries[here]] += w * weights[here]
        return scores

    def nearest(self, query: list[tuple[int, float]], k: int) -> list[tuple[int, float]]:
        """The k entries of largest cosine above 0, ties to the smaller entry.

        The blocks of highest bounds give the least cosine that counts; then all blocks whose bound reaches it are scored.
        """
        bounds = sum(w * self.most[t] for t, w in query)
        if not self.count or not np.any(bounds > 0):
            return []
        first = np.sort(np.argsort(-bounds, kind="stable")[:FIRST])
        scores = self._scores(query, first, True)
        found = scores[scores > 0]
        least = np.partition(found, -k)[-k] - 1e-12 if len(found) >= k else 0.0
        more = np.flatnonzero((bounds > 0) & (bounds >= least))
        if len(np.setdiff1d(more, first)):
            scores = self._scores(query, more, len(more) <= FIRST)
        places = np.flatnonzero((scores > 0) & (scores >= least))
        best = places[np.lexsort((places, -np.round(scores[places], 12)))[:k]]
        return list(zip(best.tolist(), scores[best].tolist(), strict=True))


def _isotonic(raw: np.ndarray, hit: np.ndarray, weight: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps from raw votes to observed shares (pool adjacent violators), smoothed by one example of the prior."""
    if not len(raw):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    pools: list[list[float]] = []  # sum of votes, weight, positives
    for k in np.argsort(raw, kind="stable"):
        pools.append([raw[k] * weight[k], weight[k], hit[k] * weight[k]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x = np.array([p[0] / p[1] for p in pools])
    return x, np.maximum.accumulate(np.array([(p[2] + prior) / (p[1] + 1) for p in pools]))


def _sampled(labels: DataFrame, doc_id: str, label: str, examples: int) -> tuple[DataFrame, tuple[int, int]]:
    """Ids and labels to learn from, and how many labelled rows of each class there are."""
    usable = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
              .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    totals = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [usable.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for k in (0, 1)]
    return chosen[0].union(chosen[1]), (totals.get(0, 0), totals.get(1, 0))


def _terms(texts: DataFrame) -> dict[str, int]:
    """Terms that go with label 1 in (text, label) rows, numbered by name: all that the test finds, however weak."""
    import pyarrow as pa

    def run(batches):
        for batch in slices(batches):
            lists = [list({t for t in map(term_of, set(words_of(x))) if t}) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string())), batch.column(1)], names=["terms", "label"])

    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    with_1, with_0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not with_1 or not with_0:
        return {}
    both = with_0 + with_1
    counted = (texts.mapInArrow(run, "terms array<string>, label int").select(F.explode("terms").alias("term"), "label")
               .groupBy("term").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")))
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)
    p, n, used = F.col("p"), F.col("n"), F.col("p") + F.col("n")
    g2 = 2 * (part(p, used * with_1 / both) + part(n, used * with_0 / both)
              + part(with_1 - p, (both - used) * with_1 / both) + part(with_0 - n, (both - used) * with_0 / both))
    best = counted.filter(p / with_1 > n / with_0).filter(g2 >= LEAST_G2)
    names = [r["term"] for r in best.select("term").collect()]  # of 2 x examples texts
    return {t: k for k, t in enumerate(sorted(names))}


def _finder(terms: dict[str, int]) -> Kept:
    """word -> the number of its term, or none."""
    return Kept(lambda word: terms.get(term_of(word), NONE))


def term_counts(text: str, of_piece: Kept) -> tuple[tuple[int, int], ...]:
    found = [t for t in map(of_piece.__getitem__, words_of(text)) if t >= 0]
    return tuple(sorted(Counter(found).items())) if found else ()


def _frequencies(docs: DataFrame, text: str, terms: dict[str, int]) -> tuple[int, np.ndarray]:
    """Number of documents, and how many hold each term, over the whole table. Each task sends one row per term."""
    import pyarrow as pa
    sent = docs.sparkSession.sparkContext.broadcast(terms)  # from 2 x examples texts

    def run(batches):
        of_piece, seen, rows = _finder(sent.value), np.zeros(len(sent.value) + 1, dtype=np.int64), 0
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                seen[[k for k, _ in term_counts(t, of_piece)]] += 1
                rows += 1
        seen[-1] = rows
        yield pa.RecordBatch.from_pydict({"term": np.flatnonzero(seen), "n": seen[np.flatnonzero(seen)]})

    out = np.zeros(len(terms) + 1, dtype=np.int64)
    for r in docs.select(whole(text).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(
            F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return int(out[-1]), out[:-1]


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        examples: int = EXAMPLES, neighbours: int = NEIGHBOURS) -> Model:
    """Learn from at most `examples` labelled documents of each class that aren't held out.

    Labels other than 0 and 1, null ids and ids without a document are left out; an id labelled twice has label 1 if one
    says so; of several documents with one id the smallest text counts. Without both classes there are no terms, and
    every text gets the labels' smoothed share of positives (0.5 without any label).
    """
    chosen, totals = _sampled(labels, doc_id, label, examples)
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "l_id"))  # at most 2 x examples ids
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    texts = rows.join(chosen, rows["doc_id"] == chosen["l_id"]).groupBy("l_id", "label").agg(F.min("text").alias("text"))
    found = _terms(texts.select("text", "label"))
    count, seen = _frequencies(docs, text, found)
    idf = np.log((1 + count) / (1 + seen)) + 1
    entries, bare = _entries(texts, found)
    have = [bare[k] + sum(e[1 + k] for e in entries) for k in (0, 1)]
    weights = tuple(totals[k] / have[k] if have[k] else 1.0 for k in (0, 1))
    return Model(found, idf, weights, entries, bare, neighbours)


def _entries(texts: DataFrame, terms: dict[str, int]):
    """Examples by vector: (vector, negatives, positives, smallest id), and those without a term by label."""
    import pyarrow as pa
    sent = texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        of_piece = _finder(sent.value)
        for batch in slices(batches):
            counts = [term_counts(x, of_piece) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[t for t, _ in c] for c in counts], pa.list_(pa.int32())),
                 pa.array([[n for _, n in c] for c in counts], pa.list_(pa.int32()))], names=["id", "label", "terms", "counts"])

    made = (texts.select(F.col("l_id").cast("long"), "label", "text")
            .mapInArrow(run, "id long, label int, terms array<int>, counts array<int>")
            .groupBy("terms", "counts").agg(F.sum(1 - F.col("label")).alias("n"), F.sum("label").alias("p"),
                                            F.min("id").alias("id")).collect())  # at most 2 x examples rows
    rows = sorted((tuple(zip(r["terms"], r["counts"], strict=True)), r["n"], r["p"], r["id"]) for r in made)
    bare = next(((r[1], r[2]) for r in rows if not r[0]), (0, 0))
    return [r for r in rows if r[0]], bare


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the nearest examples) for each document, in one pass.

    Null text is empty text; texts without a term get the share of positives among such examples. Whole texts of any
    length count; repeated rows and null ids stay; columns besides the two are ignored. Neighbours of one similarity rank
    by entry, which is by vector. An empty table gives no rows.
    """
    import pyarrow as pa
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 x examples entries
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), whole(text).alias("text"))

    def run(batches):
        own, of_piece = sent.value, _finder(sent.value.terms)
        for batch in slices(batches):
            found = [own.known[term_counts(t, of_piece)] for t in batch.column(2).to_pylist()]
            scores = [s for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= REJECT) for s in scores], pa.int32()),
                 pa.array([list(e) for _, e in found], pa.list_(pa.int64()))],
                names=["doc_id", "held_out", "score", "predicted", "evidence"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, evidence array<long>")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs whose text scores below REJECT, all columns as they are, whatever their names; no shuffle.

    Null text is empty text; repeated rows score alike and stay or go together; null ids count as others. An empty table
    gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, of_piece = sent.value, _finder(sent.value.terms)
        for texts in batches:
            yield pd.Series([own.known[term_counts(t, of_piece)][0] < REJECT for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(accepted, "boolean")(whole(text)))
