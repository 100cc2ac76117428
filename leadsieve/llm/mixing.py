"""Mixing to target weights with soft membership.

A classifier learnt from a bounded sample of the labelled table gives each document its posterior over domains. Rates r,
the expected number of times a document is used, are fitted by least squares over documents: expected token totals
sum(r * tokens * posterior) shall be the targets, and rates stay within bounds. The fit goes along projected gradients from
rates of 1. A gradient needs only totals by domain, which Spark sums; with the products of posteriors of rates that are free
it also tells the next gradients, so several steps are taken at once and projected. They count if the squared error fell,
else fewer are taken, a single one at last. What a document's rate becomes follows from its posterior and the steps so far,
so every task makes them again and no table of rates is kept. Documents with one posterior share a rate.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import fingerprint, staged, whole
from leadsieve.llm.pieces import Kept

log = logging.getLogger(__name__)

#: Labelled documents to learn from at most, the smallest by a hash of their id.
EXAMPLES = 8_000
BINS = 1024
#: The fit ends once every target is met but for this part of it, or once LEVEL passes in a row have lowered the squared error
#: by less than STILL of it, as when targets can't be reached; PASSES guards against a fit that does neither.
CLOSE = 5e-3
LEVEL = 8
STILL = 1e-3
PASSES = 200
#: Steps at once grow by the first factor after a fall of the error, and shrink by the second after a rise.
MORE = 4
FEWER = 16
#: A target missed by more than this part of it is told in the log.
MISSED = 0.01
#: Room above the rate a domain needs when no document is shared between domains.
REACH = 1.5

_KINDS = np.full(256, 8, dtype=np.int64)
for _k, _set in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,", "!?", "|")):
    _KINDS[[ord(c) for c in _set]] = _k
_KINDS[128:] = 9
STATS = 14


class Features:
    """Shares of kinds of bytes, a few measures of repetition, and which of BINS hashed words occur."""

    def __init__(self):
        self.of_word = Kept(lambda w: zlib.crc32(w.encode("utf-8", "surrogatepass")) % BINS)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Measures, sorted bins, number of words."""
        words = text.lower().split()
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        kinds = np.bincount(_KINDS[raw], minlength=10) / max(1, len(raw))
        twins = sum(map(str.__eq__, words, words[1:]))
        stats = np.array([*kinds, len(set(words)) / max(1, len(words)), twins / max(1, len(words)),
                          np.log1p(len(words)), len(text) / max(1, len(words)) / 10])
        return stats, np.unique(np.fromiter(map(self.of_word.__getitem__, words), dtype=np.int32, count=len(words))), len(words)


@dataclass
class Classifier:
    domains: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    """domains by name; standardising of the measures; weights of measures, bins and the constant by domain."""

    def posterior(self, stats: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """A posterior over the domains; it sums to 1."""
        score = ((stats - self.mean) / self.scale) @ self.weights[:STATS] + self.weights[-1]
        if len(bins):
            score = score + self.weights[STATS:STATS + BINS][bins].sum(axis=0) / np.sqrt(len(bins))
        likely = np.exp(score - score.max())
        return likely / likely.sum()


def _trained(stats: np.ndarray, bins: list[np.ndarray], truth: np.ndarray, domains: list[str], steps: int = 150) -> Classifier:
    """Softmax regression by accelerated gradient descent on at most EXAMPLES rows."""
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    x = np.zeros((len(truth), STATS + BINS + 1), dtype=np.float32)
    x[:, :STATS], x[:, -1] = (stats - mean) / scale, 1
    for k, b in enumerate(bins):
        x[k, STATS + b] = 1 / np.sqrt(max(1, len(b)))
    wanted = np.eye(len(domains), dtype=np.float32)[truth]
    weights = np.zeros((x.shape[1], len(domains)), dtype=np.float32)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = x @ weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        gradient = x.T @ (z / z.sum(axis=1, keepdims=True) - wanted) / len(truth) + 1e-4 * weights
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient ** 2
        weights -= 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Classifier(domains, mean, scale, weights.astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        domain: tuple[str, ...] = ("quality", "toxic"), examples: int = EXAMPLES) -> Classifier:
    """Learn domains, named by the values of the label columns (such as quality=1,toxic=0).

    Labelled rows with a null in those columns or a null id are left out; of an id labelled several times the smallest
    name counts, of several documents with one id the smallest text. Without examples there is one domain, "all".
    """
    import pyarrow as pa
    name = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in domain])
    usable = labels.select(F.col(doc_id).alias("l_id"), *domain).dropna()
    chosen = (usable.select("l_id", name.alias("domain")).groupBy("l_id").agg(F.min("domain").alias("domain"))
              .orderBy(F.xxhash64("l_id"), "l_id").limit(examples))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    texts = rows.join(F.broadcast(chosen), rows["doc_id"] == F.col("l_id")).groupBy("l_id", "domain").agg(
        F.min("text").alias("text"))

    def run(batches):
        features = Features()
        for batch in batches:
            made = [features.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0].tolist() for m in made], pa.list_(pa.float64())),
                 pa.array([m[1] for m in made], pa.list_(pa.int32()))], names=["domain", "stats", "bins"])

    got = (texts.select("domain", "text").mapInArrow(run, "domain string, stats array<double>, bins array<int>")
           .orderBy("domain", "stats").collect())  # at most `examples` rows
    domains = sorted({r["domain"] for r in got})
    if not domains:
        return Classifier(["all"], np.zeros(STATS), np.ones(STATS), np.zeros((STATS + BINS + 1, 1)))
    truth = np.array([domains.index(r["domain"]) for r in got])
    return _trained(np.array([r["stats"] for r in got]), [np.array(r["bins"], dtype=int) for r in got], truth, domains)


def with_posterior(docs: DataFrame, model: Classifier, text: str = "text", column: str = "posterior") -> DataFrame:
    """docs with a column of struct(posterior array<double>, tokens long): words between white space."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features()
        for texts in batches:
            made = [features.of(t) for t in texts]
            yield pd.DataFrame({"posterior": [sent.value.posterior(m[0], m[1]) for m in made],
                                "tokens": [m[2] for m in made]})

    made = F.pandas_udf(predict, "posterior array<double>, tokens long")
    return docs.withColumn(column, made(whole(text)))


def _replayed(posterior: np.ndarray, steps: list[np.ndarray], least: float, most: float | None) -> np.ndarray:
    """The rates of posteriors (rows x domains) after these steps: what each takes from a rate by domain."""
    rate = np.clip(np.ones(len(posterior)), least, most)
    for step in steps:
        rate = np.clip(rate - posterior @ step, least, most)
    return rate


@dataclass
class Rates:
    """The steps of the fit, from which a posterior's rate follows; tokens wanted and reached by domain."""

    steps: list[np.ndarray]
    least: float
    most: float | None
    wanted: dict[str, float]
    reached: dict[str, float]

    def of(self, posterior):
        """Column of the rate of a posterior (an array column)."""
        steps, least, most = self.steps, self.least, self.most
        if not steps:
            held = max(least, 1.0) if most is None else min(max(least, 1.0), most)
            return F.lit(float(held))

        def rate(given: pd.Series) -> pd.Series:
            return pd.Series(_replayed(np.stack(given.to_numpy()), steps, least, most) if len(given) else [], dtype="float64")

        return F.pandas_udf(rate, "double")(posterior)


def _totals(cells: DataFrame, size: int, steps: list[np.ndarray], wanted: float, least: float,
            most: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Shares of tokens by domain at the rates after these steps; by pair of domains, those of documents within the bounds."""
    import pyarrow as pa

    def run(batches):
        out = np.zeros((1 + size, size))
        for batch in batches:
            posterior = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            weight = batch.column(1).to_numpy(zero_copy_only=False) / wanted
            rate = _replayed(posterior, steps, least, most)
            out[0] += (weight * rate) @ posterior
            free = weight * ((rate > least) & (rate < (np.inf if most is None else most)))
            out[1:] += (posterior * free[:, None]).T @ posterior
        yield pa.RecordBatch.from_pydict({"at": np.arange(out.size), "value": out.reshape(-1)})

    out = np.zeros((1 + size) * size)
    for r in cells.select("posterior", F.col("tokens").cast("double")).mapInArrow(run, "at long, value double").groupBy("at").agg(
            F.sum("value").alias("value")).collect():  # a row for each domain and pair of domains
        out[r["at"]] = r["value"]
    out = out.reshape(1 + size, size)
    return out[0], out[1:]


def _at_once(count: int, products: np.ndarray, scale: np.ndarray, missed: np.ndarray) -> np.ndarray:
    """What this many gradient steps take from a rate by domain, as long as no further rate meets a bound."""
    keep = np.eye(len(scale)) - products * scale  # what a step leaves of the misses
    total, power = np.zeros_like(keep), np.eye(len(scale))
    for bit in bin(count)[2:]:  # total: the sum of the first powers of keep; power: the next one
        total, power = total + power @ total, power @ power
        if bit == "1":
            total, power = total + power, power @ keep
    return scale * (total @ missed)


def solve(cells: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None,
          least: float = 0.0, most: float | None = None, passes: int = PASSES, reach: bool = False) -> Rates:
    """Rates for cells (posterior, tokens): posteriors and the tokens of all documents that have them.

    targets: weight by domain; domains without one get 0, and weights are scaled to sum to 1. total: tokens wanted, those
    there by default. least and most bound the rates. reach: total and most are raised as far as rates of at least `least`
    need for domains with a target to have their shares; what documents hold of domains without one isn't counted. Targets
    that can't be reached within them are missed by as little as least squares can, errors taken in parts of a domain's size
    (its target or what is there, whichever is more); the result has the tokens wanted and reached, and the log tells of
    targets missed. Only sums by domain come to the driver.
    """
    size = len(domains)
    sums = cells.agg(F.sum("tokens").alias("n"), *[F.sum(F.col("tokens") * F.col("posterior")[k]).alias(f"s{k}")
                                                   for k in range(size)]).first()
    have = sums["n"] or 0
    weights = np.array([float(targets.get(d, 0.0)) for d in domains])
    if not have or not weights.sum():
        return Rates([], 1.0, None, {}, {})
    there, goal = np.array([sums[f"s{k}"] for k in range(size)]), weights / weights.sum()
    wanted = float(total or have)
    if reach:
        aimed = (goal > 0) & (there > 0)
        wanted = max([wanted, *(least * there[aimed] / goal[aimed])])
        most = most if most is None else max([most, *(REACH * wanted * goal[aimed] / there[aimed])])
    # With errors in parts of a domain's size, and rates weighted by tokens, the gradient changes by no more than the rates
    # do, as posteriors sum to 1: steps of length 1 are safe.
    scale = np.maximum(there / wanted, goal)
    scale = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)
    near = np.where(goal > 0, CLOSE * goal, np.inf)  # a domain without a target would take all else from few documents
    made: list[np.ndarray] = []
    tried, errors, count = made, [], 1
    for _ in range(passes):
        found, products = _totals(cells, size, tried, wanted, least, most)
        error = float(scale @ (found - goal) ** 2)
        if not errors or error < errors[-1]:
            made, share, free, count = tried, found, products, count * MORE if tried else 1
            errors.append(error)
        elif count == 1:
            break
        else:
            count = max(1, count // FEWER)
            errors.append(errors[-1])
        still = len(errors) > LEVEL and errors[-1 - LEVEL] - errors[-1] < STILL * errors[-1 - LEVEL]
        if still or (np.abs(share - goal) <= near).all():
            break
        tried = [*made, _at_once(count, free, scale, share - goal)]
    rates = Rates(made, least, most, dict(zip(domains, (goal * wanted).tolist(), strict=True)),
                  dict(zip(domains, (share * wanted).tolist(), strict=True)))
    for k, d in enumerate(domains):
        if abs(rates.reached[d] - rates.wanted[d]) > MISSED * (rates.wanted[d] or there[k]):
            log.warning("domain %s: %.0f tokens wanted, %.0f reached after %d steps", d, rates.wanted[d], rates.reached[d], len(made))
    return rates


def copies(rate, *key) -> F.Column:
    """A whole number of times with the rate as its mean, the same for the same key on every run."""
    chance = F.pmod(F.xxhash64(*key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _cells(scored: DataFrame, column: str) -> DataFrame:
    return scored.groupBy(F.col(f"{column}.posterior").alias("posterior")).agg(F.sum(f"{column}.tokens").alias("tokens"))


def mix(docs: DataFrame, model: Classifier, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text",
        **how) -> DataFrame:
    """doc_id, n_tokens, posterior (in order of model.domains), rate, copies for each document.

    Null and empty texts have no tokens; they take a rate as others and move no total. Repeated rows and null ids stay;
    columns besides the two are ignored. An empty table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("print"), whole(text).alias("text"))
    scored = staged(with_posterior(narrow, model).drop("text"), "posteriors")
    cells = staged(_cells(scored, "posterior"), "cells")
    rates = solve(cells, model.domains, targets, **how)
    out = scored.select("doc_id", "print", F.col("posterior.tokens").alias("n_tokens"), F.col("posterior.posterior"))
    out = out.withColumn("rate", rates.of(F.col("posterior")))
    return out.withColumn("copies", copies(F.col("rate"), "doc_id", "print")).drop("print")


def mixed_rows(docs: DataFrame, model: Classifier, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text",
               **how) -> DataFrame:
    """Rows of docs, each as often as its rate says, all columns as they are, whatever their names.

    Null and empty texts have no tokens; they take a rate as others. Rows equal in id and text are repeated alike; null ids
    count as others. Without labels there is one domain and every row stays once. An empty table gives no rows.
    """
    narrow = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                         whole(F.col(f"`{text}`")).alias("text"))
    scored = staged(with_posterior(narrow, model, "text", "mix").select("row", "id", fingerprint("text").alias("print"), "mix"),
                    "posteriors")
    rates = solve(staged(_cells(scored, "mix"), "cells"), model.domains, targets, **how)
    rated = scored.withColumn("rate", rates.of(F.col("mix.posterior")))
    times = copies(F.col("rate"), F.col("id"), F.col("print"))
    return rated.select("row", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")
