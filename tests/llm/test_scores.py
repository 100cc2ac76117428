import math

import corpus_pipeline
import numpy as np
import pytest
from cases import ROWS, documents, empty

from leadsieve.llm import mixing, toxicity


def labelled(spark, count=600):
    """Label 1 where a text holds one of the marked words; a third of the rows are held out by their id."""
    rows = [(1000 + k, f"some plain words number {k % 37} here " + (f"nasty{k % 3} thing" if k % 4 == 0 else "kind thing"), None)
            for k in range(count)]
    labels = spark.createDataFrame([(i, 1, int("nasty" in t)) for i, t, _ in rows] + [(None, 1, 1), (1, None, None), (2, 0, 7)],
                                   "doc_id long, quality int, toxic int")
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows + ROWS)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(rows) + len(ROWS)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 1000:
            assert r.predicted == int((r.doc_id - 1000) % 4 == 0)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.held_out for r in got) > 100
    left = toxicity.drop_toxic(docs, toxicity.fit(docs, labels))
    assert left.columns == docs.columns and left.count() == len(ROWS) + 450


def test_without_labels_or_documents(spark):
    _, labels = labelled(spark)
    model = toxicity.fit(documents(spark), labels.filter("false"))
    assert {r.score for r in toxicity.score(documents(spark), model).collect()} == {0.5}
    assert toxicity.score(empty(spark), toxicity.fit(empty(spark), labels)).count() == 0


def test_index_finds_the_exact_neighbours():
    draw = np.random.default_rng(5)
    vectors = []
    for _ in range(400):
        terms = sorted(draw.choice(30, size=draw.integers(1, 6), replace=False).tolist())
        weights = draw.random(len(terms)) + 0.1
        vectors.append(list(zip(terms, (weights / math.sqrt((weights ** 2).sum())).tolist(), strict=True)))
    index = toxicity.Index(vectors, 30)
    for query in vectors[:60]:
        own = dict(query)
        exact = [(sum(own.get(t, 0) * w for t, w in v), k) for k, v in enumerate(vectors)]
        best = sorted(((s, k) for s, k in exact if s > 0), key=lambda x: (-round(x[0], 12), x[1]))[:10]
        assert [k for k, _ in index.nearest(query, 10)] == [k for _, k in best]


def test_rates_meet_targets(spark):
    cells = spark.createDataFrame([([0.9, 0.1], 1000), ([0.2, 0.8], 3000), ([0.5, 0.5], 500)], "posterior array<double>, tokens long")
    rates = mixing.solve(cells, ["a", "b"], {"a": 0.6, "b": 0.4})
    rows = cells.withColumn("rate", rates.of(cells["posterior"])).collect()
    totals = [sum(r.rate * r.tokens * r.posterior[k] for r in rows) / 4500 for k in (0, 1)]
    assert totals == pytest.approx([0.6, 0.4], abs=0.02) and all(r.rate >= 0 for r in rows)


@pytest.mark.parametrize("cells", [
    [([1.0, 0.0, 0.0, 0.0], 86000), ([0.0, 1.0, 0.0, 0.0], 12800), ([0.0, 0.0, 1.0, 0.0], 1000), ([0.0, 0.0, 0.0, 1.0], 200)],
    [([0.98, 0.02, 0.0, 0.0], 86000), ([0.1, 0.9, 0.0, 0.0], 12800), ([0.05, 0.0, 0.95, 0.0], 1000), ([0.0, 0.0, 0.0, 1.0], 200)]])
def test_rates_meet_the_targets_of_rare_domains(spark, cells):
    table = spark.createDataFrame(cells, "posterior array<double>, tokens long")
    targets = {"a": 0.9, "b": 0.08, "c": 0.02}
    rates = mixing.solve(table, ["a", "b", "c", "d"], targets)
    rows = table.withColumn("rate", rates.of(table["posterior"])).collect()
    totals = [sum(r.rate * r.tokens * r.posterior[k] for r in rows) / 100000 for k in range(4)]
    assert totals[:3] == pytest.approx([0.9, 0.08, 0.02], rel=0.01) and totals[3] < 1e-4 and all(r.rate >= 0 for r in rows)
    assert [rates.reached[d] / 100000 for d in "abcd"] == pytest.approx(totals, abs=1e-9)
    few = spark.createDataFrame([([1.0, 0.0], 99900), ([0.0, 1.0], 100)], "posterior array<double>, tokens long")
    rates = mixing.solve(few, ["a", "b"], {"a": 0.97, "b": 0.03})  # a rate of 30
    assert rates.reached["b"] == pytest.approx(rates.wanted["b"], rel=0.01)


@pytest.mark.parametrize("good, poor", [(0.872, 0.128), (0.5, 0.5), (0.97, 0.03)])
def test_the_pipeline_reaches_its_shares_without_loss(spark, good, poor):
    names = ["quality=0,toxic=0", "quality=1,toxic=0"]
    cells = spark.createDataFrame([([0.0, 1.0], int(good * 100000)), ([1.0, 0.0], int(poor * 50000)), ([0.9, 0.1], int(poor * 50000))],
                                  "posterior array<double>, tokens long")
    rates = mixing.solve(cells, names, corpus_pipeline.TARGETS, **corpus_pipeline.RATES)
    rows = cells.withColumn("rate", rates.of(cells["posterior"])).collect()
    totals = np.array([sum(r.rate * r.tokens * r.posterior[k] for r in rows) for k in (0, 1)])
    assert totals / totals.sum() == pytest.approx([0.05, 0.95], rel=0.02) and all(r.rate >= 1 for r in rows)


def test_leaking_domains_meet_their_target(spark):
    table = spark.createDataFrame([([0.95, 0.05], 80000), ([0.99, 0.01], 2000), ([0.5, 0.5], 18000)], "posterior array<double>, tokens long").coalesce(1)
    rates = mixing.solve(table, ["a", "b"], {"a": 0.98, "b": 0.02})
    assert [rates.reached[d] for d in "ab"] == pytest.approx([rates.wanted[d] for d in "ab"], rel=0.02)


@pytest.mark.parametrize("least, most", [(0.0, None), (1.0, 1.5), (0.2, 4.0)])
def test_rates_are_the_least_squares_by_single_documents(spark, least, most):
    """Brute force: one rate a document, each set to its best in turn until none moves."""
    draw = np.random.default_rng(11)
    posterior = draw.dirichlet([0.3, 0.3, 0.3], size=60)
    tokens, goal = draw.integers(1, 400, size=60), np.array([0.6, 0.39, 0.01])
    cells = spark.createDataFrame([(p.tolist(), int(n)) for p, n in zip(posterior, tokens, strict=True)], "posterior array<double>, tokens long").coalesce(1)
    rates = mixing.solve(cells, ["a", "b", "c"], dict(zip("abc", goal.tolist(), strict=True)), least=least, most=most)
    share = posterior * (tokens / tokens.sum())[:, None]
    scale = 1 / np.maximum(share.sum(axis=0), goal)
    best = np.ones(60)
    for _ in range(3000):
        for k in range(60):
            rest = best @ share - best[k] * share[k] - goal
            best[k] = np.clip(-(scale * rest) @ share[k] / ((scale * share[k]) @ share[k]), least, most)
    error = lambda r: scale @ (r @ share - goal) ** 2
    found = np.array([r.rate for r in cells.withColumn("rate", rates.of(cells["posterior"])).collect()])
    assert np.all(found >= least) and (most is None or np.all(found <= most))
    assert math.sqrt(error(found)) <= math.sqrt(error(best)) * 1.03 + 5e-3
    assert [rates.reached[d] / tokens.sum() for d in "abc"] == pytest.approx((found @ share).tolist(), abs=1e-9)


def test_steps_at_once_are_single_steps():
    products, scale, missed = np.array([[0.5, 0.1], [0.1, 0.2]]), np.array([1.2, 3.0]), np.array([0.3, -0.2])
    for count in (1, 2, 3, 8, 13):
        left, taken = missed, np.zeros(2)
        for _ in range(count):
            taken, left = taken + scale * left, left - products @ (scale * left)
        assert mixing._at_once(count, products, scale, missed) == pytest.approx(taken)


def test_a_rare_domain_keeps_its_mass():
    weights = np.zeros((mixing.STATS + mixing.BINS + 1, 2))
    weights[-1] = [0.0, -9.0]
    rare = mixing.Classifier(["a", "b"], np.zeros(mixing.STATS), np.ones(mixing.STATS), weights)
    assert rare.posterior(np.zeros(mixing.STATS), np.array([], dtype=int))[1] == pytest.approx(math.exp(-9) / (1 + math.exp(-9)))


def test_mixing_keeps_every_row_with_rates_of_one_or_more(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, rows + ROWS)
    model = mixing.fit(docs, labels)
    targets = {"quality=1,toxic=0": 0.5, "quality=1,toxic=1": 0.5}
    out = mixing.mixed_rows(docs, model, targets, least=1.0, most=3.0)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    told = mixing.mix(docs, model, targets).collect()
    assert len(told) == docs.count() and all(sum(r.posterior) == pytest.approx(1) for r in told)


def test_mixing_of_nothing(spark):
    _, labels = labelled(spark)
    model = mixing.fit(empty(spark), labels)
    assert model.domains == ["all"] and mixing.mix(empty(spark), model, {"all": 1}).count() == 0
    assert {r.copies for r in mixing.mix(documents(spark), model, {}).collect()} == {1}
