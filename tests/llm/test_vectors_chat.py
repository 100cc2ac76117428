import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from leadsieve.llm import ann, chat

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_all_probes_find_the_exact_neighbours(spark):
    draw = np.random.default_rng(7)
    made = draw.normal(size=(200, 6)) * draw.random((200, 1)) * 3
    made[50:80] = made[49]  # ties
    rows = [(k, [float(x) for x in v], "x") for k, v in enumerate(made)]
    odd = [(900, None, "x"), (901, [0.0] * 6, "x"), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (903, [float("nan")] * 6, "x"),
           (904, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x"), (905, [1.0, 2.0], "x"), (5, rows[5][1], "x")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, bucket string")
    got = defaultdict(list)
    found = ann.search(table, table.filter("vec_id % 20 = 0"), tables=1, probes=32, vectors_in_block=16, queries_in_block=4)
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert set(got) == set(range(0, 200, 20))
    for q in got:
        score = (made * made[q]).sum(axis=1)
        assert got[q] == [int(k) for k in np.lexsort((np.arange(200), -score)) if k != q][:20]
    assert ann.search(table.filter("false"), table, 3).count() == 0


@pytest.mark.parametrize("sf", ["0.01", "0.1"])  # searched exactly, by hashing
def test_recall_of_the_default_setting(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    assert (vectors.count() > ann.SCANNED) == (sf == "0.1")
    got = {(r.query_id, r.vec_id) for r in ann.search(vectors, vectors.filter("vec_id % 20 = 0")).collect()}
    rows = vectors.collect()
    made = np.array([r.embedding for r in rows], dtype=np.float64)
    ids, hits, total = [r.vec_id for r in rows], 0, 0
    for q in (k for k, i in enumerate(ids) if i % 20 == 0):
        near = [k for k in np.argsort(-(made @ made[q])) if k != q][:20]
        hits, total = hits + sum((ids[q], ids[k]) in got for k in near), total + 20
    assert hits / total >= 0.9


def recall_of(spark, made, **how):
    table = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(made)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in ann.search(table, table.filter("vec_id % 20 = 0"), **how).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for q in range(0, len(made), 20):
        score = made @ made[q]
        score[q] = -np.inf
        near = np.argsort(-score)[:min(20, len(made) - 1)]
        hits, total = hits + len(got[q] & set(near.tolist())), total + len(near)
        assert len(got[q]) == len(near)
    return hits / total


@pytest.mark.parametrize("lengths, least", [("one long", 0.9), ("spread", 0.9)])
def test_recall_with_uneven_lengths(spark, lengths, least):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").limit(1200).collect()
    made, draw = np.array([r.embedding for r in rows], dtype=np.float64), np.random.default_rng(3)
    if lengths == "one long":
        made[7] *= 10
    else:
        made *= np.exp(draw.normal(size=(len(made), 1)))
    assert recall_of(spark, made, scanned=40) >= least


def test_small_tables_and_queries_with_few_hits_are_whole(spark):
    made = np.random.default_rng(2).normal(size=(15, 64))
    assert recall_of(spark, made) == 1 and recall_of(spark, made, scanned=0) == 1
    made = np.random.default_rng(2).normal(size=(60, 64))
    assert recall_of(spark, made, scanned=0, tables=1, probes=1) == 1


def test_fast_transform_is_the_matrix():
    matrix = np.array([[1.0]])
    for _ in range(4):
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(ann.hadamard(x), x @ matrix / 4)


ROLES = ["system", "user", "assistant", "tool|x\\", ""]
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>", "<|end|>", "<", "[", "\\", "\n", " a ", "/s>", "<\\s>", "[\\\\INST]"]


def test_escapes_and_parsing_are_reversible():
    draw = random.Random(4)
    for _ in range(3000):
        turns = [(draw.choice(ROLES), "".join(draw.choice(BITS) for _ in range(draw.randint(0, 8)))) for _ in range(draw.randint(1, 4))]
        shown, spans = chat.formatted(turns, 0)
        assert chat.parsed(shown) == turns
        assert [chat.unescape(shown[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def conversations(spark):
    draw = random.Random(9)
    rows = [(c, t, draw.choice(ROLES) if t else "system", "".join(draw.choice(BITS + ["word "] * 5) for _ in range(draw.randint(0, 40))))
            for c in range(8) for t in range(draw.randint(1, 30))]
    rows += [(50, t, ("user", "assistant")[t % 2], f"turn {t} " * 5) for t in range(400)]
    rows += [(60, 0, "assistant", "word " * 3000), (60, 1, None, None), (60, None, "user", "first"), (None, 1, "user", "x"),
             (None, 2, "assistant", "y"), (60, 1, None, None)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")


@pytest.mark.parametrize("budget, history", [(2048, 256), (300, 60)])
def test_windows_hold_each_turn_once(spark, budget, history):
    rows, table = conversations(spark)
    made = chat.windows(table.repartition(3), WORDS, budget=budget, history_budget=history).cache()
    groups = defaultdict(list)
    for c, t, r, x in rows:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        told = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        target = "".join(x for _, _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())
    for w in made.collect():
        assert w.n_tokens <= budget or w.over_budget and w.n_turns - w.n_repeated == 1
        if w.conv_id is not None and w.conv_id < 8:
            assert chat.parsed(w.formatted)[0][0] == "system"
    assert chat.windows(table.filter("false"), WORDS).count() == 0
