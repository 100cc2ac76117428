import random
import re
from collections import Counter, defaultdict

import pytest
from cases import ROWS, documents, empty

from leadsieve.llm import components, exact_dedup, line_dedup, ngram_join


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def best_of(rows):
    """The id that stays: most code points, smallest id, null last."""
    return min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]


@pytest.mark.parametrize("radix, rounds", [(8, 3), (2, 2), (3, 1)])
def test_exact_groups(spark, radix, rounds):
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[plain(t)].append((i, t))
    got = exact_dedup.deduplicate(documents(spark).repartition(5), radix=radix, rounds=rounds).collect()
    assert len(got) == len(ROWS)
    want = Counter((i, best_of(g), len(g)) for g in groups.values() for i, _ in g)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert len(kept) == len(groups) and set(kept.values()) == {1}


def test_exact_rows_that_stay_keep_all_columns(spark):
    docs = documents(spark)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter(plain(r.text) for r in left.collect()) == Counter({plain(t) for _, t, _ in ROWS})
    assert exact_dedup.deduplicate(empty(spark)).count() == 0 and exact_dedup.drop_copies(empty(spark)).count() == 0


def grams(text, n=5):
    words = (text or "").lower().split()
    n = min(n, len(words))
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if words else frozenset()


def similar(a, b):
    return a == b or len(a & b) >= 0.8 * len(a | b) > 0


NEAR = [(100 + k, " ".join(f"w{j}" if j != 10 * k else "other" for j in range(120)), None) for k in range(12)]


@pytest.mark.parametrize("block", [512, 3])
def test_near_links_are_those_of_brute_force(spark, block):
    rows = ROWS + NEAR
    sets = [grams(t) for _, t, _ in rows]
    got = ngram_join.link(documents(spark, rows), block_sets=block).collect()
    wanted = Counter((rows[a][0], sum(similar(sets[a], sets[b]) for b in range(len(rows)) if b != a)) for a in range(len(rows)))
    assert Counter((r.doc_id, r.n_links) for r in got) == wanted
    assert {r.class_id for r in got if r.doc_id and r.doc_id >= 100} == {100}
    assert {r.class_id for r in got if r.doc_id in (2, 3, 4)} == {2}


def test_one_row_of_each_class_stays(spark):
    docs = documents(spark, ROWS + NEAR)
    left = ngram_join.drop_near_copies(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[100] == 1 and not set(range(101, 112)) & set(ids) and ids[1] == 1 and ids[2] == 1
    assert ngram_join.link(empty(spark)).count() == 0


def test_unlike_texts_under_one_id_or_without_id_stay(spark):
    texts = [" ".join(f"{name}{j}" for j in range(40)) for name in ("red", "blue", "green", "brown", "black")]
    rows = [(None, texts[0], None), (None, texts[1], None), (None, texts[1], None), (None, texts[2], None), (7, texts[3], None),
            (7, texts[4], None), (8, texts[4] + " end", None)]
    left = ngram_join.drop_near_copies(documents(spark, rows))
    assert Counter(r.text for r in left.collect()) == Counter(texts)


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_for(0.8, 0.999)
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.999


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r.node: r.label for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 200: 200, 201: 200}


def lines_left(rows, words):
    """Brute force: at every depth, windows seen earlier; neighbours whose first occurrences are neighbours are one run."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    texts = {k: (rows[k][1] or "").split("\n") for k in order}
    gone = {k: set() for k in order}
    for n, k in enumerate(order):
        if any(texts[j] == texts[k] for j in order[:n]) and sum(len(x.split(" ")) for x in texts[k] if x) >= words:
            gone[k] = set(range(len(texts[k])))
    depth = 1
    while depth <= max(map(len, texts.values())):
        first, later = {}, {}
        for k in order:
            for p in range(len(texts[k]) - depth + 1):
                at = first.setdefault(tuple(texts[k][p:p + depth]), (k, p))
                if at != (k, p):
                    later[k, p] = at
        for (k, p), (j, q) in later.items():
            if later.get((k, p - 1)) != (j, q - 1):
                end = p
                while later.get((k, end + 1)) == (j, q + end + 1 - p):
                    end += 1
                run = range(p, end + depth)
                if sum(len(texts[k][i].split(" ")) for i in run if texts[k][i]) >= words:
                    gone[k] |= set(run)
        depth *= 2
    return Counter((rows[k][0], len(t), len(gone[k]), "\n".join(x for p, x in enumerate(t) if p not in gone[k]))
                   for k, t in texts.items())


def copied_runs(seed):
    """Runs of 2 to 50 lines copied into other documents, some of them cut or with a line changed."""
    rng = random.Random(seed)
    source = [" ".join(rng.choice(["red", "blue", "tree", "stone"]) + str(rng.randrange(60)) for _ in range(rng.randrange(0, 5)))
              for _ in range(160)]
    rows = [(20, "\n".join(source), None)]
    for k in range(14):
        size = rng.randrange(2, 51)
        at = rng.randrange(0, 160 - size)
        part = source[at:at + size]
        if k % 4 == 3:
            part[size // 2] = f"changed {k}"
        own = [f"own line {k} {j}" for j in range(rng.randrange(0, 9))]
        rows.append((rng.choice([None, 21 + k, 3]), "\n".join(own + part + ["end"]), None))
    return rows


@pytest.mark.parametrize("words, seed", [(8, 1), (1, 2), (40, 3)])
def test_lines_that_stay(spark, words, seed):
    rows = ROWS + [(20 + k, "\n".join(f"line {j}" for j in range(k, k + 9)), None) for k in range(5)] + copied_runs(seed)
    rows += [(60, "again and again\n" * 40, None), (61, "\n" * 30, None)]
    got = line_dedup.deduplicate_lines(documents(spark, rows).coalesce(1), run_words=words).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_deleted, r.text) for r in got) == lines_left(rows, words)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.deduplicate_lines(empty(spark)).count() == 0


def test_texts_in_buckets_move_nowhere_and_are_released(spark, monkeypatch):
    from leadsieve.llm import common
    monkeypatch.setattr(common, "_made", [])
    monkeypatch.setattr(common, "_named", [])
    run = "\n".join(f"a line that repeats number {k} of a long run" for k in range(3))
    docs = spark.createDataFrame([(k, f"only {k}\n{run}\nend of {k}") for k in range(40)], "doc_id long, text string").repartition(4)
    got = line_dedup.deduplicate_lines(docs)
    assert {r.doc_id: r.n_deleted for r in got.collect()} == {k: 3 if k else 0 for k in range(40)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan" in line and re.search(r"\btext#", line)]
    assert "ShuffledHashJoin" in plan and scan and all("Bucketed: true" in line for line in scan)
    names = [n for _, n in common._named]
    assert len(names) == 1 and spark.catalog.tableExists(names[0])
    common.release(spark)
    assert not spark.catalog.tableExists(names[0]) and not common._made and not common._named
