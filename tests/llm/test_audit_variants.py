import itertools
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from cases import ROWS, documents, empty

from leadsieve.llm import filter_audit, simhash, spelling

RNG = random.Random(5)


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string, good boolean")


def audit_rows(rows, labels):
    """Brute force: every order applied from left to right to every document."""
    texts = [(i, t or "", s or "") for i, t, s in rows]
    good, toxic = ({i for i, q, x, *_ in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))

    def fails(i, t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [j for j, u, _ in texts if u == t]
        known = [j for j in same if j is not None]
        return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                "E": bool(known) and (i is None or i > min(known))}

    failed = [(p, i, fails(i, t)) for i, t, p in texts]
    out = {}
    for part in {p for p, *_ in failed}:
        own = [(i, f) for p, i, f in failed if p == part]
        removed_by = Counter()
        made = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, k in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[k]]
                left = [(i, f) for i, f in left if not f[k]]
                removed_by[k] += len(gone)
                made.append((k, ("".join(order), step, len(left), len(gone), sum(f[k] for _, f in own) - len(gone),
                                 sum(f[k] and sum(f.values()) == 1 for _, f in own), sum(i in good for i, _ in gone),
                                 sum(i in toxic for i, _ in gone))))
        out |= {(part, row[0], row[1]): (*row[2:], removed_by[k]) for k, row in made}
    return out


@pytest.mark.parametrize("extra", [[], [(200 + k, " ".join(RNG.choice(["Ab", "cd", "#x", "ef", "gh%"]) + str(RNG.randrange(90))
                                                            for _ in range(RNG.randrange(60, 160))), RNG.choice("abc"))
                                        for k in range(25)]])
def test_audit_is_that_of_brute_force(spark, extra):
    rows = ROWS + extra + [(i, t, "a") for i in (201, None) for _, t, _ in extra[:2]]
    labels = [(5, 1, 0, "x", True), (7, 0, 1, "x", True), (7, 1, None, "x", True), (None, 1, 1, "x", True), (999, 1, 1, "x", True),
              (8, None, 1, "x", True), (1, 1, 1, "x", True)] + [(200 + k, k % 2, k % 3 == 0, "x", True) for k in range(25)]
    labels = [(i, q, None if x is None else int(x), p, g) for i, q, x, p, g in labels]
    got = filter_audit.audit(documents(spark, rows).withColumnRenamed("row", "lang"), labels_table(spark, labels)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == audit_rows(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_audit_of_an_empty_table(spark):
    assert filter_audit.audit(empty(spark).withColumnRenamed("row", "lang"), labels_table(spark, [])).count() == 0
    got = filter_audit.audit(documents(spark).withColumnRenamed("row", "lang"), labels_table(spark, []))
    assert {r.good_lost + r.toxic_lost for r in got.collect()} == {0}


def word_counts(rows, letters=5, slips=97):
    counts = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            word = low if h % slips else low[:h % len(low)] + low[h % len(low) + 1:]
            counts[word] += len(word) >= letters
    return counts


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants(rows, least=3, slips=97):
    known = {w: n for w, n in word_counts(rows, slips=slips).items() if n >= least}
    near = {w: [v for v in known if one_apart(w, v)] for w in known}
    form = {w: min(near[w], key=lambda v: (-known[v], v)) if near[w] else None for w in known}
    form = {w: f if f and known[f] >= 2 * known[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (known[w], len(near[w]), form[w], known.get(form[w]), root(w)) for w in known}


def spelled(seed, letters="abé", most=9, words=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, most))) for _ in range(words)]
    return [(k, " ".join(rng.choice(base).title() if rng.random() < 0.2 else rng.choice(base) for _ in range(150)) + ".", "s")
            for k in range(12)] + [(None, " ".join(base), None)]


@pytest.mark.parametrize("seed, slips, common, blocks", [(1, 97, 2000, 4096), (2, 5, 3, 7), (3, 3, 10, 40), (4, 97, 1, 5)])
def test_variants_are_those_of_brute_force(spark, seed, slips, common, blocks):
    rows = ROWS + spelled(seed) + spelled(seed, "abcdefghij", 20, 60)
    got = spelling.group_variants(documents(spark, rows), slips=slips, common=common, block_words=blocks).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == variants(rows, slips=slips)
    assert len({r.word for r in got}) == len(got)


def test_very_long_and_repeated_words(spark):
    long = "abcde" * 3000
    rows = [(1, f"{long} {long} {long} {long}x {long}x {long}x {long}x {long}x {long}x"), (2, "word " * 2000 + "wordy " * 9)]
    rows = [(i, t, None) for i, t in rows]
    got = spelling.group_variants(documents(spark, rows), slips=10**9)
    assert {r.word: r.root for r in got.collect()} == {long: long + "x", long + "x": long + "x", "wordy": "wordy"}
    assert spelling.group_variants(empty(spark)).count() == 0
    assert spelling.group_variants(documents(spark, [(1, None, None), (2, "é 12", None)])).count() == 0


def test_no_edit_changes_more_grams_than_the_bound():
    rng = random.Random(9)
    for trial in range(12):
        letters = "ab" if trial % 2 else "abcd"
        words = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 14))) for _ in range(200)]
        places = Counter(w[p:p + q] for w in words for q in (2, 3, 4) for p in range(len(w) - q + 1))
        grams = spelling.Grams({g: n for g, n in places.items() if len(g) == 2 or places[g[:-1]] > 20 * trial})
        for word in words[:40]:
            cuts = grams.cut(word)
            bound = grams.changed(word, cuts)
            own = [(p, word[p:e]) for p, e in cuts]
            for i in range(len(word) + 1):
                edits = [word[:i] + c + word[i:] for c in letters + "z"]
                edits += [word[:i] + c + word[i + 1:] for c in letters + "z"] + [word[:i] + word[i + 1:]] if i < len(word) else []
                for other in edits:
                    shift = len(other) - len(word)
                    there = {(p, other[p:e]) for p, e in grams.cut(other)}
                    kept = sum((p, g) in there if p < i else (p + shift, g) in there for p, g in own)
                    assert kept >= len(cuts) - bound, (word, other)


def print_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def parts(rows, prints):
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(rows))]


@pytest.mark.parametrize("block", [1024, 2])
def test_simhash_components_are_those_of_brute_force(spark, block):
    base = [f"w{j}" for j in range(900)]
    near = [(300 + k, " ".join("other" if j == 17 * k else w for j, w in enumerate(base)), None) for k in range(40)]
    rows = ROWS + near + [(400, "one", None), (None, "One", None), (401, "one two", None), (402, "one\x0btwo x y", None)]
    prints = [print_of(t) for _, t, _ in rows]
    got = simhash.group_near(documents(spark, rows).repartition(5), block=block).collect()
    want = Counter((i, f"{p:016x}", c) for (i, *_), p, c in zip(rows, prints, parts(rows, prints), strict=True))
    assert Counter(map(tuple, got)) == want
    assert simhash.group_near(empty(spark)).count() == 0


def test_any_five_positions_hold_a_set():
    sets = [set(s) for s in simhash.position_sets()]
    assert all(any(s <= set(five) for s in sets) for five in itertools.combinations(range(8), 5))


@pytest.mark.parametrize("count", [1, 2, 150, 700])
def test_links_of_a_unit(count):
    import numpy as np
    rng = np.random.default_rng(count)
    centre = rng.integers(0, 1 << 62, size=max(1, count // 40), dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, size=(count, 4), dtype=np.uint64), axis=1)
    prints = np.unique(centre[rng.integers(0, len(centre), count)] ^ flips)
    got = simhash.linked(prints)
    want = parts([(k,) for k in range(len(prints))], prints.tolist())
    assert got[1].tolist() == [prints[k] for k in want]
