import math
from collections import Counter

import corpus_pipeline
import pytest
from cases import LONG, ROWS, documents, empty, untouched

from leadsieve.llm import exact_dedup, mixing, ngram_join, toxicity


def words(k):
    return " ".join(f"w{k * 7 + j}" for j in range(30))


def corpus():
    rows = [(1000 + k, words(k) + (" nasty deed" if k % 5 == 0 else " kind deed"), "en") for k in range(300)]
    rows += [(2000 + k, t + " ", "en") for k, (_, t, _) in enumerate(rows[1:40])]  # copies but for white space
    rows += [(3000 + k, t + " end", "en") for k, (_, t, _) in enumerate(rows[40:60])]  # near copies
    return rows


def labels_of(spark, rows):
    return spark.createDataFrame([(i, i % 2, int("nasty" in t)) for i, t, _ in rows], "doc_id long, quality int, toxic int")


def test_rows_keep_all_columns(spark):
    docs = documents(spark)
    model = mixing.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for left in (exact_dedup.drop_copies(docs), ngram_join.drop_near_copies(docs), mixing.mixed_rows(docs, model, {"all": 1})):
        assert left.schema == docs.schema and untouched(left.collect())
        assert {(r.doc_id, r.text, r.row) for r in left.collect()} <= {(i, t, s) for i, t, s in ROWS}


def test_pipeline_on_awkward_rows(spark, tmp_path):
    rows = corpus() + ROWS
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of(spark, corpus()).write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = Counter(r.doc_id for r in got)
    clean = {i for i, t, _ in corpus() if "nasty" not in t and 1039 < i < 2000}
    assert not {i for i, t, _ in corpus() if "nasty" in t} & set(ids)
    # Of a copy but for white space the longer one stays, of near copies the smaller id.
    assert not {i for i in ids if i and i >= 3000 or i in range(1001, 1040)}
    assert {2000 + k for k in range(39) if (k + 1) % 5} <= set(ids)
    assert clean <= set(ids) and {4, 6, 9, 10, None} <= set(ids)
    assert sum(r.n_tokens for r in got if r.doc_id == 7) + sum(r.n_tokens for r in got if r.doc_id == 8) > len(LONG) / 10


def test_pipeline_on_empty_tables(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    labels_of(spark, []).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def votes(docs, labels, model):
    """Brute force: every document against every example, TF-IDF cosines over the model's terms on whole texts."""
    def counts(text):
        return Counter(t for t in map(toxicity.term_of, toxicity.words_of(text or "")) if t in model.terms)

    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + sum(t in counts(x) for _, x, _ in docs))) + 1 for t in model.terms}

    def unit(text):
        raw = {t: (1 + math.log(c)) * idf[t] for t, c in counts(text).items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / norm for t, w in raw.items()}

    examples: dict[tuple, list] = {}
    for i, text, _ in docs:
        if i in labels and unit(text):
            entry = examples.setdefault(tuple(sorted(unit(text).items())), [0, 0])
            entry[labels[i]] += 1

    def nearest(text):
        own = unit(text)
        sims = [(round(sum(own.get(t, 0) * w for t, w in v), 9), c) for v, c in examples.items()]
        return sorted((s for s, _ in sims if s > 0), reverse=True)[:model.neighbours]

    return nearest


def test_neighbours_on_whole_texts_are_those_of_brute_force(spark):
    import zlib
    rows = [(k, " ".join([f"bad{k % 7}" * (k % 3 == 0), f"worse{k % 4}" * (k % 6 == 0), words(k), f"often{k % 2}"]), "en") for k in range(400)]
    table = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, *_ in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, rows), table)
    known = {i: int(i % 3 == 0) for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    nearest = votes(rows, known, model)
    assert any(t.startswith("bad") for t in model.terms)
    for _, text, _ in rows[::9]:
        found = toxicity.term_counts(text, toxicity._finder(model.terms))
        if found:
            got = [round(s, 9) for _, s in model.index.nearest(model.vector(found), model.neighbours)]
            assert got == pytest.approx(nearest(text), abs=1e-8)


def test_a_word_that_goes_weakly_with_the_label_counts(spark):
    rows = [(k, words(k) + (" shady" if (k % 4 == 0 and k % 3) or (k % 4 and k % 6 == 1) else " plain"), "en") for k in range(3000)]
    table = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, *_ in rows], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    model = toxicity.fit(docs, table)
    assert "shady" in model.terms  # four times as common with label 1
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    shady = [scores[i] for i, t, _ in rows if "shady" in t]
    assert min(shady) > max(scores[i] for i, t, _ in rows if "shady" not in t)
