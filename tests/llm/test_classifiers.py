from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hackney.llm import quality, queries, toxicity
from tests.llm.conftest import CLASHING, rows

DATA = "/root/testdata/sf0.01"
GOOD = "The committee read the report and thanked its authors for their careful work this year"
BAD = "BUY!! NOW!! CHEAP!! PILLS!! BEST!! PRICE!! CLICK!! HERE!! FAST!!"


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.mark.parametrize(
    "query, label, modulus, held_out, least",
    [("op3_quality", "quality", 4, 2, 0.98), ("op5_toxicity", "toxic", 5, 0, 0.95)],
)
def test_held_out_accuracy(spark, query, label, modulus, held_out, least):
    found = queries.queries()[query](spark, DATA).toPandas()
    labels = pd.read_parquet(f"{DATA}/labels.parquet")
    documents = pd.read_parquet(f"{DATA}/documents.parquet")
    assert sorted(found.doc_id) == sorted(documents.doc_id)
    assert found.score.between(0, 1).all()
    assert (found.held_out == [remainder(i, modulus) == held_out for i in found.doc_id]).all()
    both = found[found.held_out].merge(labels, on="doc_id")
    assert len(both) > 50
    assert (both.predicted == both[label]).mean() >= least


@pytest.mark.parametrize("module, query", [(quality, "op3_quality"), (toxicity, "op5_toxicity")])
def test_held_out_labels_and_columns_are_not_read(spark, module, query):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    name, modulus, fold = ("quality", 4, 2) if module is quality else ("toxic", 5, 0)
    out = F.crc32(F.col("doc_id").cast("string")) % modulus == fold
    changed = labels.withColumn(name, F.when(out, 1 - F.col(name)).otherwise(F.col(name)))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None), "n_chars": F.lit(0)})
    assert rows(module.classify(docs, labels)) == rows(module.classify(other, changed))


def examples(make_docs, spark, n=60):
    """Good texts with even ids, bad ones with odd ids, all labelled."""
    docs = make_docs(*[(i, f"{BAD} {i}" if i % 2 else f"{GOOD} {i}") for i in range(n)])
    labels = spark.createDataFrame(
        [(i, 1 - i % 2, i % 2) for i in range(n)], "doc_id long, quality int, toxic int"
    )
    return docs, labels


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, make_docs, module):
    docs, labels = examples(make_docs, spark)
    odd = make_docs((1000, None), (1001, ""), (None, GOOD), (2, GOOD), (2, GOOD), (1002, " é" * 3))
    every = docs.unionByName(odd)
    bad_labels = labels.unionByName(
        spark.createDataFrame(
            [(None, 1, 1), (5, None, None), (0, 7, 7), (3, 0, 1)],
            "doc_id long, quality int, toxic int",
        )
    )
    wide = every.withColumns({c: F.lit("x") for c in CLASHING if c not in every.columns})
    found = module.classify(wide, bad_labels).toPandas()
    assert len(found) == 66 and found.score.between(0, 1).all()
    by_id = found.set_index("doc_id").score
    assert by_id[1000] == by_id[1001]
    assert found[found.doc_id.isna()].held_out.tolist() == [False]
    assert len(found[found.doc_id == 2]) == 3
    right = 1 if module is quality else 0
    assert (by_id[4] > 0.5) == bool(right) and (by_id[5] > 0.5) != bool(right)
    kept = module.rows_with_score(wide, module.fit(wide, bad_labels)).select("row.*")
    assert kept.columns == wide.columns and kept.count() == 66


@pytest.mark.parametrize("module", [quality, toxicity])
def test_nothing_to_learn_from(spark, make_docs, module):
    docs, labels = examples(make_docs, spark, 8)
    none = labels.limit(0)
    assert {r.score for r in module.classify(docs, none).collect()} == {0.5}
    assert module.fit(docs, none).unfitted
    assert module.classify(docs.limit(0), labels).count() == 0
    name = "quality" if module is quality else "toxic"
    ones = labels.withColumn(name, F.lit(1))
    assert all(r.score > 0.5 for r in module.classify(docs, ones).collect())


@pytest.mark.parametrize("max_rows", [3000, 120, 60])
def test_quality_scores_keep_the_share_of_the_labels(spark, make_docs, max_rows):
    """One in ten is bad, however many of the good ones the sample holds."""
    docs = make_docs(*[(i, f"{BAD} {i}" if i % 10 == 0 else f"{GOOD} {i}") for i in range(600)])
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(600)], "doc_id long, quality int")
    model = quality.fit(docs, labels, max_rows=max_rows)
    empty, good, bad = quality.score_column(pa.array(["", GOOD, BAD]), model)
    assert empty == pytest.approx(0.9, abs=0.02) and good > 0.9 and bad < 0.3


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_absent_documents_take_no_place(spark, make_docs, module):
    docs, labels = examples(make_docs, spark)
    absent = spark.range(1000, 9000).selectExpr(
        "id as doc_id", "int(id % 9 = 0) as quality", "int(id % 9 = 0) as toxic"
    )
    every = docs.unionByName(make_docs(*[(i, None) for i in range(1000, 1500)]))
    alone, beside = (
        module.fit(every, given, max_rows=60) for given in (labels, labels.unionByName(absent))
    )
    assert not beside.unfitted
    texts = pa.array([GOOD, BAD, ""])
    assert (module.score_column(texts, alone) == module.score_column(texts, beside)).all()


def test_long_texts_come_in_blocks(monkeypatch):
    text = " ".join([GOOD] * 50)
    model = quality.QualityModel(
        np.random.default_rng(0).normal(size=1 << 10).astype(np.float32), 0.0
    )
    whole = quality.score_column(pa.array([text, "a b"]), model)
    from hackney.llm import common

    small = list(common.blocks(*common.utf8_rows(pa.array([text, "a b", None])), size=100))
    assert len(small) > 40
    assert b"".join(part.tobytes() for _, part, _ in small).decode() == text + "a b"
    monkeypatch.setattr(
        quality, "blocks", lambda data, bounds: common.blocks(data, bounds, size=200)
    )
    cut = quality.score_column(pa.array([text, "a b"]), model)
    assert abs(cut - whole).max() < 0.05  # only pairs and border marks at the cuts differ


def test_pairs_of_terms_beat_weights():
    """Toxic only if an insult and a group stand together: no sum of weights can tell."""
    draw = np.random.default_rng(3)
    names = {w: np.uint64(k + 1) for k, w in enumerate(["insult", "group", "a", "b", "c"])}
    examples = []
    for k in range(400):
        chosen = {"insult": k % 4 in (1, 3), "group": k % 4 in (2, 3)}
        terms = [names[w] for w, yes in chosen.items() if yes]
        terms += [names[w] for w in "abc" if draw.random() < 0.5]
        examples.append((np.sort(np.array(terms, np.uint64)), int(k % 4 == 3)))
    model = toxicity.train(examples, epochs=200, least_ratio=0.0)
    lengths = [len(t) for t, _ in examples]
    scores = model.scores(
        np.repeat(np.arange(400), lengths),
        np.searchsorted(model.terms, np.concatenate([t for t, _ in examples])),
        400,
    )
    assert ((scores >= 0.5) == [label for _, label in examples]).mean() > 0.97


def pair_texts(seed, n=2000):
    """Toxic by an insult beside a group, each as frequent elsewhere, or by one strong word."""
    draw = np.random.default_rng(seed)
    words = np.array([f"w{k}" for k in range(500)])
    for _ in range(n):
        text = [*draw.choice(words, draw.integers(20, 60))]
        kind = draw.choice(["pair", "strong", "insult", "group", "none"], p=[0.06, 0.1, 0.08, 0.08, 0.68])
        text += {"pair": ["insult", "group"], "strong": ["vile"], "none": []}.get(kind, [kind])
        yield " ".join(draw.permutation(text)), int(kind in ("pair", "strong")), kind


def test_pairs_without_margins_of_their_own_are_found():
    """With the settings of the query: neither term of the pair tells the classes apart."""

    def examples(texts):
        return [(h, y) for h, (_, y, _) in zip(toxicity.document_terms(pa.array([t for t, *_ in texts])), texts)]

    learned, asked = list(pair_texts(1)), list(pair_texts(2))
    model = toxicity.train(examples(learned))
    scores = toxicity.score_column(pa.array([t for t, *_ in asked]), model)
    kinds = np.array([k for *_, k in asked])
    assert (scores[kinds == "pair"] >= 0.5).mean() > 0.99 and (scores[kinds == "strong"] >= 0.5).mean() > 0.99
    assert (scores[(kinds != "pair") & (kinds != "strong")] < 0.5).mean() > 0.99


def test_pair_terms_by_brute_force():
    draw = np.random.default_rng(4)
    present = draw.random((300, 12)) < 0.4
    labels = (present[:, 2] & present[:, 5] | (draw.random(300) < 0.05)).astype(float)
    rows, terms = np.nonzero(present)
    toxic, clean = int(labels.sum()), int(300 - labels.sum())

    def ratio(has):
        return float(toxicity.likelihood_ratio(np.array([labels[has].sum()]), np.array([(1 - labels)[has].sum()]), toxic, clean)[0])

    alone = np.array([ratio(present[:, k]) for k in range(12)])
    want = set()
    for a in range(12):
        for b in range(a):
            both = present[:, a] & present[:, b]
            more = labels[both].sum() * clean > (1 - labels)[both].sum() * toxic
            if more and ratio(both) >= max(alone[a], alone[b]) + 10:
                want |= {a, b}
    found = toxicity.telling_pairs(rows, terms, labels, alone, 10.0)
    assert want >= {2, 5} and set(found.tolist()) == want


def test_scores_by_the_machines_formula():
    """Weights and all products of two vectors, one by one."""
    texts = [t for t, *_ in pair_texts(3, 30)] + ["", None, "vile " * 500, "insult group insult"]
    model = toxicity.train(
        [(h, y) for h, (_, y, _) in zip(toxicity.document_terms(pa.array([t for t, *_ in pair_texts(1)])), pair_texts(1))]
    )
    scores = toxicity.score_column(pa.array(texts), model)
    for text, score in zip(toxicity.document_terms(pa.array(texts)), scores):
        at = [k for k, term in enumerate(model.terms) if term in set(text.tolist())]
        raw = model.bias + sum(model.weights[k] for k in at)
        raw += sum(model.vectors[i] @ model.vectors[j] for n, i in enumerate(at) for j in at[:n])
        assert score == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-9)


def test_counting_is_bounded():
    """Counts take memory by the block, not by all texts of a batch, and are those of each text alone."""
    odd = [None, "", "a", "xy z" * 400_000, "b b b", "", None]
    found = quality.document_counts(pa.array(odd), 1 << 17)
    assert len(found) == len(odd)
    for text, (buckets, counts) in zip(odd, found, strict=True):
        [(alone, times)] = quality.document_counts(pa.array([text], pa.string()), 1 << 17)
        assert buckets.tolist() == alone.tolist() and counts.tolist() == times.tolist()
    peaks = []
    for n in (2_000, 8_000):
        texts = pa.array(["lorem ipsum dolor sit amet " * 40] * n)
        tracemalloc.start()
        quality.document_counts(texts, 1 << 17)
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert peaks[1] < 1.8 * peaks[0]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_texts_go_to_python_once(spark, module, monkeypatch):
    """A row's text is read from the row, by whatever case its column is named."""
    wide = spark.range(0, 1_000, 1, 1).select("id", F.repeat(F.lit("w "), 1000).alias("Text"))
    model = quality.QualityModel(np.zeros(2, np.float32), 0.0)
    monkeypatch.setattr(module, "score_column", lambda column, _: np.full(len(column), 0.25))
    scored = module.rows_with_score(wide, model, "text")
    assert scored._jdf.queryExecution().analyzed().children().head().output().size() == 1
    assert scored.select("row.*").exceptAll(wide).isEmpty()
