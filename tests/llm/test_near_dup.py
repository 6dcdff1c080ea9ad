from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hackney.llm import near_dup
from hackney.llm.components import components
from tests.llm.conftest import CLASHING, rows


def shingle_set(text, size=5):
    parts = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
    return {tuple(parts[i : i + size]) for i in range(max(1, len(parts) - size + 1))} if parts else set()


def brute(docs, similarity=0.8):
    """Classes by comparing all pairs."""
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [None if i is None or t is None else shingle_set(t) for i, t in docs]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a is None or b is None:
                continue
            both = len(a & b)
            if a == b or both >= similarity * (len(a) + len(b) - both):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for k, (i, _) in enumerate(docs):
        if sets[k] is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    found = [
        (i, i if sets[k] is None else least[root(k)]) for k, (i, _) in enumerate(docs)
    ]
    return sorted(found, key=lambda r: (r[0] is not None, r))


def corpus(seed, n=12):
    """Originals, exact copies, copies with some words changed, and copies of those."""
    draw = random.Random(seed)

    def text(k):
        return [draw.choice("abcdefghij") + str(draw.randint(0, 40)) for _ in range(k)]

    docs = []
    for _ in range(n):
        words = text(draw.choice([3, 8, 60, 300]))
        docs.append(" ".join(words))
        for _ in range(draw.randint(0, 4)):
            for _ in range(draw.choice([0, 1, 1, 3])):
                words[draw.randrange(len(words))] = "new" + str(draw.randint(0, 999))
            docs.append(" ".join(words))
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(make_docs, seed):
    docs = corpus(seed)
    found = near_dup.classes(make_docs(*docs)).select("doc_id", "class_id")
    assert rows(found) == brute(docs)
    assert len({c for _, c in rows(found)}) < len(docs)


def test_a_chain_is_one_class(make_docs):
    """Each text is near the next only; the ends have little in common."""
    words = [f"w{k}" for k in range(120)]
    docs = []
    for k in range(30):
        docs.append((k, " ".join(words)))
        words = [*words[6:], *(f"v{k}x{j}" for j in range(6))]
    assert {c for _, c in brute(docs)} == {0}
    found = near_dup.classes(make_docs(*docs))
    assert {r.class_id for r in found.collect()} == {0}


def test_odd_rows(spark, make_docs):
    long = " ".join(f"w{k % 7919}" for k in range(60_000))
    docs = [(5, None), (6, None), (None, "x y"), (7, ""), (8, " \n "), (9, "x y"), (3, "x  y"),
            (4, "X Y"), (10, long), (11, long + " end"), (3, "x  y"), (12, "a " * 50)]
    wide = make_docs(*docs).withColumns({c: F.lit(1) for c in CLASHING})
    assert rows(near_dup.classes(wide), "doc_id", "class_id") == brute(docs)
    kept = near_dup.keep_one(wide)
    assert kept.columns == wide.columns
    assert rows(kept, "doc_id") == [(None,), (3,), (4,), (5,), (6,), (7,), (10,), (12,)]
    assert rows(near_dup.classes(wide.limit(0))) == []
    assert rows(near_dup.keep_one(wide.limit(0))) == []


def test_repeated_ids_with_other_texts(make_docs):
    one, other = "a b c d e f g", "q r s t u v w"
    docs = make_docs((1, one), (1, other), (2, other), (2, one), (3, one), (1, one))
    assert sorted((r.doc_id, r.text) for r in near_dup.keep_one(docs).collect()) == [
        (1, one),
        (1, other),
    ]


def test_batches_are_bounded_by_bytes(spark, make_docs, monkeypatch):
    """What goes to Python at once does not follow the width of texts and shingle sets."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, write, most = spark.conf.get(key), near_dup.stage, {}

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 6_000, 1, 1).select(F.repeat(F.lit("w "), 1000).alias("text"))

    def measured(df, label):
        if label not in most:
            most[label] = wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
        return write(df, label)

    monkeypatch.setattr(near_dup, "stage", measured)
    near_dup.keep_one(make_docs(*corpus(0), (0, "another text"), (1, "one more"))).collect()
    for label in ("signatures", "shingles", "links", "near", "several"):
        assert most[label] < 5 << 20, label
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("shared", [0.2, 0.5, 0.8, 0.95])
def test_signatures_estimate_similarity(shared):
    draw = np.random.default_rng(1)
    n = 400
    common = round(2 * n * shared / (1 + shared))
    a = draw.integers(0, 1 << 63, n).astype(np.uint64)
    b = np.concatenate([a[:common], draw.integers(0, 1 << 63, n - common).astype(np.uint64)])
    signed = near_dup.dart_signatures(
        np.concatenate([a, b, a[::-1], np.repeat(a, 3)]), None, np.cumsum([0, n, n, n, 3 * n]), 1600
    )
    exact = common / (2 * n - common)
    assert abs((signed[0] == signed[1]).mean() - exact) < 0.05
    assert (signed[0] == signed[2]).all() and (signed[0] == signed[3]).all()


def test_weighted_signatures():
    draw = np.random.default_rng(2)
    elements = draw.integers(0, 1 << 63, 60).astype(np.uint64)
    x, y = draw.uniform(0.2, 6, 60), draw.uniform(0.2, 6, 60)
    signed = near_dup.dart_signatures(
        np.concatenate([elements, elements]), np.concatenate([x, y]), np.array([0, 60, 120]), 3000
    )
    exact = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((signed[0] == signed[1]).mean() - exact) < 0.04


def test_small_sets_fill_their_signatures():
    signed = near_dup.dart_signatures(np.array([7, 8, 9], np.uint64), None, np.array([0, 1, 1, 3]), 160)
    assert (signed[[0, 2]] != 0).all() and (signed[1] == 0).all()


def test_blocks_do_not_change_words(monkeypatch):
    from hackney.llm import common

    texts = pa.array(["some words of a text " * 30, None, "", "x", "tail end"])
    whole = near_dup.row_words(texts)
    monkeypatch.setattr(near_dup, "blocks", lambda d, b: common.blocks(d, b, size=40))
    cut = near_dup.row_words(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(40)]
    edges += [(k, k + 1) for k in range(100, 140)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    touched = {x for a, b in edges if a != b for x in (a, b)}
    want = sorted((x, root(x)) for x in touched)
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(found, "node", "component") == want
