from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hackney.llm import common, suffix_tree
from tests.llm.conftest import CLASHING, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base_scores(docs):
    counts = Counter()
    for i, t in docs:
        if i is not None and not held(i):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    return n, [
        (
            i,
            held(i),
            len(tokens(t)),
            sum(counts[w] > 0 for w in tokens(t)),
            sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)),
        )
        for i, t in docs
    ]


def check_base(found, docs):
    n, want = base_scores(docs)
    got = sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id, r.n_tokens))
    want.sort(key=lambda r: (r[0] is not None, r[0], r[2]))
    assert len(got) == len(want)
    for r, (i, h, size, known, base) in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, h, size, known, n)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert math.isfinite(r.score) and r.score <= 0


@pytest.mark.parametrize("common_share", [1e-6, 1e-2, 1.1])
def test_documents(spark, common_share):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = suffix_tree.score_documents(docs, common_share=common_share).collect()
    check_base(found, [(r.doc_id, r.text) for r in docs.collect()])
    # The base grants its chance to each word never seen, so its chances add up to more than 1; against
    # the same with that chance spread over spellings the tree gains much.
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = Counter(t for i, text in texts.items() if not held(i) for t in tokens(text))
    spread = sum(
        len(t.encode()) * math.log10(256) for i, text in texts.items() if held(i) for t in tokens(text) if not known[t]
    )
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) - 0.7 * spread


def test_held_out_texts_gain_over_the_base_with_more_to_learn_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = suffix_tree.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def plain_counts(texts, depth):
    """Contexts with next symbols, by the definition."""
    counts = Counter()
    for text in texts:
        stream = b"\n" + b"".join(w.encode() + b" " for w in tokens(text)[:-1]) + b"\n"
        for k in range(1, len(stream)):
            for length in range(min(depth, k) + 1):
                counts[length, stream[k - length : k], stream[k]] += 1
    return counts


def test_tree_by_definition(spark):
    texts = ["the cat sat on the mat", "The cat, the hat", "", "é on", "at at at at the cat"] * 4
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    grams = suffix_tree.corpus_counts(frame).where(F.col("kind") == suffix_tree.GRAMS)
    retained = suffix_tree.tree_counts(grams.select("key", "n"), 1e-3)
    counts = plain_counts(texts, suffix_tree.DEPTH)
    got = {
        (r.length, r.context.to_bytes(r.length, "big"), r.symbol): r.n for r in retained.collect()
    }
    assert got and all(counts[k] == n for k, n in got.items())
    # The divergence test, context by context.
    totals, followers = Counter(), Counter()
    for (length, context, _), n in counts.items():
        totals[length, context] += n
        followers[length, context] += 1
    states = {(0, b"")}
    for (length, context), total in totals.items():
        if length and total >= 1e-3 * totals[0, b""]:
            up = (length - 1, context[1:])
            gain = sum(
                n * math.log(n / total / (counts[(*up, s)] / totals[up]))
                for (m, c, s), n in counts.items()
                if (m, c) == (length, context)
            )
            if gain >= 0.5 * followers[length, context] * math.log(total):
                states |= {(k, context[length - k :]) for k in range(length + 1)}
    assert {(length, context) for length, context, _ in got} == states

    tree = suffix_tree.build_tree(retained)
    assert tree.states == len(states)

    def chance(context, symbol):
        """Smoothed from the longest state down to the floor."""
        p = (counts[0, b"", symbol] + 0.5) / (totals[0, b""] + 128)
        for k in range(1, len(context) + 1):
            key = (k, context[len(context) - k :])
            if key not in states:
                break
            p = (counts[(*key, symbol)] + followers[key] * p) / (totals[key] + followers[key])
        return p

    for text in [*texts[:5], "zebra the cat", "ÿ"]:
        (block,) = suffix_tree.symbol_streams(pa.array([text]), tree.depth)
        stream, _, counted = block[:3]
        raw = stream.tobytes()
        logs = tree.score(stream)
        for k in np.flatnonzero(counted):
            want = math.log10(chance(raw[max(0, k - tree.depth) : k], raw[k]))
            assert logs[k] == pytest.approx(want, abs=1e-5)
    # Chances of all symbols after any context add up to one.
    unseen = 256 - (tree.symbols - 1)
    each = 10.0 ** tree.logs.reshape(tree.states, tree.symbols).astype(float)
    assert each[:, 1:].sum(1) + unseen * each[:, 0] == pytest.approx(1.0, abs=1e-5)


def test_held_out_texts_are_not_learned(spark, make_docs):
    docs = [(i, f"some text of number {i} and more") for i in range(40)]
    other = [(i, "quite another text" if held(i) else t) for i, t in docs]
    a, b = (
        {r.doc_id: (r.base_score, r.score) for r in suffix_tree.score_documents(make_docs(*d)).collect()}
        for d in (docs, other)
    )
    assert any(held(i) for i, _ in docs)
    assert all(a[i] == b[i] for i, _ in docs if not held(i))


def test_long_texts_carry_their_context(monkeypatch):
    text = "alpha beta gamma delta epsilon " * 40
    parts = list(suffix_tree.symbol_streams(pa.array([text, "x y", ""]), 5))
    whole = {k: np.concatenate([p[1][p[2]] if k == "row" else suffix_tree.gram_keys(p[0], p[2], 5) for p in parts]) for k in ("row", "keys")}
    monkeypatch.setattr(suffix_tree, "blocks", lambda d, b: common.blocks(d, b, size=100))
    cut = list(suffix_tree.symbol_streams(pa.array([text, "x y", ""]), 5))
    assert len(cut) > 5
    keys = np.concatenate([suffix_tree.gram_keys(p[0], p[2], 5) for p in cut])
    assert (keys == whole["keys"]).all()


def test_odd_rows(spark, make_docs):
    docs = [(1, None), (2, ""), (None, "a b"), (3, "A a"), (3, "A a"), (3, "a\x0bb\x85"), (4, "w " * 9000)]
    docs += [(k, "a text to learn from") for k in range(10, 30)]
    wide = make_docs(*docs).withColumns({c: F.lit(1) for c in CLASHING})
    found = suffix_tree.score_documents(wide).collect()
    check_base(found, docs)
    assert rows(suffix_tree.score_documents(wide.limit(0))) == []
    alone = suffix_tree.score_documents(make_docs((None, "a b"), (None, None))).collect()
    assert [(r.train_tokens, r.base_score) for r in alone] == [(0, 0.0), (0, 0.0)]


LEARNED = [(k, t) for k, t in enumerate(["the cat sat on the mat", "a cat", "the dog and the cat ran", ""] * 30)]


@pytest.mark.parametrize("common_share", [1e-6, 2.0])
def test_scores_by_definition(spark, make_docs, common_share):
    """Half the tree's chance of each token and half its share of the training tokens."""
    asked = ["the cat", "the unseen cat", "", "zebra " * 3, "mat " + "long" * 400]
    docs = make_docs(*LEARNED, *[(None, t) for t in asked])
    found = suffix_tree.score_documents(docs, common_share=common_share).collect()
    training = [t for k, t in LEARNED if not held(k)]
    seen = Counter(t for text in training for t in tokens(text))
    total = sum(seen.values())
    frame = spark.createDataFrame([(t,) for t in training], "text string")
    grams = suffix_tree.corpus_counts(frame).where(F.col("kind") == suffix_tree.GRAMS)
    tree = suffix_tree.build_tree(suffix_tree.tree_counts(grams.select("key", "n"), 1e-5))
    want = []
    for text in asked:
        (block,) = suffix_tree.symbol_streams(pa.array([text]), tree.depth)
        logs = suffix_tree.token_logs(tree, block[0], block[2])
        want.append(sum(
            math.log10(0.5 * 10**log + 0.5 * seen[token] / total) if seen[token] else log + math.log10(0.5)
            for token, log in zip(tokens(text), logs.tolist(), strict=True)
        ))
    got = sorted(r.score for r in found if r.doc_id is None)
    assert got == pytest.approx(sorted(want), rel=1e-6)


def test_chances_of_texts_add_up_to_less_than_one(make_docs):
    letters = "abcdehmnorstu"
    texts = ["", *letters, *(a + b for a in letters for b in letters), "the cat", "a cat", "the", "cat", "é", "ÿ"]
    texts += [t for _, t in LEARNED[:3]]
    found = suffix_tree.score_documents(make_docs(*LEARNED, *[(None, t) for t in dict.fromkeys(texts)])).collect()
    mass = sum(10**r.score for r in found if r.doc_id is None)
    assert 0.1 < mass < 1


def test_unseen_words_cost_by_their_length(make_docs):
    words = ["q" * n for n in (1, 5, 50, 500, 5000)]
    docs = make_docs(*LEARNED, *[(None, w) for w in words])
    found = suffix_tree.score_documents(docs).collect()
    scores = sorted((r.score for r in found if r.doc_id is None), reverse=True)
    assert len(set(scores)) == 5
    assert -20_000 < scores[-1] < -5_000 < scores[-2] < -500 < scores[-3] < -50


def test_untrained_symbols_are_equally_likely(make_docs):
    found = suffix_tree.score_documents(make_docs((None, "a b c"), (None, None))).collect()
    assert sorted(r.score for r in found) == pytest.approx([-7 * math.log10(256), -math.log10(256)])
