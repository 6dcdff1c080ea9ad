from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hackney.llm import divergence
from tests.llm.conftest import CLASHING, rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(documents, min_docs, top):
    read = [(l or "", s or "", TERM.findall((t or "").translate(LOWER))) for t, l, s in documents]
    holders = Counter((l, term) for l, _, terms in read for term in set(terms))
    kept = defaultdict(set)
    for (l, term), n in holders.items():
        if n >= min_docs:
            kept[l].add(term)
    groups = defaultdict(Counter)
    for l, s, terms in read:
        groups[l, s].update(t for t in terms if t in kept[l])
    langs = defaultdict(Counter)
    for (l, _), counts in groups.items():
        langs[l].update(counts)

    def shares(l, counts):
        total = sum(counts.values()) + 5 * len(kept[l])
        return {t: 1 + 1_000_000_000 * (counts[t] + 5) // total for t in kept[l]}

    out = []
    for (l, s), counts in groups.items():
        p, q = shares(l, counts), shares(l, langs[l])
        pairs = []
        for (l2, s2), others in groups.items():
            if l2 == l and s2 != s:
                other = shares(l, others)
                pairs.append((sum(abs(p[t] - other[t]) for t in kept[l]), s2))
        above = [(p[t] - q[t], t) for t, n in counts.items() if n and p[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", above, top)):
            ordered = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:limit]
            out += [(l, s, part, item, value, n) for n, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def made(seed, n, sources, alphabet="abcé字"):
    draw = random.Random(seed)
    words = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 12))) for _ in range(60)]
    words += [w + "x" * draw.randrange(40) for w in words[:20]]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [
        (draw.choice(" -1\n").join(draw.choices(words, weights, k=draw.randrange(30))).title(),
         draw.choice(["en", "de", "fr"]), f"s{int(draw.random() ** 2 * sources)}")
        for _ in range(n)
    ]


SCHEMA = "text string, lang string, source string"


def hard(seed):
    """Terms beyond a block, one term's prefix being another, and documents of no term."""
    long = "y" * 100 + " " + "y" * 101 + " y"
    return made(seed, 400, 12) + [(long, "en", "s1")] * 6 + [("123", "xx", "a"), ("", "xx", "b")]


def test_against_brute_force(spark):
    docs = spark.createDataFrame(hard(1), SCHEMA).repartition(3)
    assert rows(divergence.audit(docs, min_docs=6, top=5)) == brute(hard(1), 6, 5)


@pytest.mark.parametrize("block, summed", [(64, 300), (1, 1)])
def test_small_blocks_of_text(spark, block, summed):
    docs = spark.createDataFrame(hard(2), SCHEMA).repartition(3)
    one = divergence.term_counts(docs, min_docs=6)
    other = divergence.term_counts(docs, min_docs=6, block=block, summed=summed)
    assert rows(one) == rows(other)


def test_small_tiles(spark):
    docs = spark.createDataFrame(hard(3), SCHEMA)
    counts = divergence.term_counts(docs, min_docs=6)
    groups = docs.select("lang", "source").distinct()
    groups = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all")), ["lang", "source"], "left")
    groups = groups.join(counts.groupBy("lang").agg(F.count_distinct("term").alias("v")), "lang", "left").fillna(0)
    one = rows(divergence.distances(counts, groups))
    assert one == rows(divergence.distances(counts, groups, tile=3, terms=7)) and len(one) > 200


def test_threshold_counts_documents_not_occurrences(spark):
    documents = [("often often often", "en", "a")] * 2 + [("oftener rare", "en", "b")] * 3 + [("oft", "en", "b")]
    docs = spark.createDataFrame(documents, SCHEMA)
    counts = divergence.term_counts(docs, min_docs=3)
    assert rows(counts, "lang", "source", "term", "n") == [("en", "b", "oftener", 3), ("en", "b", "rare", 3)]


def test_rare_prefixes_leave_early(spark, monkeypatch):
    """Of the many rare terms none outlives the level at which its prefix is rare."""
    documents = [(f"common{chr(97 + i % 26) * 9} {chr(98 + i // 26)}{chr(97 + i % 26)}unusual", "en", "a") for i in range(400)]
    sizes = []
    real = divergence.stage

    def counted(df, label):
        staged = real(df, label)
        if label == "refined":
            sizes.append(staged.select("term").distinct().count())
        return staged

    monkeypatch.setattr(divergence, "stage", counted)
    kept = divergence.term_counts(spark.createDataFrame(documents, SCHEMA), min_docs=200)
    assert rows(kept) == []
    assert sizes[0] == 26 and sizes[-1] == 0


def test_large_counts_are_exact(spark):
    groups = spark.createDataFrame([("en", "a", 10**13, 2), ("en", "b", 0, 2)], "lang string, source string, n_all long, v long")
    counts = spark.createDataFrame(
        [("en", "a", "x", 9 * 10**12), ("en", "a", "y", 10**12)], "lang string, source string, term string, n long"
    )
    x, y = (1 + 10**9 * (n + 5) // (10**13 + 10) for n in (9 * 10**12, 10**12))
    zero = 1 + 10**9 * 5 // 10
    value = abs(x - zero) + abs(y - zero)
    assert rows(divergence.distances(counts, groups), "source", "item", "value") == [("a", "b", value), ("b", "a", value)]


def test_odd_rows(spark):
    documents = [(None, None, None), ("A a", None, "s"), ("a", "en", None), ("a", "en", "s")] * 2
    docs = spark.createDataFrame(documents, SCHEMA)
    wide = docs.withColumns({c: F.lit("x") for c in [*CLASHING, "term", "docs", "prefix", "share", "doc_id"]})
    assert rows(divergence.audit(wide, min_docs=2)) == brute(documents, 2, 50)
    assert rows(divergence.audit(wide.limit(0))) == []
