from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from hackney.llm import decontaminate, queries
from tests.llm.conftest import CLASHING, rows

ITEMS = "item_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window=13, share=20):
    out = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for item_id, item in items:
            parts = words(item)
            n = min(window, len(parts))
            if not n or item_id is None:
                continue
            for b in range(len(parts) - n + 1):
                for s in range(len(own) - n + 1):
                    if own[s : s + n] == parts[b : b + n]:
                        hit.update(range(s, s + n))
                        names.add(str(item_id))
        bad = bool(hit) and share * len(hit) >= len(own)
        out.append((doc_id, len(own), len(hit), sorted(names), bad))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def test_the_sql_gives_the_same(spark):
    data = "/root/testdata/sf0.01"
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.execute(f"create view {name} as select * from '{data}/{name}.parquet'")
    found = queries.op9_decontaminate(spark, data)
    want = base.execute(
        f"select {', '.join(found.columns)} from ({queries.OP9_SQL}) order by doc_id"
    ).fetchall()
    assert rows(found) == want
    assert sum(r[-1] for r in want) > 5


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    """Few different words, so that windows overlap, repeat and share their rarest words."""
    draw = random.Random(seed)

    def text(n):
        return " ".join(draw.choices(["a", "b", "c", "É", "É é", "x1", "Long-er"], k=n))

    items = [(k, text(draw.choice([1, 3, 5, 8]))) for k in range(6)]
    docs = [(k, text(draw.randint(0, 60))) for k in range(25)]
    docs += [(100 + k, f"{text(9)}, {item.upper()}! {text(4)}") for k, item in items]
    found = decontaminate.judge(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, ITEMS),
        window=4,
    )
    assert rows(found) == brute(docs, items, window=4)


def test_odd_rows(spark, make_docs):
    passage = " ".join(f"word{k}" for k in range(20))
    docs = [(1, None), (2, ""), (None, passage), (3, passage), (3, passage), (4, "... --- ..."),
            (5, ("filler " * 30_000) + passage), (6, passage.upper()), (7, passage.replace(" ", "\n--"))]
    items = [(1, passage), (1, passage), (2, None), (None, "filler"), (3, ""), (4, "word1 word3")]
    frame = make_docs(*docs)
    bench = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit(1) for c in CLASHING})
    wide = frame.withColumns({c: F.lit(1) for c in [*CLASHING, "candidates", "n_words", "item_id"]})
    assert rows(decontaminate.judge(wide, bench)) == brute(docs, items)
    kept = decontaminate.clean(wide, bench)
    assert kept.columns == wide.columns
    assert rows(kept, "doc_id") == [(1,), (2,), (4,), (5,)]
    assert rows(decontaminate.judge(wide.limit(0), bench)) == []
    assert all(r[2:] == (0, [], False) for r in rows(decontaminate.judge(wide, bench.limit(0))))


def test_no_python_in_the_plan(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c")], ITEMS)
    plan = decontaminate.judge(make_docs((1, "x a b c")), bench)._jdf.queryExecution()
    assert "Python" not in plan.executedPlan().toString()
    assert "Arrow" not in plan.executedPlan().toString()
