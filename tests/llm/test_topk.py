from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hackney.llm import queries, topk
from tests.llm.conftest import rows

VECTORS = "vec_id long, embedding array<float>"


def brute(vectors, k, every, scale=64.0):
    """Every row against every query in exact integers."""
    whole = [
        (i, [int(np.floor(float(np.float32(x)) * scale)) for x in v])
        for i, v in vectors
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in ((i, v) for i, v in whole if i % every == 0):
        scores = [
            (-sum(x * y for x, y in zip(a, b, strict=True)), i)
            for i, b in whole
            if i != q and len(a) == len(b)
        ]
        out += [(q, n + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows, query_rows", [(10_000, 10_000), (37, 5)])
@pytest.mark.parametrize("kind", ["normal", "clustered", "ties"])
def test_against_brute_force(spark, kind, block_rows, query_rows):
    draw = np.random.default_rng(4)
    data = draw.normal(0, 0.3, (300, 12))
    if kind == "clustered":
        data[:200] = data[0] + draw.normal(0, 0.02, (200, 12))
    elif kind == "ties":
        data = draw.integers(-1, 2, (300, 12)) / 64
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    found = topk.top_k(
        spark.createDataFrame(vectors, VECTORS), 7, 10, block_rows=block_rows, query_rows=query_rows
    )
    assert rows(found) == brute(vectors, 7, 10)


def test_large_magnitudes(spark):
    draw = np.random.default_rng(5)
    data = draw.normal(0, 1, (80, 6)) * 10.0 ** draw.integers(0, 5, (80, 6))
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    assert rows(topk.top_k(spark.createDataFrame(vectors, VECTORS), 5, 4)) == brute(vectors, 5, 4)


def test_components_of_a_million_and_repeated_ids(spark):
    """As the SQL counterpart has it; every row is a query, also of an id that is asked already."""
    draw = np.random.default_rng(8)
    data = draw.normal(0, 1e6, (120, 8))
    data[::7] /= 1e6
    vectors = [(i % 100, [float(x) for x in v]) for i, v in enumerate(data)]
    table = spark.createDataFrame(vectors, VECTORS)
    found = rows(topk.top_k(table, 20, 20, block_rows=30, query_rows=2))
    assert found == brute(vectors, 20, 20)
    import duckdb

    embeddings = table.toPandas()  # noqa: F841
    assert found == sorted(duckdb.sql(queries.OP6_SQL).fetchall())


@pytest.mark.parametrize("large", [3e5, 1e9, 1e17, 1e30, 1e300])
def test_products_beyond_64_bits(spark, large):
    draw = np.random.default_rng(9)
    data = draw.normal(0, 1, (60, 5)).astype(np.float32).astype(float)
    data[[0, 7, 20, 33]] *= large
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    wide = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    assert rows(topk.top_k(wide, 4, 10, block_rows=25)) == brute_double(vectors, 4, 10)


def brute_double(vectors, k, every):
    whole = [(i, [math.floor(x * 64) for x in v]) for i, v in vectors]
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = [(-min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1), i) for i, b in whole if i != q]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_a_block_is_indexed_once_for_all_queries(monkeypatch):
    draw = np.random.default_rng(10)
    data = draw.integers(-50, 50, (400, 8)).astype(float)
    index = topk.ImpactIndex(data, np.arange(400))
    assert sum(np.count_nonzero(s.values) for s in index.segments) == np.count_nonzero(data)
    for lo in range(0, 40, 10):
        for q, ids, scores in index.best(data[lo : lo + 10], np.arange(lo, lo + 10), 5):
            exact = data @ data[lo + q]
            exact[lo + q] = -np.inf
            order = np.lexsort((np.arange(400), -exact))[:5]
            assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]),
        (5, None), (6, []), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0]),
        (20, [0.0, 0.0]), (20, [0.0, 0.0]), (40, [2.0]), (9, [1e30, 0.0]),
    ]
    wide = spark.createDataFrame(vectors, VECTORS).withColumns(
        {c: F.lit(1) for c in ("vec", "row", "query", "rank", "score")}
    )
    assert rows(topk.top_k(wide, 3, 20)) == brute(vectors, 3, 20)
    assert rows(topk.top_k(wide.limit(0))) == []
    assert rows(topk.top_k(wide.where("vec_id = 1"))) == []


def test_stops_early_on_proof(monkeypatch):
    """Rows of small norm beside a few large ones: the coarse segments settle the matter."""
    draw = np.random.default_rng(6)
    data = draw.integers(-3, 4, (2000, 16))
    data[::100] *= 40
    asked = data[::100][:5]
    seen = []
    real = np.partition
    monkeypatch.setattr(topk.np, "partition", lambda *a, **b: seen.append(1) or real(*a, **b))
    found = list(topk.ImpactIndex(data.astype(float), np.arange(2000)).best(asked.astype(float), np.full(5, -1), 3))
    levels = len(np.unique(np.frexp(np.abs(data[data != 0]).astype(float))[1]))
    assert len(seen) < levels
    for q, ids, scores in found:
        exact = data @ asked[q]
        order = np.lexsort((np.arange(2000), -exact))[:3]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
