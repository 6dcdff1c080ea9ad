"""Exact top-k inner products by an impact-ordered index, read a score at a time.

Components become integers, floor(scale * x). A block of rows is indexed by impact: a posting is a row
and dimension with a value, and a segment holds all postings whose magnitude has the same number of
bits, by the rows and dimensions that have any. Segments are processed in descending impact for a block
of queries, each adding to the accumulated scores. What the unprocessed segments can still add or take is
bounded by the product of the query's norm and the norm of the row's unprocessed postings. Once the k-th
best lower bound of a query excludes all but a few rows, by that proof and nothing else, processing
stops, and the possible members are scored again in exact integers.

Rows are dealt into blocks of about `block_rows` at random. A block is indexed once, in one task, which
then reads all queries, a block of them at a time; each gives k rows per query, of which the best k
remain. So no task holds more than a block of either side, whatever the tables hold, and only the
queries are sent more than once.

Rows and queries whose products could leave 64 bits do not take part in the index; they are scored one by
one in integers of any size.

Defined results: a vector that is null, empty, or holds null or non-finite components takes no part, nor
does a null id. Vectors of another length than the query's are no candidates of it. Each row is a query
or candidate of its own, so a repeated id may be listed twice and is asked as often as it occurs; rows
that share the query's id are its own and no candidates. Ties go to the smaller id. Scores beyond a long
are given as its ends, and tie there with each other. Empty tables give no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.session import stage

FEW = 0.02  # share of a block's rows up to which scoring the possible members again is cheaper
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """`vec_id` and the integer components as `vec`, which doubles hold without rounding; rows that take
    no part are left out."""
    rows = pick(df, vec_id=id_col, raw=vector_col).select(
        F.col("vec_id").cast("long"), F.transform("raw", lambda x: x.cast("double") * scale).alias("raw")
    )

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    # Doubles of 2**53 and more are integers; `floor` gives a long.
    def floor(x):
        return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)

    return rows.where(
        F.col("vec_id").isNotNull() & (F.size("raw") > 0) & F.forall("raw", finite)
    ).select("vec_id", F.transform("raw", floor).alias("vec"))


@dataclass(frozen=True)
class Segment:
    """Postings of one impact: values by the rows and dimensions that have any, else 0."""

    rows: np.ndarray
    dimensions: np.ndarray
    values: np.ndarray
    rest: np.ndarray  # norm of each row's postings of less impact


class ImpactIndex:
    """A block of rows by impact."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.limit = 1 << ((62 - int(rows.shape[1]).bit_length()) // 2)
        most = np.abs(rows).max(axis=1)
        self.large, self.large_ids = rows[most >= self.limit], ids[most >= self.limit]
        self.ids = ids[most < self.limit]
        self.rows = rows[most < self.limit].astype(np.int64)
        self.most = int(np.abs(self.rows).max(initial=0))
        bits = np.frexp(np.abs(self.rows).astype(float))[1]  # the impact: bits of the magnitude
        self.segments = []
        for level in range(int(bits.max(initial=0)), 0, -1):
            here = bits == level
            if here.any():
                some, dims = np.flatnonzero(here.any(axis=1)), np.flatnonzero(here.any(axis=0))
                values = np.where(here, self.rows, 0)[np.ix_(some, dims)].astype(float)
                rest = np.sqrt((np.where(bits < level, self.rows, 0).astype(float) ** 2).sum(1))
                self.segments.append(Segment(some, dims, values, rest))

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, list]]:
        """For each query its number, and the ids and exact scores of its k best rows."""
        large = np.abs(queries).max(axis=1, initial=0) >= self.limit
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {q: [] for q in range(len(queries))}
        usual = np.flatnonzero(~large)
        if len(usual) and len(self.rows):
            for n, ids, scores in self._indexed(queries[usual].astype(np.int64), own[usual], k):
                found[int(usual[n])].append((ids, scores))
        for q in range(len(queries)):
            for rows, ids in ((self.large, self.large_ids), (self.rows, self.ids) if large[q] else (None, None)):
                if rows is not None and len(rows):
                    other = ids != own[q]
                    found[q].append((ids[other], _any_size(rows[other], queries[q])))
            if found[q]:
                ids = np.concatenate([i for i, _ in found[q]])
                scores = np.concatenate([s.astype(object) if len(found[q]) > 1 else s for _, s in found[q]])
                order = sorted(range(len(ids)), key=lambda n: (-scores[n], ids[n]))[:k]
                yield q, ids[order], scores[order]

    def _indexed(
        self, queries: np.ndarray, own: np.ndarray, k: int
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        norms = np.sqrt((queries.astype(float) ** 2).sum(1))
        most = float(np.abs(queries).max(initial=0)) * self.most * self.rows.shape[1]
        real = np.float32 if most < 1 << 22 else np.float64
        left_out = _own_rows(own, self.ids)
        scores = np.zeros((len(queries), len(self.rows)), real)
        scores[left_out] = -np.inf
        asked = queries.astype(real)
        k_here = min(k, len(self.rows))
        possible = np.ones(scores.shape, bool)
        for n, segment in enumerate(self.segments):
            part = asked[:, segment.dimensions] @ segment.values.astype(real).T
            if len(segment.rows) == len(self.rows):
                scores += part
            else:
                scores[:, segment.rows] += part
            last = n + 1 == len(self.segments)
            if not last:  # the margins cover the rounding of the sums
                slack = norms[:, None] * segment.rest[None, :] * (1 + 1e-6) + 1 + most * 1e-12
                slack = slack.astype(real)
            else:
                slack = np.full((1, 1), most * 1e-12 if most >= 1 << 50 else 0, real)
            lower = scores - slack
            threshold = np.partition(lower, len(self.rows) - k_here, axis=1)[:, len(self.rows) - k_here]
            possible = scores + slack >= threshold[:, None]
            if last or possible.sum() <= max(FEW * possible.size, 2 * k_here * len(queries)):
                break
        possible[left_out] = False
        for q in range(len(queries)):
            members = np.flatnonzero(possible[q])
            exact = self.rows[members] @ queries[q]
            order = np.lexsort((self.ids[members], -exact))[:k]
            yield q, self.ids[members][order], exact[order]


def _any_size(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of integers that may leave 64 bits, cut to a long's range."""
    asked = [int(x) for x in query.tolist()]
    exact = [sum(int(x) * y for x, y in zip(row, asked, strict=True)) for row in rows.tolist()]
    return np.array([min(max(s, LEAST), MOST) for s in exact], object)


def _own_rows(own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) with the same id."""
    order = np.argsort(ids, kind="stable")
    lo = np.searchsorted(ids[order], own, "left")
    hi = np.searchsorted(ids[order], own, "right")
    counts = hi - lo
    query = np.repeat(np.arange(len(own)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return query, order[np.repeat(lo, counts) + inner]


def _blocked(rows: DataFrame, count: int, size: int) -> DataFrame:
    """Rows, numbered, gathered at random into about `count / size` blocks of `block` and `vectors`."""
    n = max(1, -(-count // size))
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    dealt = numbered.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n)).cast("int"))
    return dealt.groupBy("block").agg(F.collect_list(F.struct("vec_id", "number", "vec")).alias("vectors"))


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 1024,
) -> DataFrame:
    """`query_id, rank, vec_id, score` for the queries: rows whose id is divisible by `every`."""
    rows = stage(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    counts = rows.agg(
        F.count("vec_id").alias("rows"), F.count_if(F.col("vec_id") % every == 0).alias("queries")
    ).first()
    n_blocks = max(1, -(-counts["rows"] // block_rows))
    queries = rows.where(F.col("vec_id") % every == 0)
    # A stated set of queries against all rows: each block of rows gets every block of queries.
    row_blocks = _blocked(rows, counts["rows"], block_rows).select(
        F.col("block").alias("row"), F.lit(-1).alias("query"), "vectors"
    )
    asked = _blocked(queries, counts["queries"], query_rows).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("row"), F.col("block").alias("query"), "vectors"
    )
    met = row_blocks.unionByName(asked).repartition(n_blocks, "row").sortWithinPartitions("row", "query")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, indexes = None, {}
        for batch in batches:
            for row, query, list_of in zip(*batch.columns, strict=True):
                if query.as_py() < 0:
                    block = row.as_py()
                    indexes = {w: ImpactIndex(v, ids) for w, (ids, _, v) in _arrays(list_of).items()}
                elif row.as_py() == block:
                    yield from answers(indexes, list_of)

    def answers(indexes: dict[int, ImpactIndex], asked: pa.ListScalar) -> Iterator[pa.RecordBatch]:
        for width, (own, numbers, queries) in _arrays(asked).items():
            if width in indexes:
                out = [(numbers[q], own[q], ids, scores) for q, ids, scores in indexes[width].best(queries, own, k)]
                sizes = [len(ids) for _, _, ids, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([n for n, *_ in out], sizes), pa.int64()),
                        pa.array(np.repeat([o for _, o, *_ in out], sizes), pa.int64()),
                        pa.array([int(i) for *_, ids, _ in out for i in ids], pa.int64()),
                        pa.array([int(v) for *_, scores in out for v in scores], pa.int64()),
                    ],
                    names=["number", "query_id", "vec_id", "score"],
                )

    found = met.mapInArrow(search, "number long, query_id long, vec_id long, score long")
    best = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _arrays(block: pa.ListScalar) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, numbers and vectors of a block, by the vectors' length."""
    structs = block.values
    ids = structs.field("vec_id").to_numpy(zero_copy_only=False)
    numbers = structs.field("number").to_numpy(zero_copy_only=False)
    lists = structs.field("vec")
    widths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    begins = np.cumsum(widths) - widths
    return {
        int(w): (ids[widths == w], numbers[widths == w], flat[begins[widths == w][:, None] + np.arange(w)])
        for w in np.unique(widths)
    }
