"""What the operators share: column choice, Arrow buffers as NumPy arrays, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=8)
def _shipped(context: SparkContext) -> None:
    """Let Python workers of a local session import this package from wherever it was started.

    A cluster gets the package with the job (`--py-files`).
    """
    if context.master.startswith("local") and "cluster" not in context.master:
        context.addFile(str(Path(__file__).resolve().parents[1]), recursive=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _shipped(spark.sparkContext)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: others cannot clash."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def utf8_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset where each row begins; nulls are empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column = column.cast(pa.string())
        kind = np.int32
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(
    data: np.ndarray, bounds: np.ndarray, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `size` bytes: the first row, the bytes, the bounds within them.

    A row of more than `size` bytes comes in several blocks, cut at white space, so that memory
    does not follow the longest text.
    """
    rows = len(bounds) - 1
    row = 0
    while row < rows:
        lo = bounds[row]
        if bounds[row + 1] - lo <= size:
            last = int(np.searchsorted(bounds, lo + size, "right")) - 1
            last = max(row + 1, min(last, rows))
            yield row, data[lo : bounds[last]], bounds[row : last + 1] - lo
            row = last
            continue
        end = bounds[row + 1]
        while lo < end:
            cut = min(lo + size, end)
            if cut < end:
                spaces = np.flatnonzero(SPACE[data[lo:cut]])
                if len(spaces):
                    cut = lo + spaces[-1] + 1
                else:
                    later = np.flatnonzero(SPACE[data[cut:end]])
                    cut = cut + later[0] + 1 if len(later) else end
            yield row, data[lo:cut], np.array([0, cut - lo], np.int64)
            lo = cut
        row += 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, BLOCK_BYTES + 1)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers, _inverses = tables
    return _powers[:n], _inverses[:n]


def word_spans(
    data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes outside `space`; rows end words."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~space[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(bounds, starts, "right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))
