"""Exact interpolated quantiles of tables of any size, without shuffling their rows.

One way serves every size. Each column's range is cut into `CELLS` equal cells, and one pass counts their
values: that names the cell of each wanted rank, whose least and greatest value are the rank's bracket.
Brackets of more than `RANKED_ROWS` rows are narrowed: sketches of what lies between propose closer ends
or, where those made no progress, the doubles between the ends are halved, which ends after 64 halvings at
the latest; a counting pass proves that the rank lies in the proposal, or keeps the bracket that was known
before. A rank that falls on an end of its bracket is then known. The few values within the brackets are
grouped and ranked.

A quantile is `lower + (upper - lower) * weight` of the values at the two neighbouring ranks. Equal
neighbours, and a weight of 0, give the lower value itself. An infinite neighbour wins over a finite one;
between -inf and inf the result is NaN. NaN sorts after all numbers, and a rank that falls on NaN, or
between a number and NaN, gives NaN.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hackney.functions.columns import present, rows_of
from hackney.schema import METRIC_COLUMNS

RANKED_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
PROBABILITIES = (0.50, 0.90, 0.95, 0.99)
CELLS = 2_048  # per column, so the driver gets a bounded number of counts

Bounds = tuple[float, float]


@dataclass(frozen=True)
class _Bracket:
    """Known bounds of one wanted rank among the sorted numbers of a column."""

    column: str
    probability: float
    rank: int
    weight: float  # share of the value at rank + 1 in the result
    below: int  # values < low
    through_low: int  # values <= low
    before_high: int  # values < high
    low: float
    high: float
    stuck: bool = False  # the last proposal did not narrow the bracket
    apart: Bounds | None = None  # the neighbours, where a proposed end fell between them

    @property
    def last_rank(self) -> int:
        return self.rank + (self.weight > 0)

    @property
    def between(self) -> int:
        return self.before_high - self.through_low

    @property
    def known(self) -> Bounds | None:
        """The neighbours, if both ranks fall on the same end of the bracket or were found apart."""
        if self.last_rank < self.through_low:
            return self.low, self.low
        if self.rank >= self.before_high:
            return self.high, self.high
        return self.apart

    def strictly_inside(self, value: Column) -> Column:
        return (value > self.low) & (value < self.high)

    def inside(self, value: Column) -> Column:
        return (value >= self.low) & (value <= self.high)


def _position(value: float) -> int:
    """The double's place among all doubles in their order."""
    bits = struct.unpack("<q", struct.pack("<d", value))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _at(position: int) -> float:
    bits = abs(position)
    value = struct.unpack("<d", struct.pack("<q", bits))[0]
    return -value if position < 0 else value


def _middle(low: float, high: float) -> float:
    return _at((_position(low) + _position(high)) // 2)


def _cell(value: Column, low: float, high: float) -> Column:
    """The cell of a value; it never falls as the value grows, so cells are in the order of their values."""
    width = high - low
    if not (0 < width < math.inf):
        return F.lit(0)
    return F.least(F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(CELLS))), F.lit(CELLS - 1)).cast("int")


def _cells(values: DataFrame, ranges: dict[str, Bounds]) -> dict[str, list[tuple[int, float, float]]]:
    """Rows, least and greatest value of every cell that has any, by column and in ascending order."""
    if not ranges:
        return {}
    column_name, value = F.col("column_name"), F.col("value")
    # A row per column, so that each value is computed once, however dear it is.
    single = values.unpivot([], list(ranges), "column_name", "value").where(value.isNotNull() & ~F.isnan(value))
    cell = reduce(
        lambda chosen, name: chosen.when(column_name == name, _cell(value, *ranges[name])), ranges, F
    )
    counted = (
        single.select("column_name", "value", cell.alias("cell"))
        .groupBy("column_name", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        .collect()
    )
    found = defaultdict(list)
    for row in sorted(counted, key=lambda row: row["cell"]):
        found[row["column_name"]].append((row["n"], row["least"], row["most"]))
    return found


def _in_cell(bracket: _Bracket, cells: Sequence[tuple[int, float, float]]) -> _Bracket:
    """The bracket narrowed to the cell of its rank; the counts between its ends still include the ends."""
    below = 0
    for (n, least, most), later in zip(cells, [*cells[1:], (0, math.inf, math.inf)], strict=True):
        if bracket.rank < below + n:
            if bracket.last_rank >= below + n:
                return replace(bracket, apart=(most, later[1]))
            return replace(
                bracket, low=least, high=most, below=below, through_low=below, before_high=below + n,
                apart=(least, most) if least == most else None,
            )
        below += n
    raise RuntimeError(f"the rows of {bracket.column} changed between two passes")


def _first_sketch(
    values: DataFrame, probabilities: Sequence[float]
) -> tuple[list[_Bracket], list[Bounds], list[tuple[_Bracket, float | None, float | None]]]:
    """Count every column, and the cells of its range, in two passes.

    Returns the brackets to search, a proposal for each, and the neighbours that are NaN or null.
    """
    aggregates = []
    for i, name in enumerate(values.columns):
        number = F.when(~F.isnan(name), F.col(name))
        aggregates += [
            F.count(name).alias(f"{i} all"),
            F.count(number).alias(f"{i} numbers"),
            F.min(number).alias(f"{i} least"),
            F.max(number).alias(f"{i} most"),
        ]
    seen = values.agg(*aggregates).first()
    ranges = {
        name: (seen[f"{i} least"], seen[f"{i} most"])
        for i, name in enumerate(values.columns)
        if seen[f"{i} numbers"]
    }
    cells = _cells(values, ranges)

    search, results = [], []
    for i, name in enumerate(values.columns):
        count, numbers = seen[f"{i} all"], seen[f"{i} numbers"]
        for probability in probabilities:
            position = max(count - 1, 0) * probability
            rank = math.floor(position)
            ends = ranges.get(name, (None, None))
            bracket = _Bracket(name, probability, rank, position - rank, 0, 0, numbers, *ends)
            if bracket.last_rank >= numbers:
                # NaN sorts last; without any value the rank is beyond the end as well.
                beyond = math.nan if count else None
                results.append((bracket, beyond, beyond))
                continue
            search.append(_in_cell(bracket, cells[name]))
    return search, [(b.low, b.high) for b in search], results


def _next_proposals(values: DataFrame, brackets: Sequence[_Bracket]) -> list[Bounds]:
    """Narrower bounds for each bracket: sketches of what lies between, or one half of the doubles."""
    margin = 2 / SKETCH_ACCURACY
    wanted = defaultdict(list)
    proposals: list[Bounds] = [(b.low, b.high) for b in brackets]
    for i, bracket in enumerate(brackets):
        if bracket.stuck:
            proposals[i] = (bracket.low, _middle(bracket.low, bracket.high))
            continue
        start = (bracket.rank - bracket.through_low) / bracket.between - margin
        end = (bracket.last_rank + 1 - bracket.through_low) / bracket.between + margin
        wanted[(bracket.column, bracket.low, bracket.high)].append((i, start, end))
    if not wanted:
        return proposals
    sketches = [
        F.percentile_approx(
            F.when(brackets[members[0][0]].strictly_inside(F.col(column)), F.col(column)),
            [min(max(share, 0.0), 1.0) for _, start, end in members for share in (start, end)],
            SKETCH_ACCURACY,
        )
        for (column, _, _), members in wanted.items()
    ]
    seen = values.agg(*[s.alias(str(i)) for i, s in enumerate(sketches)]).first()
    for found, members in zip(seen, wanted.values(), strict=True):
        for k, (i, start, end) in enumerate(members):
            proposals[i] = (
                found[2 * k] if start > 0 else brackets[i].low,
                found[2 * k + 1] if end < 1 else brackets[i].high,
            )
    return proposals


def _confirm(
    values: DataFrame, brackets: Sequence[_Bracket], proposals: Sequence[Bounds]
) -> list[_Bracket]:
    """Count exactly around every proposal and keep that part of the bracket in which the rank lies."""

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    # Zero has one sign here: Spark may take the literals 0.0 and -0.0 of one aggregate for the same.
    proposals = [(low + 0.0, high + 0.0) for low, high in proposals]
    aggregates = []
    for bracket, (low, high) in zip(brackets, proposals, strict=True):
        number = F.when(~F.isnan(bracket.column), F.col(bracket.column))
        aggregates += [
            total(number < low),
            total(number <= low),
            total(number < high),
            total(number <= high),
            F.max(F.when(number < high, number)),
            F.min(F.when(number > high, number)),
            total(number < bracket.high + 0.0),
        ]
    counts = values.agg(*[a.alias(str(i)) for i, a in enumerate(aggregates)]).first()
    confirmed = []
    for i, (old, (low, high)) in enumerate(zip(brackets, proposals, strict=True)):
        below, through_low, before_high, through_high, before, after, before_old = counts[7 * i : 7 * i + 7]
        between = old.between
        new = old = replace(old, before_high=max(before_old, old.through_low))
        if below <= old.rank and old.last_rank < through_high:
            new = replace(old, low=low, high=high, below=below, through_low=through_low,
                          before_high=max(before_high, through_low))
        elif before_high <= old.rank:  # the values lie at the proposed end and above
            new = replace(old, low=high, below=before_high, through_low=through_high,
                          before_high=max(old.before_high, through_high))
        elif old.rank < through_high <= old.last_rank:  # the proposed end lies between the two
            new = replace(old, apart=(before, after))
        confirmed.append(replace(new, stuck=2 * new.between > between))
    return confirmed


def _rank_inside(values: DataFrame, brackets: Sequence[_Bracket]) -> DataFrame:
    """Group the values within each bracket and read off the neighbours of the wanted ranks."""
    searched = sorted({b.column for b in brackets})
    column_name, value = F.col("column_name"), F.col("value")
    # Filtered as one row per column: a filter on the columns would compute them again for each bracket.
    single = values.unpivot([], searched, "column_name", "value")

    def inside(b: _Bracket) -> Column:
        return b.inside(value) & (column_name == b.column)

    entries = [
        F.when(
            inside(b),
            F.struct(
                column_name,
                F.lit(b.probability).alias("probability"),
                F.lit(b.rank - b.below).cast("long").alias("skip"),
                F.lit(b.weight).alias("weight"),
                value,
            ),
        )
        for b in brackets
    ]
    counted = (
        single.where(reduce(or_, [inside(b) for b in brackets]))
        .select(F.inline(F.array_compact(F.array(*entries))))
        .groupBy("column_name", "probability", "skip", "weight", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ascending = Window.partitionBy("column_name", "probability").orderBy("value")
    through = F.col("through")
    return (
        counted.withColumn("through", F.sum("n").over(ascending))
        .groupBy("column_name", "probability", "weight")
        .agg(
            F.min(F.when(through > F.col("skip"), value)).alias("lower"),
            F.min(F.when(through > F.col("skip") + 1, value)).alias("upper"),
        )
        .select("column_name", "probability", "lower", "upper", "weight")
    )


def _literal_results(
    values: DataFrame, results: Sequence[tuple[_Bracket, float | None, float | None]]
) -> DataFrame:
    rows = [
        F.struct(
            F.lit(b.column).alias("column_name"),
            F.lit(b.probability).alias("probability"),
            F.lit(lower).cast("double").alias("lower"),
            F.lit(upper).cast("double").alias("upper"),
            F.lit(b.weight).alias("weight"),
        )
        for b, lower, upper in results
    ]
    return rows_of(values.sparkSession.range(1), rows)


def exact_neighbours(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = PROBABILITIES,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """`column_name, probability, lower, upper, weight`: the values that a quantile lies between.

    `df` is read several times: pass a stored table, or a staged one if it is dear to compute.
    """
    values = df.select(*[F.col(name).cast("double").alias(name) for name in columns])
    if not columns:
        return values.sparkSession.createDataFrame(
            [], "column_name string, probability double, lower double, upper double, weight double"
        )
    found, proposals, results = _first_sketch(values, probabilities)
    proposed = dict(zip(found, proposals, strict=True))
    narrow: list[_Bracket] = []
    while found:
        results += [(b, *b.known) for b in found if b.known is not None]
        unknown = [b for b in found if b.known is None]
        narrow += [b for b in unknown if b.between <= max(ranked_rows, 1)]
        wide = [b for b in unknown if b.between > max(ranked_rows, 1)]
        if not wide:
            break
        proposals = [proposed[b] for b in wide] if proposed else _next_proposals(values, wide)
        found = _confirm(values, wide, proposals)
        if proposed:  # the first proposals may be the ends as they are, which only counts them
            found, proposed = [replace(b, stuck=False) for b in found], {}

    parts = []
    if narrow:
        parts.append(_rank_inside(values, narrow))
    if results:
        parts.append(_literal_results(values, results))
    return reduce(DataFrame.unionByName, parts)


def interpolated(lower: Column, upper: Column, weight: Column) -> Column:
    infinite = (F.abs(lower) == math.inf) | (F.abs(upper) == math.inf)
    opposite = (F.abs(lower) == math.inf) & (F.abs(upper) == math.inf)
    return (
        F.when((weight == 0) | (lower == upper), lower)
        .when(opposite, F.lit(math.nan))
        .when(infinite, F.when(F.abs(lower) == math.inf, lower).otherwise(upper))
        .otherwise(lower + (upper - lower) * weight)
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = PROBABILITIES,
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """`column_name, probability, value`: linear interpolation between neighbours, nulls ignored."""
    found = exact_neighbours(df, columns, probabilities, ranked_rows)
    value = interpolated(F.col("lower"), F.col("upper"), F.col("weight"))
    return found.select("column_name", "probability", value.alias("value"))


def metric_percentiles(prepared: DataFrame) -> DataFrame:
    """The median and upper percentiles of each metric: one row with a list per metric."""
    names = present(prepared, METRIC_COLUMNS, at_least=1)
    quantiles = exact_quantiles(prepared, names)
    lists = []
    for name in names:
        entry = F.when(F.col("column_name") == name, F.struct("probability", "value"))
        ordered = F.array_sort(F.collect_list(entry))
        lists.append(F.transform(ordered, lambda e: e["value"]).alias(f"{name}_q"))
    return quantiles.agg(*lists)
