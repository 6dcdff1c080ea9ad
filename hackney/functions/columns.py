"""Choosing columns by presence, spelling and type; missing-value helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
FLOATING_TYPES = (T.FloatType, T.DoubleType)
TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


def present(df: DataFrame, names: Iterable[str], at_least: int = 0) -> list[str]:
    """The names that are columns of `df`, in the order given."""
    found = [name for name in names if name in df.columns]
    if len(found) < at_least:
        raise ValueError(f"need at least {at_least} of the columns {list(names)}, found {found}")
    return found


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first spelling that is a column of `df`."""
    return next(iter(present(df, names)), None)


def required(df: DataFrame, names: Sequence[str]) -> str:
    """Like `first_present`, for a column that must exist."""
    found = first_present(df, names)
    if found is None:
        raise KeyError(f"none of the columns {list(names)} found")
    return found


def of_type(df: DataFrame, types: tuple[type[T.DataType], ...]) -> list[str]:
    """Names of the columns that have one of the given types."""
    return [field.name for field in df.schema if isinstance(field.dataType, types)]


def nan_as_null(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing; other types pass through."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, FLOATING_TYPES):
        return F.when(~F.isnan(column), column)
    return column


def ensure_timestamps(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Parse those columns that are still text; text that is no timestamp is an error."""
    text = set(of_type(df, (T.StringType,)))
    return df.withColumns({n: F.to_timestamp_ntz(n) for n in present(df, names) if n in text})


def percent(part: Column, whole: Column) -> Column:
    """`part` of `whole` in percent, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def rows_of(wide: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn every row of a (small, aggregated) frame into one row per struct."""
    return wide.select(F.inline(F.array(*structs)))
