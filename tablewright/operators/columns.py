"""Choosing, dropping and stamping columns; row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted


def moment(value: str | datetime | Column, dtype: T.DataType | str = "timestamp") -> Column:
    """A point in time as a constant of the column's own timestamp type, so
    that comparisons fold and reach the scan instead of casting the column."""
    if isinstance(value, Column):
        return value.cast(dtype)
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast(dtype)


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Those wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[quoted(c) for c in wanted if c in present])


def columns_with_suffix(df: DataFrame, suffix: str = "_vec") -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def select_by_suffix(df: DataFrame, suffix: str = "_vec", keep: Iterable[str] = ()) -> DataFrame:
    """The ``keep`` columns and every column whose name ends with ``suffix``."""
    kept = list(keep)
    chosen = [c for c in columns_with_suffix(df, suffix) if c not in kept]
    return df.select(*[quoted(c) for c in [*kept, *chosen]])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def stamp_timestamps(
    df: DataFrame,
    *,
    as_of: str | datetime | None = None,
    event: str = "event_timestamp",
    created: str = "created_timestamp",
) -> DataFrame:
    """Add the event and created timestamps: now, or ``as_of`` for runs that
    must give the same table twice."""
    now = F.current_timestamp() if as_of is None else moment(as_of)
    return df.withColumns({event: now, created: now})


def filter_is_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(quoted(col)).isNull())


def out_of_range(col: Column, low: float, high: float) -> Column:
    """True below ``low`` or above ``high``. NULL is neither; NaN is above."""
    return (col < low) | (col > high)


def filter_out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter(out_of_range(F.col(quoted(col)), low, high))


def filter_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(quoted(col)) < 0)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(quoted(col)) == value)


def conjunction_flag(df: DataFrame, above: Mapping[str, float], out: str) -> DataFrame:
    """1 where every named column is greater than its bound, else 0; a NULL
    on either side gives 0."""
    if not above:
        raise ValueError("name at least one bound")
    tests = [F.col(quoted(c)) > bound for c, bound in above.items()]
    every = tests[0]
    for test in tests[1:]:
        every = every & test
    return df.withColumn(out, F.when(every, 1).otherwise(0))
