"""Counts and profiles; each is one aggregation over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted, rows_of, text


def distinct_expr(keys: Sequence[str]) -> Column:
    """Distinct keys as an aggregate in which NULL counts as a value, like
    ``distinct().count()`` but usable next to other aggregates."""
    if len(keys) == 1:
        col = F.col(quoted(keys[0]))
        some_null = F.coalesce(F.max(col.isNull().cast("long")), F.lit(0))
        return F.count_distinct(col) + some_null
    return F.count_distinct(F.struct(*map(quoted, keys)))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*map(quoted, cols)).distinct()


def distinct_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.agg(distinct_expr(keys).alias("n_distinct"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, distinct and surplus rows in one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), distinct_expr(keys).alias("n_distinct"))
    return counted.withColumn("duplicates", F.col("n") - F.col("n_distinct"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column, under its own name. A
    difference of counts, which file footers can answer (see
    :func:`tablewright.sources.read_statistics`)."""
    return df.agg(*[F.expr(f"count(1) - count({q}) AS {q}") for q in map(quoted, df.columns)])


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null): schema and filled rows together."""
    counts = df.agg(*[F.expr(f"count({quoted(c)}) AS c{i}") for i, c in enumerate(df.columns)])
    rows = [
        (str(i), text(f.name), text(f.dataType.simpleString()), f"c{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.selectExpr(rows_of(("position", "column", "type", "non_null"), rows))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max), by default for every numeric
    column. Empty and all-NULL columns give NULL statistics."""
    names = numeric_columns(df) if cols is None else list(cols)
    if not names:
        raise ValueError("no numeric columns")
    parts = ("count", "avg", "stddev_samp", "min", "max")
    totals = df.agg(
        *[
            F.expr(f"{part}(CAST({quoted(c)} AS DOUBLE)) AS {part}{i}")
            for i, c in enumerate(names)
            for part in parts
        ]
    )
    rows = [(text(c), *[f"{part}{i}" for part in parts]) for i, c in enumerate(names)]
    return totals.selectExpr(rows_of(("column", "count", "mean", "stddev", "min", "max"), rows))


def peek(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows; with an order, the same n each time. Spark keeps n
    rows per task for it and never sorts the table."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
