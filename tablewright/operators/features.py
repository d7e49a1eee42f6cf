"""Derived numeric features: projections only, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import expressions as X
from tablewright.functions.naming import quoted


def bucketize(
    df: DataFrame, col: str, splits: Sequence[float], out: str, on_error: str = X.RAISE
) -> DataFrame:
    """Bucket index of a numeric column; see ``bucket_index``."""
    dtype = df.schema[col].dataType
    if not isinstance(dtype, T.NumericType):
        raise TypeError(f"{col} is {dtype.simpleString()}, not a number")
    return df.withColumn(out, F.expr(X.bucket_index(quoted(col), splits, on_error)))


def guarded_ratio(
    df: DataFrame, num: str, den: str, when_zero: str, out: str, on_error: str = X.RAISE
) -> DataFrame:
    """``num / den``, or the column ``when_zero`` where ``den`` is 0."""
    n, d, z = map(quoted, (num, den, when_zero))
    guarded = f"CASE WHEN {d} = 0 THEN {z} ELSE {X.ratio(n, d, on_error)} END"
    return df.withColumn(out, F.expr(guarded))


def plain_ratio(
    df: DataFrame, num: str, den: str, out: str, on_error: str = X.RAISE
) -> DataFrame:
    """``num / den``; a zero divisor fails the job or gives NULL."""
    return df.withColumn(out, F.expr(X.ratio(quoted(num), quoted(den), on_error)))
