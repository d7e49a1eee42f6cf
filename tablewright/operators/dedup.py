"""One row per key, chosen by a total order.

The choice is an aggregate (least or greatest row per key) rather than a
ranked window: every map task first reduces its rows to one per key, so a key
that holds a third of the table still reaches the reducer as one row per map
task. Whole rows in a buffer need a sort aggregate, so each map task sorts its
own rows by key before that; only the rows that are left are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted
from tablewright.session import fits_broadcast, through_storage

ROW, AGAIN = "__row", "__again"


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort values of this type."""
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def pick_row(df: DataFrame, lead: Sequence[str], payload: Sequence[str], greatest: bool) -> Column:
    """Aggregate that picks one row as a struct: ordered by ``lead``, then by
    the other payload columns, so the choice never depends on task order."""
    names = list(dict.fromkeys([*lead, *payload]))
    sortable = [c for c in names if orderable(df.schema[c].dataType)]
    order = F.struct(*[F.col(quoted(c)) for c in sortable])
    if len(sortable) == len(names):
        return F.max(order) if greatest else F.min(order)
    whole = F.struct(*[F.col(quoted(c)) for c in names])
    return F.max_by(whole, order) if greatest else F.min_by(whole, order)


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """Keep the first (or last) row per key by ``order_by``; ties go to the
    remaining columns in table order. NULL keys form one group. As in any
    ascending Spark sort, NULL comes first."""
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.dropDuplicates(keys)
    lead = [c for c in order_by if c not in keys]
    unknown = [c for c in [*keys, *lead] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    picked = df.groupBy(*map(quoted, keys)).agg(
        pick_row(df, lead, payload, greatest=keep == "last").alias(ROW)
    )
    return picked.select(
        *[F.col(quoted(c)) if c in keys else F.col(f"{ROW}.{quoted(c)}") for c in df.columns]
    )


def dedup_rare(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keep: str = "first",
    max_broadcast_keys: int = 500_000,
) -> DataFrame:
    """Same rows as :func:`dedup_by_key`, for wide tables with few duplicates.

    A first pass over the key columns alone finds the keys that occur twice.
    If they are few, only their rows are shuffled and all others pass straight
    through the scan; if they are many, the plain form is used. ``df`` is read
    three times, once for its keys only, so it must be a stored table. NULL
    keys take the shuffled side.
    """
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(quoted(k)).isNull()
    repeated = (
        df.where(~any_null)
        .groupBy(*map(quoted, keys))
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select(*map(quoted, keys))
    )
    repeated = through_storage(repeated, "repeated-keys")
    if not fits_broadcast(repeated, max_broadcast_keys):
        return dedup_by_key(df, keys, order_by, keep)
    marked = df.join(F.broadcast(repeated.withColumn(AGAIN, F.lit(True))), keys, "left")
    again, columns = any_null | F.col(AGAIN).isNotNull(), list(map(quoted, df.columns))
    single, several = marked.where(~again).select(*columns), marked.where(again).select(*columns)
    return single.unionByName(dedup_by_key(several, keys, order_by, keep))


def dedup_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after and rows removed by a dedup on
    ``keys``, counted in one pass."""
    return (
        df.groupBy(*map(quoted, keys))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
            F.count(F.lit(1)).alias("rows_out"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        )
    )
