"""Typed feature views: what a served feature table must look like."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted, rows_of, text


@dataclass(frozen=True)
class Entity:
    """A key column."""

    name: str
    dtype: str = "string"
    description: str = ""


@dataclass(frozen=True)
class FeatureSource:
    """Where feature rows are stored, and which columns date them. A table that
    is stored by the day of the event time names that column as
    ``date_partition``; bounds on the event time then skip whole days."""

    path: str = ""
    event_timestamp: str = "event_timestamp"
    created_timestamp: str | None = "created_timestamp"
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    date_partition: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.format).options(**self.options).load(self.path)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str


@dataclass(frozen=True)
class FeatureView:
    """A named, typed list of features of one or more entities."""

    name: str
    entities: tuple[Entity, ...]
    fields: tuple[Field, ...]
    source: FeatureSource = FeatureSource()
    ttl: timedelta | None = None
    online: bool = True
    tags: Mapping[str, str] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return [e.name for e in self.entities]

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def timestamps(self) -> list[str]:
        created = self.source.created_timestamp
        return [self.source.event_timestamp, *([created] if created else [])]

    @property
    def schema(self) -> T.StructType:
        """Keys and features with their declared types."""
        return T.StructType(
            [
                T.StructField(f.name, T.DataType.fromDDL(f.dtype))
                for f in (*self.entities, *self.fields)
            ]
        )

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.features, *self.timestamps]


def conform(df: DataFrame, view: FeatureView) -> DataFrame:
    """Exactly the columns of the view, cast to its types, and the day by which
    its source is stored, if any. Timestamps keep the type they have. A missing
    column is an error."""
    day = [view.source.date_partition] if view.source.date_partition else []
    missing = [c for c in [*view.columns, *day] if c not in df.columns]
    if missing:
        raise ValueError(f"view {view.name} lacks columns {missing}")
    typed = [F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in view.schema.fields]
    return df.select(*typed, *map(quoted, [*view.timestamps, *day]))


def _is_lost(col: str, have: T.DataType, want: T.DataType) -> str:
    """SQL test for a value that the cast to ``want`` turns into NULL or
    pushes to infinity."""
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return f"exists({col}, x -> {_is_lost('x', have.elementType, want.elementType)})"
    cast = f"try_cast({col} AS {want.simpleString()})"
    if isinstance(want, (T.FloatType, T.DoubleType)):
        if isinstance(have, (T.IntegralType, T.FloatType)):
            return "false"
        large = f"abs({cast}) = double('inf') AND abs(try_cast({col} AS DOUBLE)) < double('inf')"
        if isinstance(have, T.DoubleType):
            return f"coalesce({large}, false)"
        return f"coalesce({col} IS NOT NULL AND ({cast} IS NULL OR {large}), false)"
    return f"({col} IS NOT NULL AND {cast} IS NULL)"


def _castable(have: T.DataType, want: T.DataType) -> bool:
    """Arrays only go to arrays and scalars to scalars; the rest is decided
    value by value."""
    if isinstance(have, T.ArrayType) or isinstance(want, T.ArrayType):
        return (
            isinstance(have, T.ArrayType)
            and isinstance(want, T.ArrayType)
            and _castable(have.elementType, want.elementType)
        )
    if isinstance(have, (T.MapType, T.StructType)) or isinstance(want, (T.MapType, T.StructType)):
        return have == want
    number = (T.NumericType, T.StringType, T.BooleanType)
    return have == want or (isinstance(have, number) and isinstance(want, number))


def check_view(df: DataFrame, view: FeatureView) -> DataFrame:
    """Compare a table with the view's contract, one row per declared field:
    (field, declared, actual, status, non_null, lost).

    ``status`` is ``ok`` (same type), ``cast`` (another type that
    :func:`conform` converts), ``mismatch`` or ``missing``; ``lost`` counts
    values that do not survive the conversion. One aggregation over one scan.
    """
    declared = list(view.schema.fields)
    declared += [T.StructField(c, T.TimestampType()) for c in view.timestamps]
    counts, rows = [], []
    for i, f in enumerate(declared):
        have = df.schema[f.name].dataType if f.name in df.columns else None
        stamp = f.name in view.timestamps
        if have is None:
            status = "missing"
        elif have == f.dataType or (stamp and isinstance(have, T.TimestampNTZType)):
            status = "ok"
        else:
            status = "cast" if not stamp and _castable(have, f.dataType) else "mismatch"
        col = quoted(f.name)
        filled = "0L" if have is None else f"count({col})"
        lost = f"count_if({_is_lost(col, have, f.dataType)})" if status == "cast" else "0L"
        counts += [F.expr(f"{filled} AS n{i}"), F.expr(f"{lost} AS lost{i}")]
        rows.append(
            (
                text(f.name),
                text(f.dataType.simpleString()),
                "CAST(NULL AS STRING)" if have is None else text(have.simpleString()),
                text(status),
                f"n{i}",
                f"lost{i}",
            )
        )
    names = ("field", "declared", "actual", "status", "non_null", "lost")
    return df.agg(*counts).selectExpr(rows_of(names, rows))


def view_mismatches(df: DataFrame, view: FeatureView) -> DataFrame:
    """Only the fields that keep a table from being served through the view."""
    return check_view(df, view).where(
        F.col("status").isin("missing", "mismatch") | (F.col("lost") > 0)
    )
