"""Renames, flags and number repair: the bronze to silver step."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import expressions as X
from tablewright.functions.naming import quoted, snake_case
from tablewright.operators.dedup import dedup_by_key


def snake_case_columns(df: DataFrame, fixes: Mapping[str, str] | None = None) -> DataFrame:
    """Rename every column to snake case, then apply ``fixes``."""
    fixes = fixes or {}
    names = [fixes.get(n, n) for n in map(snake_case, df.columns)]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns that would share a name: {twice}")
    return df.toDF(*names)


def fix_acronym_names(df: DataFrame, fixes: Mapping[str, str]) -> DataFrame:
    """Repair names whose acronym was split; absent names are skipped."""
    return df.withColumnsRenamed(dict(fixes))


def _flag_exprs(schema: T.StructType, cols: Iterable[str], yes: str, no: str) -> dict[str, str]:
    flags = {}
    for name in cols:
        if name not in schema.names:
            continue
        dtype, col = schema[name].dataType, quoted(name)
        if isinstance(dtype, (T.IntegralType, T.BooleanType)):
            flags[name] = f"CAST({col} AS INT)"
        elif isinstance(dtype, (T.StringType, T.NullType)):
            flags[name] = X.yes_no_flag(col, yes, no)
        else:
            raise TypeError(f"{name} is {dtype.simpleString()}, not a text flag")
    return flags


def _int_exprs(schema: T.StructType, cols: Iterable[str]) -> dict[str, str]:
    return {c: f"CAST({quoted(c)} AS INT)" for c in cols if c in schema.names}


def _number_exprs(
    schema: T.StructType, cols: Iterable[str], fill: float | None, on_error: str
) -> dict[str, str]:
    names = list(cols)
    missing = [c for c in names if c not in schema.names]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    exprs = {
        c: quoted(c)
        if isinstance(schema[c].dataType, T.DoubleType)
        else X.blank_to_null(quoted(c), on_error)
        for c in names
    }
    return exprs if fill is None else {c: X.filled(e, fill) for c, e in exprs.items()}


def _replace(df: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.expr(e) for c, e in exprs.items()}) if exprs else df


def yes_no_to_int(
    df: DataFrame, cols: Iterable[str], yes: str = "Yes", no: str = "No"
) -> DataFrame:
    """Text flags to 1 / 0 / NULL. Absent columns are skipped; columns that
    are whole numbers already stay, so a second run changes nothing."""
    return _replace(df, _flag_exprs(df.schema, cols, yes, no))


def cast_int_flags(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Numeric flags to int; absent columns are skipped."""
    return _replace(df, _int_exprs(df.schema, cols))


def blank_to_null_numeric(
    df: DataFrame, cols: Iterable[str], fill: float | None = None, on_error: str = X.RAISE
) -> DataFrame:
    """Text numbers to double: trimmed, blanks as NULL, then ``fill``."""
    return _replace(df, _number_exprs(df.schema, cols, fill, on_error))


def fill_null(df: DataFrame, cols: Iterable[str], value: float = 0.0) -> DataFrame:
    """Replace NULL, and NaN in floating columns, by ``value``."""
    return df.fillna(value, subset=list(cols))


# The number of rows in an observation of lost values; no snake-case name has it.
ROWS_READ = "ROWS READ"


@dataclass(frozen=True)
class CleanSpec:
    """What to clean; names are the snake-case ones after ``fixes``."""

    keys: tuple[str, ...]
    fixes: Mapping[str, str] = field(default_factory=dict)
    yes_no: tuple[str, ...] = ()
    yes: str = "Yes"
    no: str = "No"
    int_flags: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    fill: float | None = 0.0
    order_by: tuple[str, ...] = ()
    on_error: str = X.RAISE


def coercions(schema: T.StructType, spec: CleanSpec) -> dict[str, str]:
    """For each text column of ``spec`` the SQL aggregate that counts its lost
    values: filled, and NULL after cleaning. Blank numbers were empty before, so
    they are not lost."""
    flags = _flag_exprs(schema, spec.yes_no, spec.yes, spec.no)
    numbers = _number_exprs(schema, spec.numbers, None, X.NULL)
    lost = {
        **{c: f"{quoted(c)} IS NOT NULL AND ({e}) IS NULL" for c, e in flags.items()},
        **{c: f"nullif(trim({quoted(c)}), '') IS NOT NULL AND ({e}) IS NULL" for c, e in numbers.items()},
    }
    return {c: f"count_if({e})" for c, e in lost.items() if isinstance(schema[c].dataType, T.StringType)}


def standardise(df: DataFrame, spec: CleanSpec, lost: Observation | None = None) -> DataFrame:
    """All per-row cleaning of ``spec``: one projection, no shuffle. With
    ``lost``, the number of values of each column that became NULL is observed
    by whatever runs the result, without another scan; read it as
    ``lost.get`` afterwards. Rows count before duplicates go; a stage that runs
    again after a lost executor counts its rows again."""
    df = snake_case_columns(df, spec.fixes)
    if lost is not None:
        counts = coercions(df.schema, spec)
        df = df.observe(lost, F.count(F.lit(1)).alias(ROWS_READ), *[F.expr(e).alias(c) for c, e in counts.items()])
    return _replace(
        df,
        {
            **_flag_exprs(df.schema, spec.yes_no, spec.yes, spec.no),
            **_int_exprs(df.schema, spec.int_flags),
            **_number_exprs(df.schema, spec.numbers, spec.fill, spec.on_error),
        },
    )


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Standardise, then keep one row per key: one shuffle in all."""
    return dedup_by_key(standardise(df, spec), spec.keys, spec.order_by)
