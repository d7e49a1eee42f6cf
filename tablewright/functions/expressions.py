"""Expressions over one column, as SQL text for ``expr``: one call each, all
built-in functions, so Catalyst sees through them and they stay inside
whole-stage code generation. ``col`` is any SQL expression."""

from __future__ import annotations

import math
from collections.abc import Sequence

from tablewright.functions.naming import text

RAISE = "raise"
NULL = "null"

# Up to this many labels the unit vectors are plan literals (a lookup per
# row); beyond it each vector is put together from its slot number.
LITERAL_VECTORS = 64


def check_on_error(on_error: str) -> None:
    if on_error not in (RAISE, NULL):
        raise ValueError(f"on_error must be {RAISE!r} or {NULL!r}, not {on_error!r}")


def number(value: float) -> str:
    """A double literal."""
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{float(value)}')"


def yes_no_flag(col: str, yes: str = "Yes", no: str = "No") -> str:
    """1 / 0 / NULL for exactly ``yes`` / ``no`` / anything else."""
    return f"CASE {col} WHEN {text(yes)} THEN 1 WHEN {text(no)} THEN 0 END"


def blank_to_null(col: str, on_error: str = RAISE) -> str:
    """Trimmed text as double, blanks as NULL. Text that is no number fails
    the job, or becomes NULL with ``on_error="null"``."""
    check_on_error(on_error)
    cast = "try_cast" if on_error == NULL else "cast"
    return f"{cast}(nullif(trim({col}), '') AS DOUBLE)"


def filled(col: str, value: float) -> str:
    """``value`` in place of NULL and NaN, as ``fillna`` does for doubles."""
    return f"coalesce(nanvl({col}, NULL), {number(value)})"


def ratio(num: str, den: str, on_error: str = RAISE) -> str:
    """``num / den``; a zero divisor fails the job or gives NULL."""
    check_on_error(on_error)
    return f"try_divide({num}, {den})" if on_error == NULL else f"({num} / {den})"


def bucket_index(col: str, splits: Sequence[float], on_error: str = RAISE) -> str:
    """Index of the half-open bucket ``[a, b)`` as double; the last bucket is
    closed. NULL stays NULL. Values outside all buckets (and NaN) fail the
    job, or become NULL with ``on_error="null"``."""
    check_on_error(on_error)
    bounds = [float(s) for s in splits]
    if len(bounds) < 3 or any(math.isnan(b) for b in bounds) or sorted(set(bounds)) != bounds:
        raise ValueError(f"splits must be at least three strictly increasing numbers: {splits}")
    # Inside the outer bounds one upper bound per bucket decides. NaN sorts
    # above infinity in Spark, so it fails the outer test as it should.
    steps = " ".join(
        f"WHEN {col} < {number(upper)} THEN {number(i)}" for i, upper in enumerate(bounds[1:-1])
    )
    outside = "NULL"
    if on_error == RAISE:
        outside = f"raise_error(concat('value outside the buckets: ', CAST({col} AS STRING)))"
    return (
        f"CAST(CASE WHEN {col} IS NULL THEN NULL "
        f"WHEN {col} >= {number(bounds[0])} AND {col} <= {number(bounds[-1])} "
        f"THEN CASE {steps} ELSE {number(len(bounds) - 2)} END ELSE {outside} END AS DOUBLE)"
    )


def slot_of(col: str, labels: Sequence[str]) -> str:
    """Zero-based slot of the value in ``labels``; NULL and unseen values get
    the extra last slot. Labels are ordered by frequency, so the search of
    the literal list is short for most rows."""
    known = f"CAST(array({', '.join(map(text, labels))}) AS array<string>)"
    position = f"array_position({known}, CAST({col} AS STRING))"
    return f"CAST(coalesce(nullif({position}, 0) - 1, {len(labels)}) AS INT)"


def one_hot_array(slot: str, size: int) -> str:
    """A dense double array of ``size`` with 1.0 at ``slot``."""
    if size <= LITERAL_VECTORS:
        units = (
            ", ".join("1D" if i == j else "0D" for j in range(size)) for i in range(size)
        )
        table = ", ".join(f"array({u})" for u in units)
        return f"element_at(array({table}), CAST({slot} AS INT) + 1)"
    at = f"CAST({slot} AS INT)"
    return f"concat(array_repeat(0D, {at}), array(1D), array_repeat(0D, {size - 1} - {at}))"


def one_hot_sparse(slot: str, size: int) -> str:
    """The vector of ``size`` with 1.0 at ``slot`` as a struct (size, indices,
    values) of sorted slots and their values; its width does not grow with
    ``size``."""
    at = f"array(CAST({slot} AS BIGINT))"
    return f"named_struct('size', {size}L, 'indices', {at}, 'values', array(1D))"


def dense_of(sparse: str) -> str:
    """A sparse struct as a dense double array."""
    at = f"array_position({sparse}.indices, i)"
    value = f"coalesce(element_at({sparse}.values, CAST(nullif({at}, 0) AS INT)), 0D)"
    every = f"CASE WHEN {sparse}.size > 0 THEN sequence(0L, {sparse}.size - 1) ELSE array() END"
    return f"CASE WHEN {sparse} IS NOT NULL THEN transform({every}, i -> {value}) END"
