"""Quality gate: declared rules, compiled into one aggregation.

Every rule is a number of violations. Rules on data are aggregates, rules on
the schema are constants, and the whole gate is a single ``agg`` over a single
scan, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted, rows_of, text
from tablewright.operators.cleaning import ROWS_READ
from tablewright.operators.columns import columns_with_suffix, out_of_range
from tablewright.operators.profiling import distinct_expr

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True, kw_only=True)
class Rule:
    """A named check. ``needs`` are the columns it reads; if one is absent,
    the check counts as one schema violation."""

    severity: str = ERROR

    kind = "logic"

    @property
    def name(self) -> str:
        raise NotImplementedError

    @property
    def needs(self) -> tuple[str, ...]:
        return ()

    def violations(self, df: DataFrame) -> Column:
        raise NotImplementedError


@dataclass(frozen=True, kw_only=True)
class _OnColumn(Rule):
    col: str = ""

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.col,)

    @property
    def ref(self) -> Column:
        return F.col(quoted(self.col))


@dataclass(frozen=True, kw_only=True)
class MinRows(Rule):
    """At least ``n`` rows; ``n`` itself passes. Violations: rows short."""

    n: int = 1000
    kind = "volume"

    @property
    def name(self) -> str:
        return f"min_rows_{self.n}"

    def violations(self, df: DataFrame) -> Column:
        return F.greatest(F.lit(self.n) - F.count(F.lit(1)), F.lit(0))


@dataclass(frozen=True, kw_only=True)
class NotNull(_OnColumn):
    kind = "completeness"

    @property
    def name(self) -> str:
        return f"not_null_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        # a difference of counts, which file footers can answer (see read_statistics)
        return F.count(F.lit(1)) - F.count(self.ref)


@dataclass(frozen=True, kw_only=True)
class Unique(Rule):
    """Rows minus distinct keys; NULL is one key."""

    keys: tuple[str, ...] = ()
    kind = "uniqueness"

    @property
    def name(self) -> str:
        return "unique_" + "_".join(self.keys)

    @property
    def needs(self) -> tuple[str, ...]:
        return self.keys

    def violations(self, df: DataFrame) -> Column:
        return F.count(F.lit(1)) - distinct_expr(self.keys)


@dataclass(frozen=True, kw_only=True)
class InRange(_OnColumn):
    """Values in ``[low, high]``; NULL passes."""

    low: float = 0.0
    high: float = 0.0

    @property
    def name(self) -> str:
        return f"in_range_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        return F.count_if(out_of_range(self.ref, self.low, self.high))


@dataclass(frozen=True, kw_only=True)
class NonNegative(_OnColumn):
    kind = "anomaly"

    @property
    def name(self) -> str:
        return f"non_negative_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        return F.count_if(self.ref < 0)


@dataclass(frozen=True, kw_only=True)
class AtLeastEqual(_OnColumn):
    """At least ``n`` rows equal to ``value``. Violations: rows short."""

    value: float = 0.0
    n: int = 1

    @property
    def name(self) -> str:
        return f"at_least_{self.n}_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        return F.greatest(F.lit(self.n) - F.count_if(self.ref == self.value), F.lit(0))


@dataclass(frozen=True, kw_only=True)
class HasColumn(_OnColumn):
    kind = "schema"

    @property
    def name(self) -> str:
        return f"has_column_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        return F.lit(0)


@dataclass(frozen=True, kw_only=True)
class HasType(_OnColumn):
    dtype: str = ""
    kind = "schema"

    @property
    def name(self) -> str:
        return f"has_type_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        wanted = T.DataType.fromDDL(self.dtype)
        return F.lit(int(df.schema[self.col].dataType != wanted))


@dataclass(frozen=True, kw_only=True)
class AnyColumnWithSuffix(Rule):
    suffix: str = "_vec"
    kind = "schema"

    @property
    def name(self) -> str:
        return f"any_column{self.suffix}"

    def violations(self, df: DataFrame) -> Column:
        return F.lit(int(not columns_with_suffix(df, self.suffix)))


@dataclass(frozen=True, kw_only=True)
class NoColumnContaining(Rule):
    """No column name holds ``text``, for instance a file signature that a
    reader took for a header."""

    text: str = "PK"
    kind = "schema"

    @property
    def name(self) -> str:
        return f"no_column_containing_{self.text}"

    def violations(self, df: DataFrame) -> Column:
        return F.lit(sum(self.text in c for c in df.columns))


@dataclass(frozen=True, kw_only=True)
class FewCoerced(Rule):
    """At most ``allowed`` values of a column became NULL when it was cleaned.
    ``seen`` is their number, counted by the write of the cleaned table (see
    :func:`tablewright.operators.cleaning.standardise`). Violations: the excess."""

    col: str = ""
    seen: int = 0
    allowed: int = 0
    kind = "coercion"

    @property
    def name(self) -> str:
        return f"few_coerced_{self.col}"

    def violations(self, df: DataFrame) -> Column:
        return F.lit(max(self.seen - self.allowed, 0))


def coercion_rules(lost: Mapping[str, int], allowed: int = 0, severity: str = ERROR) -> list[Rule]:
    """A rule for each column of an observation of lost values."""
    return [
        FewCoerced(col=c, seen=n, allowed=allowed, severity=severity)
        for c, n in sorted(lost.items())
        if c != ROWS_READ
    ]


def run_gate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, kind, severity, violations, passed), one row per rule."""
    present = set(df.columns)
    absent = [not present.issuperset(rule.needs) for rule in rules]
    counted = [
        F.lit(1) if gone else rule.violations(df) for rule, gone in zip(rules, absent)
    ]
    totals = df.agg(*[c.cast("long").alias(f"v{i}") for i, c in enumerate(counted)])
    rows = [
        (
            text(rule.name),
            text("schema" if gone else rule.kind),
            text(rule.severity),
            f"v{i}",
            f"v{i} = 0",
        )
        for i, (rule, gone) in enumerate(zip(rules, absent))
    ]
    return totals.selectExpr(rows_of(("rule", "kind", "severity", "violations", "passed"), rows))


def gate_verdict(report: DataFrame) -> DataFrame:
    """One row: whether all error rules passed, and how many failed."""
    failed = F.col("severity").eqNullSafe(ERROR) & ~F.col("passed")
    return report.agg(
        (F.count_if(failed) == 0).alias("passed"),
        F.count_if(failed).alias("failed_rules"),
        F.array_sort(F.collect_list(F.when(failed, F.col("rule")))).alias("reasons"),
    )


class GateFailed(Exception):
    """Raised at the edge of a job when an error rule has violations."""

    def __init__(self, reasons: Sequence[str]):
        self.reasons = list(reasons)
        super().__init__("; ".join(self.reasons))


def enforce_gate(report: DataFrame) -> list[str]:
    """Run the gate (one job, one row per rule on the driver). Raises with
    every failed error rule; returns the warnings otherwise."""
    rows = [r for r in report.collect() if not r["passed"]]
    texts = {
        s: [f"{r['kind']}: {r['rule']} ({r['violations']})" for r in rows if r["severity"] == s]
        for s in (ERROR, WARN)
    }
    if texts[ERROR]:
        raise GateFailed(texts[ERROR])
    return texts[WARN]
