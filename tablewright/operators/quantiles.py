"""Exact quantiles at any size.

``percentile`` keeps every distinct value of a column in one buffer, so it does
not scale. Here a sketch brackets each quantile, an exact count says how many
rows lie below the bracket, and the bracket is narrowed until few rows are left
in it; only those are grouped by value and ranked. Every step is an aggregation
with a result of fixed size, and the sketch never decides a value.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.expressions import number
from tablewright.functions.naming import quoted, rows_of, text

# Relative error of one sketch, points read from it, and how many sketches are
# kept apart in the first level.
ACCURACY, GRID, BUCKETS = 10_000, 2_000, 256

# A table up to so many rows has few enough partitions that the sketches of all
# of them can meet in one task; a larger one takes two levels.
ONE_LEVEL_ROWS = 500_000_000


@dataclass
class _Bracket:
    """The rows of one column among which the two ranks around a quantile lie."""

    column: str
    prob: float
    total: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    narrowing: bool = True

    def __post_init__(self):
        self.inside = self.total

    @property
    def position(self) -> float:
        return self.prob * (self.total - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    @property
    def value(self) -> str:
        return f"CAST({quoted(self.column)} AS DOUBLE)"

    @property
    def holds(self) -> str:
        low, high = number(self.low), number(self.high)
        return f"({self.value} >= {low} AND {self.value} <= {high})"

    def guesses(self) -> tuple[float, float]:
        """Where in the bracket to look: a little outside the two ranks."""
        slack = 2 / ACCURACY + 3 / GRID
        first, second = ((r - self.below) / self.inside for r in self.ranks)
        return max(0.0, first - slack), min(1.0, second + slack)

    def tighten(self, low: float, high: float, below: int, upto: int) -> None:
        """Take over each bound that the exact counts confirm."""
        before, first, last = self.inside, *self.ranks
        kept_upto = self.below + self.inside
        if below <= first:
            self.low, self.below = low, below
        if upto > last:
            self.high, kept_upto = high, upto
        self.inside = kept_upto - self.below
        self.narrowing = self.inside < before


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    max_rows: int = 1_000_000,
    *,
    one_level_rows: int = ONE_LEVEL_ROWS,
) -> DataFrame:
    """(column, prob, value) with linear interpolation between the two nearest
    rows. NULL and NaN do not count; a column without values gives NULL. ``df``
    is read several times, so it should be a stored table."""
    finite = {c: f"nanvl(CAST({quoted(c)} AS DOUBLE), NULL)" for c in cols}
    df = df.selectExpr(*[f"{e} AS {quoted(c)}" for c, e in finite.items()])
    totals = df.agg(*[F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in cols]).first()
    brackets = [_Bracket(c, p, totals[c]) for c in cols for p in probs if totals[c]]

    while True:
        wide = [b for b in brackets if b.narrowing and b.inside > max_rows and b.low < b.high]
        if not wide:
            break
        few = max(totals) <= one_level_rows
        guesses = _sketch_at_once(df, wide) if few else _sketch(df, wide)
        counts = []
        for i, b in enumerate(wide):
            low, high = guesses[i]
            counts += [
                F.expr(f"count_if({b.value} < {number(low)}) AS below{i}"),
                F.expr(f"count_if({b.value} <= {number(high)}) AS upto{i}"),
            ]
        found = df.agg(*counts).first()
        for i, b in enumerate(wide):
            b.tighten(*guesses[i], found[f"below{i}"], found[f"upto{i}"])

    return _rank(df, brackets, cols, probs)


def _sketch_at_once(df: DataFrame, brackets: Sequence[_Bracket]) -> list[tuple[float, float]]:
    """Two sketched values per bracket, in one aggregation; equal brackets share
    a sketch."""
    groups: dict[tuple, list[int]] = {}
    for i, b in enumerate(brackets):
        groups.setdefault((b.column, b.low, b.high), []).append(i)
    sketched = []
    for members in groups.values():
        first = brackets[members[0]]
        probs = ", ".join(f"{p!r}D" for i in members for p in brackets[i].guesses())
        inside = f"IF({first.holds}, {first.value}, NULL)"
        sketched.append(F.expr(f"percentile_approx({inside}, array({probs}), {ACCURACY})"))
    found: list[tuple[float, float]] = [(-math.inf, math.inf)] * len(brackets)
    for members, values in zip(groups.values(), df.agg(*sketched).first()):
        for n, i in enumerate(members):
            found[i] = (values[2 * n], values[2 * n + 1])
    return found


def _sketch(df: DataFrame, brackets: Sequence[_Bracket]) -> list[tuple[float, float]]:
    """Two sketched values per bracket; equal brackets share a sketch.

    Sketches of the map tasks meet in two levels, so no task takes them all:
    first those of each bucket of partitions, then a grid of points from each
    bucket, weighted by its rows."""
    groups: dict[tuple, list[int]] = {}
    for i, b in enumerate(brackets):
        groups.setdefault((b.column, b.low, b.high), []).append(i)
    # one constant, however many points
    grid = f"from_json('{json.dumps([i / GRID for i in range(GRID + 1)])}', 'array<double>')"
    sketched, guesses = [], []
    for g, members in enumerate(groups.values()):
        first = brackets[members[0]]
        inside = f"IF({first.holds}, {first.value}, NULL)"
        points = f"percentile_approx({inside}, {grid}, {ACCURACY})"
        sketched.append(F.expr(f"struct({g} AS g, {points} AS points, count({inside}) AS n) AS s{g}"))
        for prob in (p for i in members for p in brackets[i].guesses()):
            guesses.append(F.min(F.expr(f"IF(g = {g} AND upto >= {prob!r}D * total, v, NULL)")))
    buckets = df.withColumn("__bucket", F.spark_partition_id() % BUCKETS).groupBy("__bucket").agg(*sketched)
    points = buckets.select(F.explode(F.array(*[f"s{g}" for g in range(len(groups))])).alias("s"))
    points = points.select("s.g", "s.n", F.explode("s.points").alias("v"))
    weights = points.groupBy("g", "v").agg(F.sum("n").cast("double").alias("w"))
    whole = Window.partitionBy("g")
    upto = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = weights.select("g", "v", F.sum("w").over(upto).alias("upto"), F.sum("w").over(whole).alias("total"))
    values = iter(placed.agg(*[guess.alias(f"v{n}") for n, guess in enumerate(guesses)]).first())
    found: list[tuple[float, float]] = [(-math.inf, math.inf)] * len(brackets)
    for members in groups.values():
        for i in members:
            found[i] = (next(values), next(values))
    return found


def _rank(
    df: DataFrame, brackets: Sequence[_Bracket], cols: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """Group the rows in the brackets by value and read off the two ranks."""
    spark = df.sparkSession
    asked = spark.range(1).selectExpr(
        rows_of(("column", "prob"), [(text(c), f"{p!r}D") for c in cols for p in probs])
    )
    if not brackets:
        return asked.withColumn("value", F.lit(None).cast("double"))
    picks = ", ".join(f"IF({b.holds}, {b.value}, NULL)" for b in brackets)
    counted = (
        df.where(" OR ".join(b.holds for b in brackets))
        .selectExpr(f"posexplode(array({picks})) AS (b, v)")
        .where("v IS NOT NULL")
        .groupBy("b", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(
        Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = spark.range(1).selectExpr(
        rows_of(
            ("b", "column", "prob", "first", "last", "part"),
            [
                (
                    str(i),
                    text(b.column),
                    f"{b.prob!r}D",
                    f"{b.ranks[0] - b.below}L",
                    f"{b.ranks[1] - b.below}L",
                    f"{b.position - b.ranks[0]!r}D",
                )
                for i, b in enumerate(brackets)
            ],
        )
    )
    ranked = counted.withColumn("upto", upto).join(F.broadcast(ends), "b")
    values = (
        ranked.groupBy("column", "prob", "part")
        .agg(
            F.min(F.when(F.col("upto") > F.col("first"), F.col("v"))).alias("low"),
            F.min(F.when(F.col("upto") > F.col("last"), F.col("v"))).alias("high"),
        )
        .selectExpr("column", "prob", "IF(low = high, low, low + (high - low) * part) AS value")
    )
    return asked.join(F.broadcast(values), ["column", "prob"], "left")
