"""Connected components by alternating large and small stars.

Each round is joins and aggregates over the edge list, written to the shared
folder; the driver sees three numbers per round. Edges never grow beyond the
input plus one per node, no node's neighbours are gathered in one task, and a
hub's partition is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import drop_staged, rekeyed, staged_at


def _with_least(edges: DataFrame, kind: str) -> DataFrame:
    """Each row (``a``, ``b``) with ``m``: the least ``b`` of its ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(rekeyed(F.col("a"), kind).alias("at"), "m")
    return edges.join(least, F.col("a") == F.col("at")).drop("at")


def _large_star(edges: DataFrame, kind: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = _with_least(both, kind).where("b > a")
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, kind: str) -> DataFrame:
    met = _with_least(edges, kind)  # here a > b always
    moved = met.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(met.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, *, kind: str = "long", max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for every node of the
    edges ``a``, ``b``. Loops, repeated edges and edges with a NULL end add
    nothing; no edges give no rows. ``kind`` is ``long`` or ``string``.
    """
    spark = edges.sparkSession
    links = (
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    now, path = staged_at(links, "edges")

    def mark(df: DataFrame) -> tuple:
        # pmod keeps the sum of the hashes within a long
        got = df.agg(F.count(F.lit(1)), F.sum(F.expr("pmod(xxhash64(a, b), 4294967296)"))).first()
        return tuple(got)

    before = mark(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        then, then_path = staged_at(_small_star(_large_star(now, kind), kind), "edges")
        after = mark(then)
        drop_staged(spark, path)
        now, path = then, then_path
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
