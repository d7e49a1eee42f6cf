"""Sharding by sampled splitters.

Draw a size-weighted sample of keys, take its quantiles as boundaries, put each
record into the range of its key, subdivide ranges that came out overfull, and
cut the key order into shards of near equal bytes. Built-in functions only; the
driver sees the sample, the boundaries and one line per range: their number is
bounded, so all three are, whatever the table's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import constant, staged

ROWS_PER_RANGE = 200_000
# Of a table so large that this many ranges are not enough, ranges hold more rows:
# each is still a narrow sort of a small part of the table, which can spill.
MAX_RANGES = 4_096


def range_of(key: Column, bounds: list[tuple]) -> Column:
    """How many of the sorted ``bounds`` are at or below ``key``, by bisection."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    table = constant([dict(zip("abc", b)) for b in bounds], "struct<a:bigint,b:bigint,c:bigint>")

    def move(at: Column, step: Column) -> Column:
        ahead = at + step
        fits = (ahead <= len(bounds)) & (F.get(table, ahead - 1) <= key)
        return F.when(fits, ahead).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), move)


def shard_by_size(
    docs: DataFrame,
    *,
    shards: int = 8,
    oversample: int = 16,
    rounds: int = 4,
    seed: int = 11,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """Every row of ``docs`` with its shard and its slot in that shard.

    The key is (hash of the text, ``doc_id``, row number), so equal texts lie
    side by side; a group of equal texts that lies across the end of a shard is
    cut there, between its rows. Shard ``s`` takes the rows whose middle byte falls in
    the s-th part of all bytes in key order: sizes differ from the mean by
    less than the size of one row. About ``oversample`` keys for each of at most
    ``max_ranges`` ranges are drawn in a round, by size; how the ranges fall
    changes no result. Returns ``doc_id``, ``size`` (UTF-8 bytes
    plus 1), ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless from 0 in
    key order) and ``grown_shard`` (NULL under this law).

    NULL texts count as empty, NULL ids come first, repeated rows get slots of
    their own, an empty table gives no rows. Only ``doc_id`` and ``text`` are
    read, so other columns may have any name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    key = F.struct(F.col("hash").alias("a"), F.col("doc_id").cast("long").alias("b"), F.col("row").alias("c"))
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = whole["bytes"]
    wanted = max(8 * shards, min(max_ranges, max(64 * shards, -(-whole["n"] // ROWS_PER_RANGE))))
    bounds: list = []
    sizes = {0: total}
    for turn in range(rounds):
        # overfull ranges, each with how many parts it should become
        full = {r: -(-b * wanted // max(total, 1)) for r, b in sizes.items() if b * wanted > 2 * total}
        if not full:
            break
        rate = [oversample * full[r] / max(sizes.get(r, 0), 1) if r in full else 0.0 for r in range(len(bounds) + 1)]
        placed = rows.withColumn("at", range_of(key, bounds))
        sample = sorted(
            placed.where(F.rand(seed + turn) < F.get(constant(rate, "double"), F.col("at")) * F.col("size"))
            .select("at", "hash", "doc_id", "row")
            .collect(),
            key=lambda r: (r["at"], r["hash"], r["doc_id"] is not None, r["doc_id"] or 0, r["row"]),
        )
        drawn: dict = {}
        for r in sample:
            drawn.setdefault(r["at"], []).append((r["hash"], r["doc_id"], r["row"]))
        new = {keys[i * len(keys) // full[r]] for r, keys in drawn.items() for i in range(1, full[r])}
        if not new - set(bounds):
            break
        bounds = sorted({*bounds, *new}, key=lambda b: (b[0], b[1] is not None, b[1] or 0, b[2]))
        found = (
            rows.groupBy(range_of(key, bounds).alias("at"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        sizes = {r["at"]: r["bytes"] for r in found}

    offsets, before = [], 0
    for r in range(len(bounds) + 1):
        offsets.append(before)
        before += sizes.get(r, 0)
    in_range = Window.partitionBy("at").orderBy("hash", F.col("doc_id").asc_nulls_first(), "row")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = staged(
        rows.withColumn("at", range_of(key, bounds))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "at",
            F.row_number().over(in_range).alias("rank"),
            # twice the place of the row's middle byte in the order of all bytes
            (2 * (F.get(constant(offsets, "bigint"), F.col("at")) + F.sum("size").over(so_far)) - F.col("size")).alias("middle"),
        )
        .withColumn("shard", F.expr(f"CAST(least({shards - 1}, middle * {shards} div {2 * max(total, 1)}) AS INT)")),
        "ranges",
    )
    counted = cut.groupBy("at", "shard").agg(F.count(F.lit(1)).alias("n")).collect()
    rows_before = running(len(bounds) + 1, {}, [(r["at"], r["n"]) for r in counted])
    shard_start = running(shards, {}, [(r["shard"], r["n"]) for r in counted])
    slot = F.get(constant(rows_before, "bigint"), F.col("at")) + F.col("rank") - 1 - F.get(constant(shard_start, "bigint"), F.col("shard"))
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def running(n: int, sums: dict[int, int], counts: list[tuple[int, int]]) -> list[int]:
    """How many rows come before each of ``n`` numbered groups."""
    for group, rows in counts:
        sums[group] = sums.get(group, 0) + rows
    out, before = [], 0
    for group in range(n):
        out.append(before)
        before += sums.get(group, 0)
    return out
