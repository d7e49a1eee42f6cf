"""SimHash near-duplicates over a byte-position inverted index.

Fingerprints of 64 bits are 8 positional bytes. Two that differ in at most two
bits share at least six of them (count filtering), and so, for some two of the
four pairs of neighbouring positions, all four bytes. These quadruples are the
postings of the index; single bytes would make 2,048 lists that each grow with
the corpus. Pairs that meet in a posting have their shared positional bytes
tallied, those that reach six are kept, and their bits verified.

A posting longer than ``pair_limit`` emits no pairs. There two fingerprints are
linked through the values between them: they differ by at most two bits exactly
if some value differs from each by at most one bit, so each fingerprint emits
itself and its one-bit neighbours within the posting, and equal values link.
That is exact and grows with the posting's length, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, rekeyed, row_key, staged
from tablewright.llm.components import connected_components

SEED = 42
POSITIONS = 8


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed long. A bit is 1 if it is set in over half
    the hashes of the word shingles; a text without words gets zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    counts, n, size = np.zeros(64, np.int64), 0, 1 << 16
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    for at in range(0, len(hashes), size):  # long texts in slices
        part = hashes[at : at + size]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return prints(text)


def byte_at(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame) -> DataFrame:
    """Six rows per fingerprint: which four positions, and their bytes."""
    pairs = [(0, 1), (2, 3), (4, 5), (6, 7)]
    entries = []
    for number, (one, two) in enumerate(combinations(pairs, 2)):
        mask = sum(255 << (8 * p) for p in (*one, *two))
        mask -= (1 << 64) if mask >> 63 else 0
        entries.append(F.struct(F.lit(number).alias("slot"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("bytes")))
    return prints.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.*")


def slot_masks() -> list[list[int]]:
    """For each slot, the single bits outside its four positions."""
    pairs = [(0, 1), (2, 3), (4, 5), (6, 7)]
    out = []
    for one, two in combinations(pairs, 2):
        free = [p for p in range(POSITIONS) if p not in (*one, *two)]
        bits = [1 << (8 * p + b) for p in free for b in range(8)]
        out.append([0, *[b - (1 << 64) if b >> 63 else b for b in bits]])
    return out


def links(prints: DataFrame, max_bits: int, pair_limit: int) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints that together connect
    exactly those within ``max_bits`` (1 or 2)."""
    if not 1 <= max_bits <= 2:
        raise ValueError("the index guarantees at most two differing bits")
    least_shared = POSITIONS - max_bits
    lists = staged(postings(prints), "postings")
    sizes = lists.groupBy("slot", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select(F.col("slot").alias("s_slot"), rekeyed(F.col("bytes")).alias("s_bytes"), "n")
    shared = staged(
        lists.join(sizes, (F.col("slot") == F.col("s_slot")) & (F.col("bytes") == F.col("s_bytes"))).drop("s_slot", "s_bytes"),
        "shared-postings",
    )
    few = shared.where(F.col("n") <= pair_limit).select("slot", "bytes", F.col("fp").alias("a"))
    other = few.withColumnsRenamed({"slot": "o_slot", "bytes": "o_bytes", "a": "b"})
    met = few.join(other, (F.col("slot") == F.col("o_slot")) & (F.col("bytes") == F.col("o_bytes")) & (F.col("a") < F.col("b")))
    tally = sum(
        ((byte_at(F.col("a"), p) == byte_at(F.col("b"), p)).cast("int") for p in range(1, POSITIONS)),
        (byte_at(F.col("a"), 0) == byte_at(F.col("b"), 0)).cast("int"),
    )
    paired = met.where(tally >= least_shared).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")

    many = shared.where(F.col("n") > pair_limit)
    if max_bits == 2:
        masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in row]) for row in slot_masks()])
        near = many.select("slot", "fp", F.explode(F.get(masks, F.col("slot"))).alias("mask"))
        near = near.select("slot", "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("between"))
        # a value has 33 neighbours in its slot, so these sets are small
        met = near.groupBy("slot", "between").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
        through = met.select(F.explode("all").alias("a"), "b").where("a != b")
    else:
        masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in row[1:]]) for row in slot_masks()])
        near = many.select("slot", F.col("fp").alias("a"), F.explode(F.get(masks, F.col("slot"))).alias("mask"))
        near = near.select("slot", "a", F.col("a").bitwiseXOR(F.col("mask")).alias("b"))
        there = many.select(F.col("slot").alias("o_slot"), F.col("fp").alias("o_fp"))
        through = near.join(there, (F.col("slot") == F.col("o_slot")) & (F.col("b") == F.col("o_fp"))).select("a", "b")
    return paired.unionByName(through).distinct()


def rows_with_root(docs: DataFrame, shingle: int, max_bits: int, pair_limit: int) -> DataFrame:
    """One row per row of ``docs``: its key ``_id`` and ``_th``, ``fp``,
    ``root`` (the component's least fingerprint) and ``component_id``."""
    marked = staged(docs.select(*row_key("doc_id", "text"), fingerprint_column(F.col("text"), shingle).alias("fp")), "prints")
    classes = staged(marked.groupBy("fp").agg(F.min("_id").alias("least")), "classes")
    roots = connected_components(links(classes.select("fp"), max_bits, pair_limit))
    joined = classes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    joined = staged(joined.select("fp", "least", "root"), "roots")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = ids.select(rekeyed(F.col("root")).alias("r_root"), "component_id")
    named = joined.join(ids, F.col("root") == F.col("r_root")).select(F.col("fp").alias("c_fp"), "root", "component_id")
    named = staged(named, "components")
    return marked.join(named, F.col("fp") == F.col("c_fp")).drop("c_fp")


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, pair_limit: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (least ``doc_id`` reachable over links of at most
    ``max_bits`` bits) and ``_fp`` (the fingerprint as a long).

    Equal fingerprints are one class before any candidate is sought. Texts
    without words (NULL, empty) have fingerprint zero and link like any other.
    Rows that repeat an id each get a row; NULL ids count as no id when the
    least is sought, so a component of NULL ids only has a NULL id. An empty
    table gives no rows. Lists of postings with more than ``pair_limit`` entries
    are not paired and tallied but linked through the values between two
    fingerprints; both give the same links.
    """
    return rows_with_root(docs, shingle, max_bits, pair_limit).select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("fp").alias("_fp"),
    )


def keep_one(docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, pair_limit: int = 64) -> DataFrame:
    """``docs`` with one row of each component: its least id. Of rows of the
    component that repeat that id, the one with the least text hash stays; of
    equal rows, one. NULL ids come last, and a component of NULL ids only keeps
    the least text hash."""
    found = rows_with_root(docs, shingle, max_bits, pair_limit)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_th")).alias("k"))
    keep = staged(least.select("k._id", "k._th"), "kept")
    id_, th, rank = free_name(docs, "_keep_id"), free_name(docs, "_keep_th"), free_name(docs, "_rank")
    keep = keep.select(F.col("_id").alias(id_ + "r"), F.col("_th").alias(th + "r"))
    keyed = docs.select("*", F.col("doc_id").alias(id_), F.xxhash64("text").alias(th))
    kept = keyed.join(keep, F.col(id_).eqNullSafe(F.col(id_ + "r")) & (F.col(th) == F.col(th + "r")), "left_semi")
    order = Window.partitionBy(id_, th).orderBy(F.xxhash64("text"))
    return kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank, id_, th)
