"""Benchmark decontamination by winnowing.

Of the k-grams of words in every window, the one with the least hash is kept.
Test and training fingerprints are joined, and each hit is extended word by word
to both sides. A window of ``window`` words holds ``window - k + 1`` k-grams, so
each shared span of that length has a fingerprint in common: none is missed, and
the words themselves are compared, so none is made up. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import ascii_lower, join_keyed, row_key, staged
from tablewright.session import fits_broadcast

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def loose_words(text: Column) -> Column:
    """As many words as ``words_of`` has, with all letters in lower case and not
    only A-Z. Faster, and texts that share words there share them here: the one
    letter whose lower case depends on its neighbours, a sigma at the end of a
    word, is made the same everywhere."""
    lower = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\u03c2"), F.lit("\u03c3"))
    return F.array_remove(F.split(lower, NO_WORD), "")


def at_each(n: Column, make) -> Column:
    """``make(i)`` for i from 0 to ``n - 1``."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make))


def hash_words(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def hash_grams(hashes: str, k: int) -> Column:
    return at_each(F.size(hashes) - (k - 1), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))


def window_minima(grams: str, span: int) -> Column:
    if span == 1:
        return F.col(grams)
    return at_each(F.size(grams) - (span - 1), lambda i: F.least(*[F.get(grams, i + j) for j in range(span)]))


def minima(rows: DataFrame, words: str, lengths: list[tuple[int, int]]) -> DataFrame:
    """Adds ``minima``: the distinct least k-gram hashes of all windows, for
    each pair of k and window length. Each step is a column of its own: a column
    that a lambda reads must not be computed inside it."""
    out = rows.withColumn("_h", hash_words(words))
    for n, (k, _) in enumerate(lengths):
        out = out.withColumn(f"_g{n}", hash_grams("_h", k))
    for n, (k, window) in enumerate(lengths):
        out = out.withColumn(f"_m{n}", window_minima(f"_g{n}", window - k + 1))
    none = F.array().cast("array<long>")
    return out.withColumn(
        "minima", F.array_distinct(F.concat(*[F.coalesce(f"_m{n}", none) for n in range(len(lengths))]))
    ).select(*rows.columns, "minima")


def fingerprints(rows: DataFrame, words: str, k: int, window: int) -> DataFrame:
    """One row per selected k-gram of the array ``words``: its hash ``fp``, the
    place ``at`` of its first word, and ``around``: the words from ``left``
    places before it to the same reach behind it, which is all that an
    extension to ``window`` words can touch."""
    span, reach = window - k + 1, window - k
    kept = [c for c in rows.columns if c != words]
    hashed = rows.withColumn("_h", hash_words(words)).withColumn("_g", hash_grams("_h", k))
    picked = hashed.withColumn("_m", window_minima("_g", span))
    # a k-gram is selected if it is the least of a window that it lies in
    chosen = F.filter(
        at_each(F.size("_g"), lambda p: p),
        lambda p: F.array_contains(F.slice("_m", F.greatest(p - (span - 2), F.lit(1)), span), F.get("_g", p)),
    )

    def print_at(p: Column) -> Column:
        low = F.greatest(p - reach, F.lit(0))
        return F.struct(
            F.get("_g", p).alias("fp"),
            p.alias("at"),
            (p - low).alias("left"),
            F.slice(words, low + 1, p - low + k + reach).alias("around"),
        )

    # outer, as a filter on the array's size would compute the array a second time
    out = picked.select(*kept, F.explode_outer(F.transform(chosen, print_at)).alias("_p"))
    return out.where("_p.fp IS NOT NULL").select(*kept, "_p.*")


def matching(step: int, reach: int, start_a: Column, start_b: Column) -> Column:
    """How many words in a row are equal going ``step`` from the two places."""
    a, b = F.col("around"), F.col("b_around")

    def more(run: Column, j: Column) -> Column:
        at_a, at_b = start_a + step * j, start_b + step * j
        inside = (at_a >= 0) & (at_b >= 0) & (at_a < F.size(a)) & (at_b < F.size(b))
        same = inside & (F.get(a, at_a) == F.get(b, at_b))
        return F.when((run == j - 1) & same, j).otherwise(run)

    return F.aggregate(F.sequence(F.lit(1), F.lit(reach)), F.lit(0), more) if reach else F.lit(0)


def hits(train: DataFrame, test: DataFrame, k: int, window: int, max_broadcast: int) -> DataFrame:
    """Spans ``start``, ``end`` of words of ``train`` that occur in an item, with
    the items. Both sides have ``words``; ``test`` has ``item_id``."""
    reach = window - k
    probe = (
        fingerprints(test, "words", k, window)
        .groupBy("fp", F.col("left").alias("b_left"), F.col("around").alias("b_around"))
        .agg(F.collect_set("item_id").alias("items"))  # at most every item of the benchmark
    )
    if fits_broadcast(probe, max_broadcast):
        probe = F.broadcast(probe)
    found = fingerprints(train, "words", k, window).join(probe, "fp")
    left, b_left = F.col("left"), F.col("b_left")
    back = matching(-1, reach, left, b_left)
    ahead = matching(1, reach, left + (k - 1), b_left + (k - 1))
    same = F.slice("around", left + 1, F.lit(k)) == F.slice("b_around", b_left + 1, F.lit(k))
    return (
        found.where(same)
        .withColumn("_back", back)
        .withColumn("_ahead", ahead)
        .where(F.col("_back") + F.col("_ahead") + k >= window)
        .select(
            "_id",
            "_th",
            (F.col("at") - F.col("_back")).alias("start"),
            (F.col("at") + k + F.col("_ahead")).alias("end"),
            "items",
        )
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    k: int = 6,
    max_broadcast: int = 100_000,
    keyed: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words in
    an occurrence of a window of an item), ``n_items``, ``items_sha256`` and
    ``contaminated``.

    A window is ``window`` consecutive words of an item; a shorter item is one
    window, found through all its k-grams of that length. Fingerprints of the
    benchmark are broadcast if at most ``max_broadcast`` of 64 MB in all are
    measured; otherwise the join shuffles narrow rows. Of k-grams with the same
    least hash in a window all are kept. NULL and empty texts have no words; an
    empty benchmark hits nothing and an empty table gives no rows.
    Items that repeat an id are one item, items with a NULL id hit words but are
    not listed. Rows that repeat id and text get the same answer; columns other
    than ``doc_id``, ``text`` and ``item_id`` are not read. ``keyed`` adds ``_th``,
    the text's hash, which with the id tells whose answer a row is.
    """
    key = row_key("doc_id", "text")
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    sizes = items.select(F.least(F.size("words"), F.lit(window)).alias("n")).distinct()
    # at most ``window`` numbers: items below the window's length are windows of their own
    lengths = [(min(n, k) if n == window else n, n) for n in sorted(r["n"] for r in sizes.collect())] or [(k, window)]

    # which documents share a fingerprint at all, from one look at each text
    loose = benchmark.select(loose_words(F.col("text")).alias("words"))
    known = minima(loose, "words", lengths).select(F.explode_outer("minima").alias("fp")).distinct()
    known = known.where("fp IS NOT NULL").withColumn("known", F.lit(1))
    if fits_broadcast(known, max_broadcast):
        known = F.broadcast(known)
    looked = minima(docs.select(*key, loose_words(F.col("text")).alias("words")), "words", lengths)
    seen = looked.select("_id", "_th", F.size("words").cast("long").alias("n_words"), F.explode_outer("minima").alias("fp"))
    # partial sums see a text's rows together, so one row per text is shuffled
    counted = staged(
        seen.join(known, "fp", "left").groupBy("_id", "_th", "n_words").agg(F.max("known").alias("known")), "fingerprints"
    )

    # the words around the fingerprints, only of those documents
    near = counted.where("known = 1").select("_id", "_th")
    train = join_keyed(docs.select(*key, "text"), near, "left_semi")
    train = train.select("_id", "_th", words_of(F.col("text")).alias("words"))
    parts = [
        hits(train, items.where(F.size("words") >= n if n == window else F.size("words") == n), size, n, max_broadcast)
        for size, n in lengths
    ]
    spans = parts[0]
    for more in parts[1:]:
        spans = spans.unionByName(more)
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["reach"]))).alias("n"),
            F.greatest(s["reach"], x["end"]).alias("reach"),
        ),
        lambda s: s["n"].cast("long"),
    )
    per_doc = (
        spans.groupBy("_id", "_th")
        .agg(
            F.collect_set(F.struct("start", "end")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select("_id", "_th", covered.alias("hit"), "items")
    )
    # repeated rows were counted as one; each gets its answer back
    answers = join_keyed(counted.select("_id", "_th", "n_words"), per_doc)
    rows = join_keyed(docs.select(*key), answers)
    listed = F.coalesce(F.col("items"), F.array().cast("array<long>"))
    listed_text = F.array_join(F.array_sort(F.transform(listed, lambda i: i.cast("string"))), ",")
    n_hit = F.coalesce(F.col("hit"), F.lit(0).cast("long"))
    return rows.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(listed_text, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        *([F.col("_th")] if keyed else []),
    )
