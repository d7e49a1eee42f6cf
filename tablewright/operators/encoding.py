"""Categorical encoding with vocabularies learned in one pass.

All columns are counted together: each row yields one (column, label) pair per
column, map tasks add the pairs up, and only distinct labels are shuffled. The
vocabulary is a small table that can be saved and used again on later
snapshots, so slots do not move; :func:`extend_vocab` adds what is new.

Vectors come in three forms: ``dense`` arrays, one double per slot; ``sparse``
structs (size, indices, values) that are as wide as the row has labels, however
many the vocabulary has; and ``vector``, the sparse vectors of ``pyspark.ml``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions import expressions as X
from tablewright.functions.naming import quoted, text
from tablewright.operators.columns import columns_with_suffix
from tablewright.session import fits_broadcast, through_storage

# A column with up to this many labels is ranked in one window, one with more by
# a sort over all tasks. The slots are the same.
WINDOW_LABELS = 100_000

# A vocabulary up to this size goes into the plan as constants, a larger one is
# joined. The slots are the same; a join for each small column costs planning.
LITERAL_LABELS = 64

# A larger one goes to every task if it has so many labels and 64 MB at most;
# beyond that its rows are shuffled to the data's labels.
BROADCAST_LABELS = 1_000_000

# The most labels of a column that :func:`collect_vocab` brings to the driver.
COLLECT_LABELS = 1_000

DENSE, SPARSE, VECTOR = "dense", "sparse", "vector"


def label_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, n) for every non-NULL value of ``cols``."""
    names = ", ".join(map(text, cols))
    values = ", ".join(f"CAST({quoted(c)} AS STRING)" for c in cols)
    return (
        df.selectExpr(f"posexplode(array({values})) AS (pos, label)")
        .where("label IS NOT NULL")
        .groupBy("pos", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(f"element_at(array({names}), pos + 1) AS column", "label", "n")
    )


def fit_vocab(
    df: DataFrame,
    cols: Sequence[str],
    max_labels: int | None = None,
    *,
    window_labels: int = WINDOW_LABELS,
) -> DataFrame:
    """(column, label, slot): slots by falling count, ties by label, for any
    number of labels. The counts, one row per distinct label, are stored, so
    that the data is read once. A caller who wants no column above a number of
    labels gives ``max_labels``; the job then fails."""
    counts = through_storage(label_counts(df, cols), "label-counts")
    # One row per column.
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
    if max_labels is not None:
        wide = sorted(c for c, n in sizes.items() if n > max_labels)
        if wide:
            raise ValueError(f"more than {max_labels} labels in {wide}")
    if any(n > window_labels for n in sizes.values()):
        return _rank_all(counts)
    by_count = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("label"))
    slot = (F.row_number().over(by_count) - 1).cast("long")
    return counts.select("column", "label", slot.alias("slot"))


def _rank_all(counts: DataFrame) -> DataFrame:
    """Rank labels per column without putting a column into one task: sort
    over all tasks, number the rows within each, and add the number of rows
    that lie before. The sorted table is stored, since a second sort could
    cut the tasks elsewhere."""
    ordered = counts.orderBy("column", F.desc("n"), "label").select(
        "column", "label", F.monotonically_increasing_id().alias("id")
    )
    numbered = through_storage(ordered, "labels").withColumn("task", F.shiftright("id", 33))
    # One row per task and column in it: bounded by the number of partitions.
    runs = numbered.groupBy("column", "task").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("start")
    )
    before = Window.partitionBy("column").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = runs.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return numbered.join(runs, ["column", "task"]).select(
        "column",
        "label",
        (F.col("id") - F.col("start") + F.col("offset")).cast("long").alias("slot"),
    )


def extend_vocab(
    vocab: DataFrame,
    df: DataFrame,
    cols: Sequence[str],
    *,
    window_labels: int = WINDOW_LABELS,
) -> DataFrame:
    """The vocabulary with the labels of ``df`` that it lacks: known labels keep
    their slot, whether ``df`` still has them or not, and new ones follow the
    last slot of their column, by falling count, ties by label. So what was
    encoded before stays valid, up to the slot for unseen values, which is
    always the one after the last. Write it to a new path: the old is being read."""
    known = vocab.where(F.col("column").isin(list(cols))).select("column", "label", "slot")
    fresh = through_storage(
        label_counts(df, cols).join(known, ["column", "label"], "left_anti"), "new-labels"
    )
    sizes = {r["column"]: r["count"] for r in fresh.groupBy("column").count().collect()}
    if not sizes:
        return known
    if any(n > window_labels for n in sizes.values()):
        ranked = _rank_all(fresh)
    else:
        by_count = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("label"))
        ranked = fresh.select(
            "column", "label", (F.row_number().over(by_count) - 1).cast("long").alias("slot")
        )
    # One row per column.
    ends = known.groupBy("column").agg((F.max("slot") + 1).alias("end"))
    added = ranked.join(F.broadcast(ends), "column", "left").select(
        "column", "label", (F.col("slot") + F.coalesce("end", F.lit(0))).cast("long").alias("slot")
    )
    return known.unionAll(added)


def vocab_changes(vocab: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, status, n) against a vocabulary: ``kept``, ``new`` and
    ``retired`` labels, with their number of rows in ``df``."""
    known = vocab.where(F.col("column").isin(list(cols))).select("column", "label", "slot")
    both = known.join(label_counts(df, cols), ["column", "label"], "full")
    status = F.when(F.col("slot").isNull(), "new").when(F.col("n").isNull(), "retired").otherwise("kept")
    return both.select("column", "label", status.alias("status"), F.coalesce("n", F.lit(0)).alias("n"))


Vocabulary = DataFrame | Mapping[str, Sequence[str]]


def _labels(vocab: Vocabulary, cols: Sequence[str], max_labels: int) -> dict[str, list[str]]:
    """Labels per column in slot order, one more than the bound at most."""
    if isinstance(vocab, Mapping):
        return {c: list(vocab[c]) for c in cols}
    labels: dict[str, list[str]] = {c: [] for c in cols}
    wanted = vocab.where(
        F.col("column").isin(list(cols)) & (F.col("slot") <= max_labels)
    ).select("column", "label", "slot")
    for row in sorted(wanted.collect(), key=lambda r: r["slot"]):
        labels[row["column"]].append(row["label"])
    return labels


def collect_vocab(
    vocab: Vocabulary, cols: Sequence[str], max_labels: int = COLLECT_LABELS
) -> dict[str, list[str]]:
    """Labels per column in slot order, brought to the driver within the
    bound ``len(cols) * max_labels``; a column over it fails. The encoders take
    the vocabulary as a table of any size and need no such bound."""
    labels = _labels(vocab, cols, max_labels)
    wide = [c for c, found in labels.items() if len(found) > max_labels]
    if wide:
        raise ValueError(f"more than {max_labels} labels in {wide}")
    return labels


def _slotted(
    df: DataFrame,
    vocab: Vocabulary,
    cols: Sequence[str],
    literal_labels: int,
    broadcast_labels: int,
) -> tuple[DataFrame, dict[str, str], dict[str, int]]:
    """``df`` with helper columns, and for each of ``cols`` the SQL of its slot
    and its number of labels. A large vocabulary is joined by label."""
    labels = _labels(vocab, cols, literal_labels)
    sizes = {c: len(found) for c, found in labels.items()}
    slots = {c: X.slot_of(quoted(c), labels[c]) for c in cols if sizes[c] <= literal_labels}
    large = [c for c in cols if c not in slots]
    if not large:
        return df, slots, sizes
    if isinstance(vocab, Mapping):
        rows = [(c, label, slot) for c in large for slot, label in enumerate(labels[c])]
        known = df.sparkSession.createDataFrame(rows, "column string, label string, slot long")
    else:
        known = vocab.where(F.col("column").isin(large)).select("column", "label", "slot")
        sizes |= {r["column"]: r["count"] for r in known.groupBy("column").count().collect()}
    if fits_broadcast(known, broadcast_labels):
        df = _looked_up(df, F.broadcast(known), large)
    elif len(large) == 1:
        df = _looked_up(df, known, large)
    else:
        df = _looked_up_in_pairs(df, known, large)
    slots |= {c: f"coalesce(__slot{i}, {sizes[c]}L)" for i, c in enumerate(large)}
    return df, slots, sizes


def _looked_up(df: DataFrame, known: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add the slot of each column by a join. The vocabulary has one row per
    label, so skew is on the data side only, where adaptive execution splits it."""
    for i, c in enumerate(cols):
        mine = known.where(F.col("column") == c).select(
            F.col("label").alias(f"__label{i}"), F.col("slot").alias(f"__slot{i}")
        )
        same = F.col(quoted(c)).cast("string") == F.col(f"__label{i}")
        df = df.join(mine, same, "left").drop(f"__label{i}")
    return df


def _looked_up_in_pairs(df: DataFrame, known: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add the slots of several columns with large vocabularies: the wide rows
    are stored with a number and shuffled once, by that number. What meets the
    vocabulary is only (number, column, label), for all columns in one join."""
    rows = through_storage(
        df.withColumn("__row", F.monotonically_increasing_id()), "rows-to-encode"
    )
    values = ", ".join(f"CAST({quoted(c)} AS STRING)" for c in cols)
    names = ", ".join(map(text, cols))
    pairs = rows.selectExpr("__row", f"posexplode(array({values})) AS (__at, label)").selectExpr(
        "__row", "__at", f"element_at(array({names}), __at + 1) AS column", "label"
    )
    found = pairs.where("label IS NOT NULL").join(known, ["column", "label"])
    slots = found.groupBy("__row").agg(
        *[F.max(F.when(F.col("__at") == i, F.col("slot"))).alias(f"__slot{i}") for i in range(len(cols))]
    )
    return rows.join(slots, "__row", "left").drop("__row")


def string_index(
    df: DataFrame,
    vocab: Vocabulary,
    cols: Sequence[str],
    suffix: str = "_idx",
    *,
    literal_labels: int = LITERAL_LABELS,
    broadcast_labels: int = BROADCAST_LABELS,
) -> DataFrame:
    """Add the label index of each column as double; NULL and unseen values
    get the extra last index. Any number of labels."""
    joined, slots, _ = _slotted(df, vocab, cols, literal_labels, broadcast_labels)
    added = {c + suffix: F.expr(f"CAST({slots[c]} AS DOUBLE)") for c in cols}
    names = [*[c for c in df.columns if c not in added], *added]
    return joined.withColumns(added).select(*map(quoted, names))


def _vectors(df: DataFrame, slots: Mapping[str, tuple[str, int]], form: str) -> DataFrame:
    """Add a vector column for each name, of the SQL of its slot and its size."""
    if form == VECTOR:
        return _ml_vectors(df, slots)
    if form not in (DENSE, SPARSE):
        raise ValueError(f"form must be {DENSE!r}, {SPARSE!r} or {VECTOR!r}, not {form!r}")
    one = X.one_hot_array if form == DENSE else X.one_hot_sparse
    return df.withColumns({name: F.expr(one(slot, size)) for name, (slot, size) in slots.items()})


def _ml_vectors(df: DataFrame, slots: Mapping[str, tuple[str, int]]) -> DataFrame:
    """The same by the one-hot stage of ``pyspark.ml``. It learns the sizes from
    a range of numbers, so the data is not read for them."""
    from pyspark.ml.feature import OneHotEncoder

    at = {name: f"__at{i}" for i, name in enumerate(slots)}
    sizes = df.sparkSession.range(max(size for _, size in slots.values())).selectExpr(
        *[f"CAST(least(id, {size - 1}) AS DOUBLE) AS {at[name]}" for name, (_, size) in slots.items()]
    )
    stage = OneHotEncoder(
        inputCols=list(at.values()), outputCols=list(at), dropLast=False, handleInvalid="error"
    )
    placed = df.drop(*[c for c in df.columns if c in at]).withColumns(
        {at[name]: F.expr(f"CAST({slot} AS DOUBLE)") for name, (slot, _) in slots.items()}
    )
    return stage.fit(sizes).transform(placed).drop(*at.values())


def one_hot(
    df: DataFrame, sizes: Mapping[str, int], suffix: str = "_vec", *, form: str = DENSE
) -> DataFrame:
    """Turn index columns into vectors of the given sizes; a column named
    ``x_idx`` gives ``x_vec``."""
    names = {c: c.removesuffix("_idx") + suffix for c in sizes}
    return _vectors(df, {names[c]: (quoted(c), size) for c, size in sizes.items()}, form)


def encode_many(
    df: DataFrame,
    vocab: Vocabulary,
    cols: Sequence[str],
    suffix: str = "_vec",
    keep_raw: bool = False,
    *,
    form: str = DENSE,
    literal_labels: int = LITERAL_LABELS,
    broadcast_labels: int = BROADCAST_LABELS,
) -> DataFrame:
    """One-hot encode ``cols``: k labels give k + 1 slots, for any k. One
    projection; vocabularies above ``literal_labels`` are joined, from every
    task's own copy up to ``broadcast_labels`` in all, else by a shuffle, which
    moves the table once however many columns there are. Dense vectors hold
    k + 1 doubles a row, so wide columns want another ``form``."""
    joined, slots, sizes = _slotted(df, vocab, cols, literal_labels, broadcast_labels)
    added = {c + suffix: (slots[c], sizes[c] + 1) for c in cols}
    kept = [c for c in df.columns if c not in added and (keep_raw or c not in cols)]
    return _vectors(joined, added, form).select(*map(quoted, [*kept, *added]))


def sparse_to_dense(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Sparse structs (by default the columns ending ``_vec``) as dense arrays."""
    names = columns_with_suffix(df) if cols is None else list(cols)
    return df.withColumns({c: F.expr(X.dense_of(quoted(c))) for c in names})


def vector_to_array(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """ML vector columns (by default those ending ``_vec``) as dense arrays."""
    from pyspark.ml.functions import vector_to_array as dense

    names = columns_with_suffix(df) if cols is None else list(cols)
    return df.withColumns({c: dense(F.col(quoted(c))) for c in names})


def encode_many_ml(
    df: DataFrame, cols: Sequence[str], suffix: str = "_vec", keep_raw: bool = False
) -> DataFrame:
    """The same encoding by ``pyspark.ml``, one fitted stage per column. It is
    the cross-check for :func:`encode_many`, which needs a single pass."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    index = [f"{c}__idx" for c in cols]
    vectors = [c + suffix for c in cols]
    stages = [
        StringIndexer(inputCols=list(cols), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=vectors, dropLast=False),
    ]
    out = vector_to_array(Pipeline(stages=stages).fit(df).transform(df), vectors).drop(*index)
    return out if keep_raw else out.drop(*cols)
