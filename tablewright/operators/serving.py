"""Serving: latest row per key, incremental refresh, lookup and as-of join.

Latest-per-key is an aggregate (greatest row per key), so map tasks reduce
their rows before anything is shuffled and a key with a third of the history
is no larger on the wire than any other. The as-of join is one shuffle by key
and a running ``last``; the time lines of keys with more rows than a
task should take are cut into slices (see :class:`Skew`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.naming import quoted
from tablewright.operators.columns import moment
from tablewright.operators.dedup import orderable, pick_row
from tablewright.operators.views import FeatureView
from tablewright.session import fits_broadcast, through_storage


def latest_per_key(
    df: DataFrame, keys: Sequence[str], timestamps: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """The row with the greatest timestamps per key; ties go to the greatest
    payload, so the result does not depend on task order."""
    names = list(dict.fromkeys([*timestamps, *payload]))
    picked = df.groupBy(*map(quoted, keys)).agg(
        pick_row(df, timestamps, names, greatest=True).alias("__row")
    )
    order = [*payload, *[t for t in timestamps if t not in payload]]
    return picked.select(*map(quoted, keys), *[F.col(f"__row.{quoted(c)}") for c in order])


def _dated(
    df: DataFrame,
    view: FeatureView,
    since: str | datetime | None,
    until: str | datetime | None,
) -> DataFrame:
    """View columns of rows with a key and ``since < event <= until``. The
    bounds are constants of the column's type and reach the scan; if the table is
    stored by day, so do their days, and other days are not opened."""
    event, day = view.source.event_timestamp, view.source.date_partition
    col, dtype = F.col(quoted(event)), df.schema[event].dataType
    rows = df
    if day in df.columns:
        for bound, within in ((since, F.col(quoted(day)).__ge__), (until, F.col(quoted(day)).__le__)):
            if bound is not None:
                rows = rows.where(within(moment(bound, dtype).cast("date")))
    rows = rows.select(*map(quoted, view.columns)).where(col.isNotNull())
    for key in view.keys:
        rows = rows.where(F.col(quoted(key)).isNotNull())
    if since is not None:
        rows = rows.where(col > moment(since, dtype))
    if until is not None:
        rows = rows.where(col <= moment(until, dtype))
    return rows


def materialize_latest(
    df: DataFrame,
    view: FeatureView,
    until: str | datetime | None = None,
    since: str | datetime | None = None,
) -> DataFrame:
    """Snapshot: per key the latest row up to ``until``."""
    return latest_per_key(
        _dated(df, view, since, until), view.keys, view.timestamps, view.features
    )


def merge_snapshot(
    snapshot: DataFrame, newest: DataFrame, view: FeatureView, max_broadcast_keys: int = 500_000
) -> DataFrame:
    """Two tables of one row per key, latest of both. ``newest`` is read more
    than once, so it should be stored.

    If its keys are measured and few, only their snapshot rows are shuffled;
    the others pass straight through. Otherwise the whole snapshot is merged
    by key.
    """
    columns = list(map(quoted, view.columns))
    old, new = snapshot.select(*columns), newest.select(*columns)
    touched, kept = new.select(*map(quoted, view.keys)), None
    if fits_broadcast(touched, max_broadcast_keys):
        small = F.broadcast(touched)
        kept = old.join(small, view.keys, "left_anti").select(*columns)
        old = old.join(small, view.keys, "left_semi").select(*columns)
    merged = latest_per_key(old.unionByName(new), view.keys, view.timestamps, view.features)
    return merged if kept is None else merged.unionByName(kept)


def materialize_incremental(
    snapshot: DataFrame,
    df: DataFrame,
    view: FeatureView,
    since: str | datetime,
    until: str | datetime,
    max_broadcast_keys: int = 500_000,
) -> DataFrame:
    """The snapshot brought from ``since`` to ``until`` by reading only the
    rows in between, once. Write it to a new path: the old one is being read.
    A row that arrives later with an event time before ``since`` is not seen;
    a full :func:`materialize_latest` or the streaming form repairs that."""
    newest = through_storage(materialize_latest(df, view, until, since), "newest")
    return merge_snapshot(snapshot, newest, view, max_broadcast_keys)


def online_lookup(
    keys: DataFrame,
    snapshot: DataFrame,
    view: FeatureView,
    max_broadcast_keys: int = 100_000,
    *,
    as_of: str | datetime | None = None,
    event_as: str | None = None,
) -> DataFrame:
    """The features of the given keys; every row of ``keys`` stays, unknown
    keys get NULL. With ``as_of`` and a view that has a ``ttl``, so do keys
    whose event time is more than the ``ttl`` before ``as_of``. ``event_as``
    names a column for the event time of the features served.

    If the distinct keys are measured and few, they are broadcast to cut the
    snapshot down where it is read, and only its hits are joined. Otherwise
    the join is a plain shuffle, whose skew on the ``keys`` side adaptive
    execution splits (the snapshot has one row per key).
    """
    names = view.keys
    asked = keys.select(*map(quoted, names)).distinct()
    if fits_broadcast(asked, max_broadcast_keys):
        snapshot = snapshot.join(F.broadcast(asked), names, "left_semi")
    event = view.source.event_timestamp
    if as_of is not None and view.ttl is not None:
        oldest = moment(as_of, snapshot.schema[event].dataType) - F.lit(view.ttl)
        snapshot = snapshot.where(F.col(quoted(event)) >= oldest)
    served = [F.col(quoted(event)).alias(event_as)] if event_as else []
    hits = snapshot.select(*map(quoted, [*names, *view.features]), *served)
    return keys.join(hits, names, "left")


@dataclass(frozen=True)
class Skew:
    """How finely long time lines are cut. None of it changes a result.

    A key with more than ``min_rows`` rows is hot. Its time line is cut into
    slices of about ``slice_rows`` rows at the places that a sample of
    ``oversample`` rows a slice gives, however many slices that takes. An
    instant that fills a slice or more becomes a slice of its own.
    """

    min_rows: int = 5_000_000
    slice_rows: int = 1_000_000
    oversample: int = 32


# Columns of the merged time line; the features of the i-th view are in ``__f<i>``.
T_, SIDE, SLICE = "__t", "__side", "__slice"
# Columns that place a row in the slices of its key.
HASH, CUT, CUTS, BLOCK, WIDTH, STARTS, INSIDE = (
    "__h", "__cut", "__cuts", "__block", "__width", "__starts", "__inside"
)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*map(quoted, keys))


# A hot key has so many rows in the sample that finds its like.
SAMPLED = 64


def hot_keys(frames: Sequence[DataFrame], keys: Sequence[str], skew: Skew) -> DataFrame:
    """The hash of each key with more than ``min_rows`` rows, as a stored table
    of at most one row per ``min_rows`` rows.

    A sample in which such a key has 64 rows on average names the candidates,
    those with 16 or more; only their rows are counted exactly, in the map tasks
    first. So what is shuffled is a small sample of the hashes, and nothing more
    if no key is hot. A key that the sample missed, one of some 10**12, would be
    joined like any other."""
    hashes = frames[0].select(_key_hash(keys).alias(HASH))
    for frame in frames[1:]:
        hashes = hashes.unionAll(frame.select(_key_hash(keys).alias(HASH)))
    rows = F.count(F.lit(1)).alias("__n")
    rate = SAMPLED / max(skew.min_rows, 1)
    if rate < 1:
        drawn = hashes.where(F.rand(5) < rate).groupBy(HASH).agg(rows)
        # of 16 sampled rows each, so four hashes for every ``min_rows`` rows at most
        likely = drawn.where(F.col("__n") >= SAMPLED // 4).select(HASH)
        hashes = hashes.join(F.broadcast(likely), HASH, "left_semi")
    counts = hashes.groupBy(HASH).agg(rows)
    return through_storage(counts.where(F.col("__n") > skew.min_rows).select(HASH), "hot-keys")


def point_in_time_join(
    spine: DataFrame,
    features: DataFrame,
    view: FeatureView,
    ts: str,
    *,
    event_as: str | None = None,
    skew: Skew | None = Skew(),
) -> DataFrame:
    """For each spine row the latest feature row of its key with
    ``ts - ttl <= event <= ts``; ties on the event time go to the later
    created time, then to the greater features. Every spine row stays; without
    a match its features are NULL. ``event_as`` names a column for the event
    time of the match.

    Both sides are united, shuffled once by key, and each spine row takes the
    running ``last`` feature. Hot keys (see :class:`Skew`) are shuffled by key
    and time slice instead, with the last feature before each slice added to
    it; how that is done never changes the result.
    """
    names = {view.name: event_as} if event_as else {}
    return point_in_time_joins(spine, [(features, view)], ts, event_as=names, skew=skew)


def point_in_time_joins(
    spine: DataFrame,
    sources: Sequence[tuple[DataFrame, FeatureView]],
    ts: str,
    *,
    event_as: Mapping[str, str] | None = None,
    skew: Skew | None = Skew(),
) -> DataFrame:
    """The features of several views as of each spine row's time: what a chain of
    :func:`point_in_time_join` gives, with each view's own ``ttl``. Views with the
    same keys are merged with the spine into one time line, shuffled and sorted
    once, along which the last feature of every view runs; only another set of
    keys takes another shuffle. ``event_as`` names a column for the event time of
    the match, by name of the view."""
    event_as = event_as or {}
    added = [c for _, v in sources for c in [*v.features, *filter(None, [event_as.get(v.name)])]]
    taken = {c.lower() for c in spine.columns}
    clash = [c for c in added if c.lower() in taken]
    if clash:
        raise ValueError(f"spine already has columns {clash}")
    twice = sorted({c for c in added if [a.lower() for a in added].count(c.lower()) > 1})
    if twice:
        raise ValueError(f"more than one view has columns {twice}")
    by_keys: dict[tuple[str, ...], list[tuple[DataFrame, FeatureView]]] = {}
    for features, view in sources:
        by_keys.setdefault(tuple(view.keys), []).append((features, view))
    names, out = spine.columns, spine
    for number, (keys, group) in enumerate(by_keys.items()):
        nullable = [c for c in [*keys, ts] if spine.schema[c].nullable]
        if number and nullable:
            # rows without key are set apart, so the next merge reads its spine twice
            out = through_storage(out, "joined-views")
        out = _merged(out, group, ts, event_as, skew, nullable)
    return out.select(*map(quoted, [*names, *added]))


def _merged(
    spine: DataFrame,
    sources: Sequence[tuple[DataFrame, FeatureView]],
    ts: str,
    event_as: Mapping[str, str],
    skew: Skew | None,
    nullable: Sequence[str],
) -> DataFrame:
    """The spine with the features of views that share their keys; ``nullable``
    are those of its keys and time that may be NULL."""
    keys = sources[0][1].keys
    columns = {f"__f{i}": view for i, (_, view) in enumerate(sources)}
    dated = []
    for (features, view), column in zip(sources, columns):
        event, created = view.source.event_timestamp, view.source.created_timestamp
        parts = [event, *([created] if created else []), *view.features]
        dated.append(
            _dated(features, view, None, None).select(
                *map(quoted, keys),
                F.col(quoted(event)).alias(T_),
                F.struct(*map(quoted, parts)).alias(column),
            )
        )
    # Keys and time travel once; the other spine columns go along as they are,
    # so those that nobody reads are pruned at the scan.
    others = [c for c in spine.columns if c not in keys and c != ts]
    absent = F.lit(False)
    for c in nullable:
        absent = absent | F.col(quoted(c)).isNull()
    asks = spine.where(~absent).select(
        *map(quoted, keys), F.col(quoted(ts)).alias(T_), *map(quoted, others)
    )
    *dated, asks = _same_types([*dated, asks], [*keys, T_])
    facts = dated[0]
    for one in dated[1:]:
        facts = facts.unionByName(one, allowMissingColumns=True)

    hot = hot_keys([facts, asks], keys, skew) if skew else None
    if hot is not None and not hot.isEmpty():
        answered = _as_of_sliced(facts, asks, keys, others, list(columns), hot, skew)
    else:
        answered = _as_of(facts, asks, keys, others, list(columns))

    own = {
        **{c: F.col(quoted(c)).cast(spine.schema[c].dataType) for c in keys},
        ts: F.col(T_).cast(spine.schema[ts].dataType),
    }
    picked, added = [], []
    for column, view in columns.items():
        matched_at = F.col(f"{column}.{quoted(view.source.event_timestamp)}")
        fresh = matched_at.isNotNull()
        if view.ttl is not None:
            fresh = matched_at >= F.col(T_) - F.lit(view.ttl)
        picked += [F.when(fresh, F.col(f"{column}.{quoted(c)}")).alias(c) for c in view.features]
        added += view.features
        if event_as.get(view.name):
            picked.append(F.when(fresh, matched_at).alias(event_as[view.name]))
            added.append(event_as[view.name])
    matched = answered.select(
        *[own.get(c, F.col(quoted(c))).alias(c) for c in spine.columns], *picked
    )
    if not nullable:
        return matched

    # Rows without key or time match nothing; they never enter the shuffle.
    types = {c: matched.schema[c].dataType for c in added}
    rest = spine.where(absent).select(
        *map(quoted, spine.columns), *[F.lit(None).cast(types[c]).alias(c) for c in added]
    )
    return matched.unionAll(rest)


def _same_types(frames: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """All frames with the shared columns in their common type, so that equal
    values also hash alike."""
    shared = list(map(quoted, cols))
    wide = frames[0].select(*shared)
    for frame in frames[1:]:
        wide = wide.unionAll(frame.select(*shared))
    casts = {c: F.col(quoted(c)).cast(wide.schema[c].dataType) for c in cols}
    return [frame.withColumns(casts) for frame in frames]


def _rank(df: DataFrame, column: str) -> Column:
    """What decides between features of one time: the struct itself, or, if a
    type in it has no order, the hash of its text."""
    if orderable(df.schema[column].dataType):
        return F.col(column)
    return F.xxhash64(F.to_json(F.struct(column)))


def _running_last(timeline: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Give every spine entry the last feature of each view at or before it.
    Features sort before spine entries of the same time, and among each other
    by struct."""
    ties = [_rank(timeline, c) for c in columns]
    order = Window.partitionBy(*map(quoted, groups)).orderBy(T_, SIDE, *ties)
    seen = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lasts = {c: F.last(c, ignorenulls=True).over(seen) for c in columns}
    return timeline.withColumns(lasts).where(F.col(SIDE) == 1)


def _as_of(
    facts: DataFrame,
    asks: DataFrame,
    groups: Sequence[str],
    others: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Spine rows with the feature structs, by one shuffle on ``groups``."""
    types = {c: asks.schema[c].dataType for c in others}
    left = facts.withColumns(
        {SIDE: F.lit(0), **{c: F.lit(None).cast(types[c]) for c in others}}
    )
    right = asks.withColumns(
        {SIDE: F.lit(1), **{c: F.lit(None).cast(facts.schema[c].dataType) for c in columns}}
    )
    return _running_last(left.unionByName(right), groups, columns).drop(SIDE)


def _as_of_sliced(
    facts: DataFrame,
    asks: DataFrame,
    keys: Sequence[str],
    others: Sequence[str],
    columns: Sequence[str],
    hot: DataFrame,
    skew: Skew,
) -> DataFrame:
    """The same, with hot keys in groups of bounded size.

    Each hot time line is cut at quantiles of its own times, and every cut
    point is a slice of its own. The last features of each slice, an aggregate
    reduced on the map side, give the state of a key after each slice: at most
    one row per hot key and slice. The state before a slice joins the rows of
    that slice as one more row of features, ahead of all times. Rows at a hot
    instant, of which there may be any number, skip the shuffle: features there
    are in the state already, and spine rows take the state after their instant
    by a plain join.
    """
    ks = list(map(quoted, keys))
    facts = facts.withColumn(HASH, _key_hash(keys))
    asks = asks.withColumn(HASH, _key_hash(keys))
    times = facts.select(HASH, T_).unionAll(asks.select(HASH, T_))
    cuts = through_storage(cut_points(times.join(hot, HASH, "left_semi"), skew), "cut-points")
    facts, asks = in_slices(facts, cuts), in_slices(asks, cuts)

    lasts = facts.where(F.col(CUTS).isNotNull()).groupBy(*ks, CUTS, SLICE)
    lasts = lasts.agg(*[_greatest(facts, c).alias(c) for c in columns])
    in_order = Window.partitionBy(*ks).orderBy(SLICE)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lasts = lasts.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})
    # 2 CUTS is the slice after the last cut point
    upto = F.coalesce(F.lead(SLICE).over(in_order) - 1, 2 * F.col(CUTS))
    filled = lasts.withColumn("__upto", upto).select(
        *ks, F.explode(F.sequence(F.col(SLICE), F.col("__upto"))).alias(SLICE), *columns
    )
    state = through_storage(filled, "hot-states")
    first = F.lit(None).cast(facts.schema[T_].dataType)  # sorts before all times
    carried = state.select(*ks, first.alias(T_), *columns, (F.col(SLICE) + 1).alias(SLICE))

    pins = cuts.where("__pinned").select(HASH, (2 * F.col(CUT) - 1).alias(SLICE))
    pinned, rest = None, asks
    if not pins.isEmpty():
        facts = facts.join(pins, [HASH, SLICE], "left_anti")
        pinned = asks.join(pins, [HASH, SLICE], "left_semi")
        rest = asks.join(pins, [HASH, SLICE], "left_anti")
    asked = [*ks, T_, *map(quoted, others), SLICE]
    answered = _as_of(
        facts.select(*ks, T_, *columns, SLICE).unionByName(carried),
        rest.select(*asked),
        [*keys, SLICE],
        others,
        columns,
    ).drop(SLICE)
    if pinned is None:
        return answered
    there = pinned.select(*asked).join(state, [*keys, SLICE], "left")
    return answered.unionByName(there.drop(SLICE))


def _greatest(facts: DataFrame, column: str) -> Column:
    """The latest feature struct of a group, by the order of ``_running_last``."""
    if orderable(facts.schema[column].dataType):
        return F.max(column)
    place = F.struct(F.col(T_), _rank(facts, column))
    return F.max_by(column, F.when(F.col(column).isNotNull(), place))


def cut_points(times: DataFrame, skew: Skew) -> DataFrame:
    """One row per cut point of each hot key: its time, its number from 1 up,
    the number of cut points of the key, and whether its instant alone fills a
    slice. A window sees a sample only, ``oversample`` rows of a key a slice."""
    step = min(skew.oversample, skew.slice_rows)
    by_time = Window.partitionBy(HASH).orderBy(T_)
    sample = times.where(F.rand(17) < step / skew.slice_rows)
    every = sample.withColumn("__r", F.row_number().over(by_time)).where(F.col("__r") % step == 0)
    cuts = every.groupBy(HASH, T_).agg((F.count(F.lit(1)) > 1).alias("__pinned"))
    width = F.ceil(F.sqrt(CUTS)).cast("long")
    return (
        cuts.withColumn(CUT, F.row_number().over(by_time).cast("long"))
        .withColumn(CUTS, F.count(F.lit(1)).over(Window.partitionBy(HASH)))
        .withColumn(WIDTH, width)
        .withColumn(BLOCK, F.expr(f"({CUT} - 1) div {WIDTH}"))
    )


def in_slices(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add the slice of each row: 2 i between the i-th cut point of its key and
    the next, 2 i - 1 at the i-th itself, 0 for keys without cut points. They
    are searched in two levels, so that a row only ever carries about the root
    of their number; both tables hold one time per slice and are joined by hash."""
    inside = F.array_sort(F.collect_list(T_))
    widest = cuts.agg(F.max(WIDTH)).first()[0] or 1  # no list of either level is longer
    starts = cuts.where(f"({CUT} - 1) % {WIDTH} = 0").groupBy(HASH, CUTS, WIDTH)
    df = df.join(starts.agg(inside.alias(STARTS)), HASH, "left")
    df = df.withColumn(BLOCK, (_passed(STARTS, widest) - 1).cast("long"))
    df = df.join(cuts.groupBy(HASH, BLOCK).agg(inside.alias(INSIDE)), [HASH, BLOCK], "left")
    df = df.withColumn(CUT, _passed(INSIDE, widest))
    at_it = F.coalesce(F.get(INSIDE, F.col(CUT) - 1) == F.col(T_), F.lit(False)).cast("long")
    before = F.greatest(F.col(BLOCK), F.lit(0)) * F.col(WIDTH) + F.col(CUT)
    slice_ = F.coalesce(2 * before - at_it, F.lit(0)).cast("long")
    return df.withColumn(SLICE, slice_).drop(BLOCK, WIDTH, STARTS, INSIDE, CUT)


def _passed(cuts: str, longest: int) -> Column:
    """How many of the sorted ``cuts`` are at or before the row's time, by bisection."""

    def move(at: Column, step: Column) -> Column:
        ahead = at + step
        fits = (ahead <= F.size(cuts)) & (F.get(cuts, ahead - 1) <= F.col(T_))
        return F.when(fits, ahead).otherwise(at)

    steps = F.array(*[F.lit(1 << i) for i in reversed(range(longest.bit_length()))])
    return F.aggregate(steps, F.lit(0), move)
