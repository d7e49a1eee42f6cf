"""Serving from a bucketed store: refresh what changed, look up few keys."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.naming import quoted
from tablewright.operators.columns import moment
from tablewright.operators.serving import _dated, latest_per_key, materialize_latest, online_lookup
from tablewright.operators.views import FeatureView
from tablewright.session import fits_broadcast, through_storage
from tablewright.sources.buckets import BucketStore, Version
from tablewright.sources.tables import instant


def store_of(root: str, view: FeatureView, buckets: int = 64) -> BucketStore:
    return BucketStore(root, tuple(view.keys), tuple(e.dtype for e in view.entities), buckets)


def _due(df: DataFrame, view: FeatureView, last: Version, lag: timedelta) -> Column:
    """Rows that the last version has not seen: their event time was not due yet,
    or they were created after the newest row read then."""
    event, created = view.source.event_timestamp, view.source.created_timestamp
    due = F.col(quoted(event)) > moment(last.until, df.schema[event].dataType)
    if created is None or last.seen is None:
        return due
    seen = moment(last.seen, df.schema[created].dataType) - F.lit(lag)
    return due | (F.col(quoted(created)) > seen)


def refresh_buckets(
    store: BucketStore,
    df: DataFrame,
    view: FeatureView,
    until: str | datetime,
    *,
    lag: timedelta = timedelta(0),
    version: str | None = None,
) -> Version:
    """Bring the store to ``until`` and publish it.

    Only rows that are new are read: by event time since the last version, and
    by created time, so a row that came late, with an event time long past, is
    served too. Only buckets that such a row falls into are read and written
    again; the others stay as they are, under the same path. ``lag`` reads rows
    again that were created up to so long before the newest one seen, for
    sources whose rows do not arrive in the order of their created time; that
    changes no result. Rows whose created time is NULL go by event time alone.
    A time before that of the last version is an error: nothing can be unserved.
    """
    spark, last = df.sparkSession, store.current(df.sparkSession)
    if last is not None and instant(until) < last.until:
        raise ValueError(f"version {last.name} is served until {last.until}, after {instant(until)}")
    rows = _dated(df, view, None, until)
    if last is not None:
        rows = rows.where(_due(rows, view, last, lag))
    created, observed = view.source.created_timestamp, Observation()
    if created is not None:
        # A greatest value stays right if a task runs twice.
        rows = rows.observe(observed, F.max(quoted(created)).cast("string").alias("seen"))
    newest = through_storage(materialize_latest(rows, view), "newest")
    found = observed.get["seen"] if created is not None else None
    name = version or uuid.uuid4().hex
    if last is None:
        return store.publish(spark, name, until, found, newest.schema, store.write(newest, name))
    # At most one number per bucket.
    touched = [r[0] for r in newest.select(store.bucket().alias("b")).distinct().collect()]
    paths = dict(last.paths)
    if touched:
        columns = list(map(quoted, view.columns))
        old = store.read(spark, last, touched).select(*columns)
        merged = latest_per_key(
            old.unionByName(newest.select(*columns)), view.keys, view.timestamps, view.features
        )
        paths |= store.write(merged, name)
    seen = max((s for s in (found, last.seen) if s is not None), default=None)
    return store.publish(spark, name, until, seen, last.schema, paths)


def lookup_buckets(
    keys: DataFrame,
    store: BucketStore,
    view: FeatureView,
    *,
    max_broadcast_keys: int = 100_000,
    max_literal_keys: int = 200,
    as_of: str | datetime | None = None,
    event_as: str | None = None,
) -> DataFrame:
    """The features of the given keys, as :func:`.serving.online_lookup` serves
    them, reading only the buckets that the keys fall into if these are measured
    and few. Up to ``max_literal_keys`` go into the scan as constants, where the
    order of the rows and the Bloom filters rule out row groups."""
    spark = keys.sparkSession
    version = store.current(spark)
    if version is None:
        raise ValueError(f"nothing is published at {store.root}")
    asked = keys.select(*map(quoted, view.keys)).distinct()
    if not fits_broadcast(asked, max_broadcast_keys):
        table = store.read(spark, version)
    else:
        asked = through_storage(asked, "asked-keys")
        table = store.read(spark, version, [r[0] for r in asked.select(store.bucket().alias("b")).distinct().collect()])
        few = asked.limit(max_literal_keys + 1).collect()
        if len(few) <= max_literal_keys:
            first = view.keys[0]
            values = sorted({r[first] for r in few if r[first] is not None})
            kind = version.schema[first].dataType
            table = table.where(F.col(quoted(first)).isin([F.lit(v).cast(kind) for v in values]))
    return online_lookup(keys, table, view, max_broadcast_keys, as_of=as_of, event_as=event_as)
