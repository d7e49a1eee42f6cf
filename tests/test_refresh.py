"""The bucketed store: what is served, what is read and what is written."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from support import rows
from tablewright.operators import refresh as R
from tablewright.operators import serving as V
from tablewright.operators import views as W

START = datetime(2024, 1, 1)
HOUR = timedelta(hours=1)
FEATURES = "k long, event timestamp_ntz, created timestamp_ntz, v int"


def view(created="created", ttl=None):
    return W.FeatureView(
        name="v",
        entities=(W.Entity("k", "bigint"),),
        fields=(W.Field("v", "int"),),
        source=W.FeatureSource(event_timestamp="event", created_timestamp=created),
        ttl=ttl,
    )


def files(root):
    return {
        os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
        for d, _, names in os.walk(os.path.join(root, "data"))
        for n in names
        if n.endswith(".parquet")
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_late_rows_are_served_and_other_buckets_stay(spark, tmp_path):
    store = R.store_of(str(tmp_path), view(), buckets=8)
    history = [(k, START + k * HOUR, START + k * HOUR, k) for k in range(100)]
    first = spark.createDataFrame(history, FEATURES)
    R.refresh_buckets(store, first, view(), START + 200 * HOUR)
    before = files(tmp_path)
    late = (7, START + 8 * HOUR, START + 300 * HOUR, 777)  # event long past, created lately
    future = (8, START + 900 * HOUR, START + 300 * HOUR, 888)  # not due yet
    grown = spark.createDataFrame([*history, late, future], FEATURES)
    version = R.refresh_buckets(store, grown, view(), START + 400 * HOUR)
    now = store.read(spark, store.current(spark))
    assert rows(now) == rows(V.materialize_latest(grown, view(), START + 400 * HOUR))
    after = files(tmp_path)
    assert all(after[f] == t for f, t in before.items()) and len(after) - len(before) == 1
    kept = [p for p in version.paths.values() if version.name not in p]
    assert len(version.paths) == 8 and len(kept) == 7
    R.refresh_buckets(store, grown, view(), START + 1000 * HOUR)  # now it is due
    now = store.read(spark, store.current(spark))
    assert {r["k"]: r["v"] for r in now.collect()}[8] == 888


@pytest.mark.parametrize("created", ["created", None])
def test_refreshes_equal_a_full_run(spark, tmp_path, created):
    rng = random.Random(4)
    contract = view(created)
    store = R.store_of(str(tmp_path), contract, buckets=4)
    history = []
    for step in range(1, 4):
        now = START + step * 100 * HOUR
        for i in range(60):
            made = now - rng.randrange(100) * HOUR
            event = made - (rng.randrange(250) * HOUR if created else timedelta(0)) + rng.choice([0, 0, 30]) * HOUR
            history.append((rng.choice([1, 1, 1, rng.randrange(40), None]), rng.choice([event, event, None]), made, 60 * step + i))
        df = spark.createDataFrame(history, FEATURES)
        R.refresh_buckets(store, df, contract, now)
        served = store.read(spark, store.current(spark))
        assert rows(served) == rows(V.materialize_latest(df, contract, now).select(*served.columns))


def test_only_new_rows_are_read(spark, tmp_path):
    store = R.store_of(str(tmp_path / "store"), view(), buckets=4)
    spark.createDataFrame([(1, START, START, 1)], FEATURES).write.parquet(str(tmp_path / "gold"))
    df = spark.read.parquet(str(tmp_path / "gold"))
    last = R.refresh_buckets(store, df, view(), START + HOUR)
    assert last.seen == "2024-01-01 00:00:00"
    text = plan(V._dated(df, view(), None, START + 9 * HOUR).where(R._due(df, view(), last, timedelta(0))))
    pushed = text[text.index("PushedFilters") :]
    assert "Or(GreaterThan(event" in pushed and "LessThanOrEqual(event" in pushed


def test_lag_reads_rows_again_that_came_out_of_order(spark, tmp_path):
    first = [(1, START, START + 5 * HOUR, 1)]
    second = [*first, (2, START, START + 4 * HOUR, 2)]  # created before the newest row read
    for lag, keys in ((timedelta(0), {1}), (2 * HOUR, {1, 2})):
        store = R.store_of(str(tmp_path / str(lag.seconds)), view(), buckets=2)
        for history in (first, second):
            R.refresh_buckets(store, spark.createDataFrame(history, FEATURES), view(), START + 9 * HOUR, lag=lag)
        assert {r["k"] for r in store.read(spark, store.current(spark)).collect()} == keys


def test_time_does_not_go_back_and_empty_stores_are_read(spark, tmp_path):
    store = R.store_of(str(tmp_path), view(), buckets=3)
    none = spark.createDataFrame([], FEATURES)
    with pytest.raises(ValueError, match="nothing is published"):
        R.lookup_buckets(spark.range(3).selectExpr("id AS k"), store, view())
    R.refresh_buckets(store, none, view(), START + HOUR)
    assert store.read(spark, store.current(spark)).collect() == []
    assert R.lookup_buckets(spark.range(3).selectExpr("id AS k"), store, view()).count() == 3
    R.refresh_buckets(store, spark.createDataFrame([(1, START, START, 1)], FEATURES), view(), START + HOUR)
    assert store.read(spark, store.current(spark)).columns == ["k", "v", "event", "created"]
    with pytest.raises(ValueError, match="is served until"):
        R.refresh_buckets(store, none, view(), START)
    with pytest.raises(ValueError, match="has 3 buckets"):
        R.store_of(str(tmp_path), view(), buckets=4).current(spark)


def test_a_lookup_opens_the_files_of_its_buckets(spark, tmp_path):
    store = R.store_of(str(tmp_path), view(), buckets=32)
    history = spark.range(5000).select(
        F.col("id").alias("k"), F.lit(START).alias("event"), F.lit(START).alias("created"), F.col("id").cast("int").alias("v")
    )
    history = history.select("k", F.col("event").cast("timestamp_ntz"), F.col("created").cast("timestamp_ntz"), "v")
    R.refresh_buckets(store, history, view(), START)
    assert len(files(tmp_path)) == 32
    keys = spark.createDataFrame([(5,), (77,), (None,), (99999,), (5,)], "k long")
    out = R.lookup_buckets(keys, store, view())
    assert rows(out) == rows(V.online_lookup(keys, store.read(spark, store.current(spark)), view()))
    read = [f for f in out.inputFiles() if "/data/" in f]
    assert 0 < len(read) <= 4
    assert "In(k, [5,77,99999])" in plan(out)
    many = spark.range(4000).selectExpr("id AS k")
    assert R.lookup_buckets(many, store, view(), max_broadcast_keys=10).where("v IS NOT NULL").count() == 4000
    assert R.lookup_buckets(many, store, view(), max_literal_keys=10).where("v = k").count() == 4000


def test_key_types_of_both_sides_meet(spark, tmp_path):
    store = R.store_of(str(tmp_path), view(), buckets=16)
    R.refresh_buckets(store, spark.createDataFrame([(i, START, START, i) for i in range(50)], FEATURES), view(), START)
    keys = spark.range(50).selectExpr("CAST(id AS INT) AS k")  # another width
    assert R.lookup_buckets(keys, store, view()).where("v = k").count() == 50


def test_unused_folders_go(spark, tmp_path):
    store = R.store_of(str(tmp_path), view(), buckets=4)
    assert store.drop_unused(spark) == []
    history = [(k, START + k * HOUR, START + k * HOUR, k) for k in range(40)]
    for step in range(1, 4):
        late = [(5, START + step * HOUR, START + (100 + step) * HOUR, 500 + step)]
        history += late
        R.refresh_buckets(store, spark.createDataFrame(history, FEATURES), view(), START + (100 + step) * HOUR)
    before = rows(store.read(spark, store.current(spark)))
    dropped = store.drop_unused(spark, keep=1)
    assert len(dropped) == 2  # the bucket of key 5 was written three times
    assert rows(store.read(spark, store.current(spark))) == before
    assert len(files(tmp_path)) == 4 and store.drop_unused(spark, keep=1) == []
    with pytest.raises(ValueError, match="must be kept"):
        store.drop_unused(spark, keep=0)
