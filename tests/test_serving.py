"""Serving operators against plain Python on small tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from support import rows
from tablewright.operators import serving as V
from tablewright.operators import views as W

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


def view(ttl=None, created="created", keys=(("k", "string"),)):
    return W.FeatureView(
        name="v",
        entities=tuple(W.Entity(n, t) for n, t in keys),
        fields=(W.Field("v", "int"),),
        source=W.FeatureSource(event_timestamp="event", created_timestamp=created),
        ttl=ttl,
    )


FEATURES = "k string, event timestamp_ntz, created timestamp_ntz, v int"
SPINE = "id int, k string, ts timestamp_ntz"

HOT = V.Skew(min_rows=1, slice_rows=70)
MANY_CUTS = V.Skew(min_rows=1, slice_rows=1)
FEW_SAMPLES = V.Skew(min_rows=100, slice_rows=40, oversample=2)


def brute_force(spine, features, ttl):
    out = []
    for i, key, ts in spine:
        past = [
            (event, created, v)
            for k, event, created, v in features
            if key is not None and ts is not None and k == key and event and event <= ts
        ]
        best = max(past) if past else None
        fresh = best and (ttl is None or best[0] >= ts - ttl)
        out.append((i, key, ts, best[2] if fresh else None))
    return sorted(out, key=repr)


def test_as_of_by_hand(spark):
    features = [
        ("a", START, START, 1),
        ("a", START, START + DAY, 2),
        ("a", datetime(2024, 2, 1), datetime(2024, 2, 1), 3),
    ]
    spine = [
        (1, "a", START),
        (2, "a", START + 7 * DAY),
        (3, "a", START + 7 * DAY + timedelta(seconds=1)),
        (4, "a", datetime(2023, 12, 31)),
        (5, "b", datetime(2024, 2, 2)),
        (6, "a", datetime(2024, 2, 2)),
    ]
    for skew in (None, V.Skew(), HOT):
        out = V.point_in_time_join(
            spark.createDataFrame(spine, SPINE),
            spark.createDataFrame(features, FEATURES),
            view(7 * DAY),
            "ts",
            skew=skew,
        )
        assert {r["id"]: r["v"] for r in out.collect()} == {
            1: 2, 2: 2, 3: None, 4: None, 5: None, 6: 3
        }


def random_case(seed, n=300):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    time = lambda: rng.choice([None, *[START + timedelta(hours=rng.randrange(400))] * 9])
    features = [(key(), time(), START + timedelta(hours=rng.randrange(9)), i) for i in range(n)]
    spine = [(i % (n // 2), key(), time()) for i in range(n)]
    return spine + spine[:20], features


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("skew", [None, V.Skew(), HOT, MANY_CUTS, FEW_SAMPLES])
@pytest.mark.parametrize("ttl", [None, timedelta(hours=3)])
def test_as_of_equals_brute_force(spark, seed, skew, ttl):
    spine, features = random_case(seed)
    out = V.point_in_time_join(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view(ttl),
        "ts",
        skew=skew,
    )
    assert rows(out) == brute_force(spine, features, ttl)


def test_as_of_with_one_time_for_a_third_of_all_rows(spark):
    """One key and one instant hold most rows on both sides."""
    moment = START + 3 * DAY
    features = [("hot", moment, START, i) for i in range(150)] + [("a", START, START, 7)]
    spine = [(i, "hot", moment) for i in range(200)] + [(900, "hot", START), (901, "a", moment)]
    out = V.point_in_time_join(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view(),
        "ts",
        skew=HOT,
    )
    assert rows(out) == brute_force(spine, features, None)


def test_hot_keys_are_exact(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    found = lambda n, df=df: V.hot_keys([df, df], ["k"], V.Skew(min_rows=n)).count()
    assert (found(667), found(668), found(1), found(1, df.limit(0))) == (1, 0, 667, 0)


def test_every_hot_key_is_cut_at_its_own_times(spark):
    """Keys of 4,000 rows, each in a month of its own: no group of a key and
    slice holds more than twice ``slice_rows``, save single instants."""
    skew = V.Skew(min_rows=1000, slice_rows=200)
    df = spark.range(40_000).selectExpr(
        "id % 10 AS k",
        "CAST('2024-01-01' AS TIMESTAMP_NTZ) + make_dt_interval(30 * (id % 10), 0, id div 10) AS event",
    )
    df = df.select("k", F.col("event").alias(V.T_)).withColumn(V.HASH, F.xxhash64("k"))
    cuts = V.through_storage(V.cut_points(df.select(V.HASH, V.T_), skew), "cuts")
    sizes = V.in_slices(df, cuts).groupBy("k", V.SLICE).count()
    most = sizes.agg(F.max("count"), F.countDistinct("k"), F.count("*")).first()
    assert most[0] <= 2 * skew.slice_rows and most[1] == 10 and most[2] > 10 * 20


def test_key_types_may_differ(spark):
    features = spark.createDataFrame([(5, START, START, 1)], FEATURES.replace("k string", "k int"))
    spine = spark.createDataFrame([(1, 5, START)], SPINE.replace("k string", "k bigint"))
    for skew in (V.Skew(), HOT):
        out = V.point_in_time_join(spine, features, view(keys=(("k", "bigint"),)), "ts", skew=skew)
        assert out.first()["v"] == 1 and dict(out.dtypes)["k"] == "bigint"


def test_two_keys_and_event_time_of_the_match(spark):
    two = view(keys=(("k", "string"), ("j", "int")))
    features = spark.createDataFrame(
        [("a", START, START, 1, 1), ("a", START, START, 2, 2)], FEATURES + ", j int"
    )
    spine = spark.createDataFrame([(1, "a", START + DAY, 2), (2, "a", START, None)], SPINE + ", j int")
    out = V.point_in_time_join(spine, features, two, "ts", event_as="seen")
    assert {r["id"]: (r["v"], r["seen"]) for r in out.collect()} == {1: (2, START), 2: (None, None)}


def test_feature_names_must_be_new(spark):
    spine = spark.createDataFrame([(1, "a", START)], SPINE).withColumnRenamed("id", "V")
    features = spark.createDataFrame([("a", START, START, 1)], FEATURES)
    with pytest.raises(ValueError):
        V.point_in_time_join(spine, features, view(), "ts")


def latest(features, until, since=None):
    best = {}
    for k, event, created, v in features:
        if k is None or event is None or event > until or (since and event <= since):
            continue
        best[k] = max(best.get(k, (datetime.min, datetime.min, 0)), (event, created, v))
    return sorted(((k, v, e, c) for k, (e, c, v) in best.items()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_latest_and_incremental(spark, seed):
    _, features = random_case(seed)
    df = spark.createDataFrame(features, FEATURES)
    since, until = START + 5 * DAY, START + 12 * DAY
    first = V.materialize_latest(df, view(), since)
    assert rows(first) == latest(features, since)
    full = V.materialize_latest(df, view(), until)
    assert rows(full) == latest(features, until)
    for bound in (100, 1):
        again = V.materialize_incremental(first, df, view(), since, until, bound)
        assert again.columns == full.columns and rows(again) == rows(full)
    assert rows(V.materialize_latest(df, view(), until, since)) == latest(features, until, since)


def test_bounds_as_text_or_time(spark):
    df = spark.createDataFrame([("a", START, START, 1), ("a", START + DAY, START, 2)], FEATURES)
    for until in (START, "2024-01-01", "2024-01-01 00:00:00"):
        assert V.materialize_latest(df, view(), until).first()["v"] == 1


@pytest.mark.parametrize("bound", [100, 1])
def test_lookup_keeps_all_asked_rows(spark, bound):
    snapshot = spark.createDataFrame([("a", 1, START, START), ("b", 2, START, START)], "k string, v int, event timestamp_ntz, created timestamp_ntz")
    asked = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k string")
    out = V.online_lookup(asked, snapshot, view(), max_broadcast_keys=bound)
    assert rows(out) == sorted([("a", 1), ("a", 1), ("x", None), (None, None)], key=repr)


def test_lookup_serves_nothing_beyond_the_ttl(spark):
    from dataclasses import replace
    from datetime import timedelta

    snapshot = spark.createDataFrame(
        [("a", 1, START, START), ("b", 2, START + timedelta(days=2), START)],
        "k string, v int, event timestamp_ntz, created timestamp_ntz",
    )
    asked = spark.createDataFrame([("a",), ("b",)], "k string")
    short = replace(view(), ttl=timedelta(days=1))
    at = START + timedelta(days=3)
    out = V.online_lookup(asked, snapshot, short, as_of=at, event_as="seen")
    assert rows(out) == sorted([("a", None, None), ("b", 2, START + timedelta(days=2))], key=repr)
    endless = replace(view(), ttl=None)
    assert rows(V.online_lookup(asked, snapshot, endless, as_of=at)) == [("a", 1), ("b", 2)]


def several_views(seed, n=200):
    """Three views, one of them of other keys, and a spine with both keys."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    place = lambda: rng.choice([0, 0, 1, None])
    time = lambda: rng.choice([None, *[START + timedelta(hours=rng.randrange(300))] * 9])
    tables = []
    for name, keys, draw, ttl in (("x", "k string", key, 2 * DAY), ("y", "k string", key, None), ("z", "p int", place, DAY)):
        schema = f"{keys}, event timestamp_ntz, created timestamp_ntz, {name} int"
        history = [(draw(), time(), START + timedelta(hours=rng.randrange(9)), i) for i in range(n)]
        contract = W.FeatureView(
            name=name,
            entities=(W.Entity(*keys.split()),),
            fields=(W.Field(name, "int"),),
            source=W.FeatureSource(event_timestamp="event", created_timestamp="created"),
            ttl=ttl,
        )
        tables.append((schema, history, contract))
    return [(i, key(), place(), time()) for i in range(n)], tables


@pytest.mark.parametrize("skew", [None, V.Skew(), HOT, MANY_CUTS, FEW_SAMPLES])
def test_several_views_equal_a_chain_of_joins(spark, skew):
    spine, tables = several_views(11)
    spine = spark.createDataFrame(spine, "id int, k string, p int, ts timestamp_ntz")
    sources = [(spark.createDataFrame(history, schema), contract) for schema, history, contract in tables]
    names = {"x": "x_at", "z": "z_at"}
    out = V.point_in_time_joins(spine, sources, "ts", event_as=names, skew=skew)
    chain = spine
    for features, contract in sources:
        chain = V.point_in_time_join(chain, features, contract, "ts", event_as=names.get(contract.name), skew=None)
    assert out.columns == ["id", "k", "p", "ts", "x", "x_at", "y", "z", "z_at"]
    assert rows(out) == rows(chain)


def test_views_of_one_key_take_one_shuffle(spark):
    spine, tables = several_views(3)
    spine = spark.createDataFrame(spine, "id int, k string, p int, ts timestamp_ntz")
    sources = [(spark.createDataFrame(history, schema), contract) for schema, history, contract in tables]
    text = V.point_in_time_joins(spine, sources[:2], "ts", skew=None)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Window [") + text.count("Window (") >= 1
    whole = spine.where("k IS NOT NULL AND p IS NOT NULL AND ts IS NOT NULL").selectExpr(
        "id", "coalesce(k, '') AS k", "coalesce(p, 0) AS p", "coalesce(ts, timestamp_ntz'2024-01-01') AS ts"
    )
    text = V.point_in_time_joins(whole, sources, "ts", skew=None)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def test_views_must_not_share_names(spark):
    spine, tables = several_views(3)
    spine = spark.createDataFrame(spine, "id int, k string, p int, ts timestamp_ntz")
    schema, history, contract = tables[0]
    features = spark.createDataFrame(history, schema)
    with pytest.raises(ValueError, match="more than one view"):
        V.point_in_time_joins(spine, [(features, contract), (features, contract)], "ts")
    with pytest.raises(ValueError, match="already has"):
        V.point_in_time_joins(spine.withColumnRenamed("id", "X"), [(features, contract)], "ts")
