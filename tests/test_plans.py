"""What the plans must look like to hold at scale."""

import re
from datetime import timedelta

import pytest

from tablewright.catalog.fixture import raw
from tablewright.operators import encoding as E
from tablewright.operators import profiling as P
from tablewright.operators import quality as Q
from tablewright.operators import serving as V
from tablewright.operators import views as W
from tablewright.plans import customer, layers
from tablewright.sources import read_statistics, write_dated


def plan(df):
    """The physical plan before it runs (afterwards it lists scans twice)."""
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return text.count("FileScan")


def shuffles(text):
    return text.count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    silver, gold = str(root / "silver"), str(root / "gold")
    layers.silver(raw(spark, sf_dir), customer.CLEAN).write.parquet(silver)
    silver = spark.read.parquet(silver)
    layers.gold(silver, customer.FEATURES).write.parquet(gold)
    return silver, spark.read.parquet(gold)


def test_gate_is_one_pass_over_the_needed_columns(stored):
    text = plan(Q.run_gate(stored[1], customer.gold_rules()))
    assert scans(text) == 1 and shuffles(text) == 1 and "Expand" not in text
    read = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert len(read.split(",")) == 4


def test_profiles_are_one_pass(stored):
    for df in (
        P.null_profile(stored[1]),
        P.schema_profile(stored[1]),
        P.describe_stats(stored[1]),
        W.check_view(stored[1], customer.feature_view()),
    ):
        text = plan(df)
        assert scans(text) == 1 and shuffles(text) == 0


def test_gold_has_no_shuffle(stored):
    vocab = E.collect_vocab(E.fit_vocab(stored[0], customer.CATEGORIES), customer.CATEGORIES)
    text = plan(layers.gold(stored[0], customer.FEATURES, vocab=vocab))
    assert scans(text) == 1 and "Exchange" not in text and "Join" not in text


def test_cleaning_has_one_shuffle(spark, sf_dir):
    text = plan(layers.silver(raw(spark, sf_dir), customer.CLEAN))
    assert scans(text) == 1 and shuffles(text) == 1 and "partial_min" in text


def test_vocabulary_is_one_scan_with_partial_counts(stored):
    text = plan(E.label_counts(stored[0], customer.CATEGORIES))
    assert scans(text) == 1 and shuffles(text) == 1 and "partial_count" in text
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert len(columns.split(",")) == len(customer.CATEGORIES)


def history(ttl=None):
    return W.FeatureView(
        name="v",
        entities=(W.Entity("user_id", "bigint"),),
        fields=(W.Field("value", "double"),),
        source=W.FeatureSource(event_timestamp="ts", created_timestamp=None),
        ttl=ttl,
    )


def test_time_bounds_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    view = history()
    text = plan(V.materialize_latest(events, view, until="2024-01-09", since="2024-01-05"))
    assert "GreaterThan(ts,2024-01-05" in text and "LessThanOrEqual(ts,2024-01-09" in text
    assert "props" not in text
    assert "partial_max" in text


def test_refresh_shuffles_only_touched_snapshot_rows(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    view = history()
    V.materialize_latest(events, view, "2024-01-05").write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    out = V.materialize_incremental(old, events, view, "2024-01-05", "2024-01-09")
    text = plan(out)
    assert text.count("BroadcastHashJoin") == 2 and shuffles(text) == 1 and "props" not in text


def test_as_of_join_is_one_shuffle_of_the_columns_in_use(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    spine = events.drop("value").where("event_type = 'purchase'")
    out = V.point_in_time_join(spine, events, history(timedelta(days=1)), "ts")
    text = plan(out.select("event_id", "value"))
    assert shuffles(text) == 1 and "Join" not in text and "props" not in text


def test_hot_keys_are_joined_back_by_key_and_time(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("user_id", events_key())
    spine = events.drop("value").where("event_type = 'purchase'")
    skew = V.Skew(min_rows=10, slice_rows=20)
    text = plan(V.point_in_time_join(spine, events, history(), "ts", skew=skew))
    assert "__slice" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text


def events_key():
    from pyspark.sql import functions as F

    return F.expr("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END")


def test_wide_vocabularies_move_the_table_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 300 AS a", "id % 400 AS b", "id % 500 AS c", "repeat('x', 9) AS wide")
    cols = ["a", "b", "c"]
    vocab = E.fit_vocab(df, cols)
    small = plan(E.encode_many(df, vocab, cols, form=E.SPARSE))
    assert "SortMergeJoin" not in small and small.count("BroadcastHashJoin") == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(E.encode_many(df, vocab, cols, form=E.SPARSE, broadcast_labels=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows, the pairs and the vocabulary; slots by row arrive dealt by row
    assert large.count("SortMergeJoin") == 2
    moved = [line for line in large.splitlines() if "Exchange hashpartitioning(__row" in line]
    assert len(moved) == 2


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "nullif(id % 7, 3) AS v", "repeat('x', 50) AS wide").write.parquet(path)
    table = read_statistics(spark, path)
    gate = [Q.MinRows(n=10), Q.NotNull(col="v")]
    for df in (P.row_count(table), P.null_profile(table), P.schema_profile(table), Q.run_gate(table, gate)):
        assert re.search(r"PushedAggregation: \[(COUNT|count)", plan(df)), plan(df)
    assert P.row_count(table).first()["n"] == 1000
    assert P.null_profile(table).first().asDict() == {"id": 0, "v": 143, "wide": 0}
    assert [r["violations"] for r in Q.run_gate(table, gate).collect()] == [0, 143]
    # the session that reads in the usual way keeps doing so
    assert "FileScan parquet" in plan(P.row_count(spark.read.parquet(path)))
    assert table.where("v = 5").count() == 143


def test_time_bounds_open_only_their_days(spark, tmp_path):
    path = str(tmp_path / "dated")
    rows = spark.range(240).selectExpr("id % 9 AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS t", "id AS v")
    write_dated(rows, path, "t")
    view = W.FeatureView(
        name="v",
        entities=(W.Entity("k", "bigint"),),
        fields=(W.Field("v", "bigint"),),
        source=W.FeatureSource(path=path, event_timestamp="t", created_timestamp=None, date_partition="event_date"),
    )
    stored = W.conform(view.source.read(spark), view)
    out = V.materialize_latest(stored, view, "2024-01-04 12:00:00", "2024-01-03 06:00:00")
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(out)).group(1)
    assert "event_date" in pruned and "2024-01-03" in pruned and "2024-01-04" in pruned
    assert sorted(r["v"] for r in out.collect()) == list(range(76, 85))
    assert rows.count() == spark.read.parquet(path).count()
