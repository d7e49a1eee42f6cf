import pytest

from support import rows
from tablewright.operators import dedup as D


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "k string, v int")
    assert rows(D.dedup_by_key(df, ["k"])) == rows(
        spark.createDataFrame([(None, 1), ("a", 3)], "k string, v int")
    )


def test_order_and_side(spark):
    df = spark.createDataFrame([("a", 1, "z"), ("a", 2, "y"), ("a", 2, "x")], "k string, o int, v string")
    assert D.dedup_by_key(df, ["k"], ["o"]).collect() == [("a", 1, "z")]
    assert D.dedup_by_key(df, ["k"], ["o"], keep="last").collect() == [("a", 2, "y")]
    assert D.dedup_by_key(df, ["k"], ["v"]).collect() == [("a", 2, "x")]
    with pytest.raises(ValueError):
        D.dedup_by_key(df, ["k"], keep="any")
    with pytest.raises(ValueError):
        D.dedup_by_key(df, ["k"], ["absent"])


def test_keeps_columns_and_order(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "v int, k string, w double")
    assert D.dedup_by_key(df, ["k"]).columns == ["v", "k", "w"]
    assert D.dedup_by_key(df.select("k"), ["k"]).columns == ["k"]


def test_unsortable_payload(spark):
    df = spark.createDataFrame([("a", 2, {"x": 2}), ("a", 1, {"x": 1})], "k string, o int, m map<string,int>")
    assert D.dedup_by_key(df, ["k"], ["o"]).first()["m"] == {"x": 1}


def test_same_choice_however_the_rows_are_spread(spark):
    df = spark.range(400).selectExpr("id % 3 AS k", "id % 7 AS o", "id AS v")
    want = rows(D.dedup_by_key(df.coalesce(1), ["k"], ["o"]))
    for n in (2, 5, 8):
        assert rows(D.dedup_by_key(df.repartition(n), ["k"], ["o"])) == want


@pytest.mark.parametrize("bound", [1000, 2])
def test_rare_form_gives_the_same_rows(spark, bound):
    df = spark.range(300).selectExpr(
        "CASE WHEN id < 40 THEN id % 10 WHEN id < 45 THEN NULL ELSE id END AS k", "id AS v"
    )
    for keep in ("first", "last"):
        assert rows(D.dedup_rare(df, ["k"], ["v"], keep, bound)) == rows(
            D.dedup_by_key(df, ["k"], ["v"], keep)
        )


def test_removed(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], ["k"])
    assert D.dedup_removed(df, ["k"]).collect() == [(5, 3, 2)]
    assert D.dedup_removed(df.limit(0), ["k"]).collect() == [(0, 0, 0)]


def test_hot_key_reaches_the_reducer_as_one_row_per_task(spark):
    """The plan aggregates before the exchange and has no window."""
    df = spark.range(100).selectExpr("0 AS k", "id AS v")
    plan = D.dedup_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
