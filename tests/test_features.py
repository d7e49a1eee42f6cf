import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.operators import features as N
from tablewright.operators.columns import (
    conjunction_flag,
    drop_columns,
    filter_equals,
    filter_is_null,
    filter_negative,
    filter_out_of_range,
    select_by_suffix,
    select_existing,
    stamp_timestamps,
)
from tablewright.plans import customer

INF = float("inf")
SPLITS = customer.TENURE_SPLITS


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_buckets_are_closed_on_the_left(spark):
    values = [0.0, 11.0, 11.999, 12.0, 24.0, 47.0, 48.0, 72.0, INF, None]
    out = N.bucketize(numbers(spark, values), "x", SPLITS, "b").collect()
    assert [r["b"] for r in out] == [0.0, 0.0, 0.0, 1.0, 2.0, 2.0, 3.0, 3.0, 3.0, None]


def test_last_bucket_is_closed(spark):
    out = N.bucketize(numbers(spark, [9.0, 10.0]), "x", [0, 5, 10], "b").collect()
    assert [r["b"] for r in out] == [1.0, 1.0]


@pytest.mark.parametrize("value", [-1.0, math.nan])
def test_values_outside_fail_or_become_null(spark, value):
    df = numbers(spark, [value])
    with pytest.raises(PySparkException):
        N.bucketize(df, "x", SPLITS, "b").collect()
    assert N.bucketize(df, "x", SPLITS, "b", on_error="null").first()["b"] is None


def test_text_is_no_bucket_input(spark):
    with pytest.raises(TypeError):
        N.bucketize(spark.createDataFrame([("1",)], ["x"]), "x", SPLITS, "b")


def test_buckets_equal_the_ml_transformer(spark):
    from pyspark.ml.feature import Bucketizer

    df = spark.range(0, 100).selectExpr("CAST(id AS DOUBLE) / 1.25 AS x")
    ml = Bucketizer(splits=[float(s) for s in SPLITS], inputCol="x", outputCol="want")
    both = ml.transform(N.bucketize(df, "x", SPLITS, "got"))
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0


def charges(spark, rows):
    return spark.createDataFrame(rows, "tenure int, monthly double, total double")


def ratios(df, on_error="raise"):
    df = N.guarded_ratio(df, "total", "tenure", "monthly", "average", on_error)
    return [r["ratio"] for r in N.plain_ratio(df, "monthly", "average", "ratio", on_error).collect()]


def test_ratios(spark):
    got = ratios(charges(spark, [(0, 20.0, 0.0), (10, 20.0, 180.0), (None, 20.0, 1.0)]))
    assert got == [1.0, 20.0 / 18.0, None]


@pytest.mark.parametrize("row", [(5, 20.0, 0.0), (0, 0.0, 0.0), (3, 0.0, 0.0)])
def test_zero_divisor_fails_or_becomes_null(spark, row):
    with pytest.raises(PySparkException):
        ratios(charges(spark, [row]))
    assert ratios(charges(spark, [row]), "null") == [None]


def test_conjunction(spark):
    df = spark.createDataFrame(
        [(25, 80.01), (24, 90.0), (25, 80.0), (None, 90.0)], "tenure int, monthly_charges double"
    )
    out = conjunction_flag(df, customer.HIGH_VALUE, "hv")
    assert [r["hv"] for r in out.collect()] == [1, 0, 0, 0]
    with pytest.raises(ValueError):
        conjunction_flag(df, {}, "hv")


def test_filters(spark):
    df = numbers(spark, [None, math.nan, -1.0, 9.0, 2.0])
    assert filter_out_of_range(df, "x", 0, 4).count() == 3
    assert filter_negative(df, "x").count() == 1
    assert filter_is_null(df, "x").count() == 1
    assert filter_equals(df, "x", 2.0).count() == 1
    text = spark.createDataFrame([("60s",), ("1",)], ["c"])
    assert filter_equals(text, "c", "60s").count() == 1


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b_vec", "c_vec"])
    assert select_existing(df, ["c_vec", "absent", "a"]).columns == ["c_vec", "a"]
    assert select_by_suffix(df, "_vec", keep=["a"]).columns == ["a", "b_vec", "c_vec"]
    assert drop_columns(df, ["a", "absent"]).columns == ["b_vec", "c_vec"]


def test_stamps(spark):
    fixed = stamp_timestamps(spark.range(2), as_of="2024-06-01 10:00:00")
    texts = fixed.selectExpr("CAST(event_timestamp AS STRING) e", "CAST(created_timestamp AS STRING) c")
    assert set(map(tuple, texts.collect())) == {("2024-06-01 10:00:00", "2024-06-01 10:00:00")}
    now = stamp_timestamps(spark.range(1))
    assert now.where("abs(timestampdiff(HOUR, event_timestamp, now())) < 1").count() == 1
    assert now.where("event_timestamp = created_timestamp").count() == 1
