import math

import pytest

from tablewright.operators import profiling as P
from tablewright.operators.quantiles import quantiles


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([(None, 1), (None, 2), ("a", 2)], "k string, v int")


def test_counts(keys):
    assert P.row_count(keys).first()["n"] == 3
    assert P.distinct_count(keys, ["k"]).first()["n_distinct"] == 2
    assert P.duplicate_count(keys, ["k"]).collect() == [(3, 2, 1)]
    assert P.duplicate_count(keys, ["k", "v"]).collect() == [(3, 3, 0)]
    assert P.distinct_project(keys, ["k"]).count() == 2
    empty = keys.limit(0)
    assert P.duplicate_count(empty, ["k"]).collect() == [(0, 0, 0)]


def test_null_and_schema_profiles(keys):
    profile = P.null_profile(keys)
    assert profile.columns == keys.columns and profile.collect() == [(2, 0)]
    assert P.schema_profile(keys).collect() == [(0, "k", "string", 1), (1, "v", "int", 3)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` double")
    assert P.null_profile(df).collect() == [(0, 1)]
    assert P.schema_profile(df).count() == 2
    assert P.describe_stats(df, ["a.b"]).first()["max"] == 1.0


def test_describe(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (3, None, "y")], "a int, b double, c string")
    got = {r["column"]: tuple(r)[1:] for r in P.describe_stats(df).collect()}
    assert got == {"a": (2, 2.0, math.sqrt(2), 1.0, 3.0), "b": (1, 2.0, None, 2.0, 2.0)}
    with pytest.raises(ValueError):
        P.describe_stats(df.select("c"))


def test_describe_equals_pandas(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_size", "p_retailprice")
    want = df.toPandas().describe()
    for r in P.describe_stats(df).collect():
        for name, pandas_name in [("count", "count"), ("mean", "mean"), ("stddev", "std")]:
            assert r[name] == pytest.approx(want.loc[pandas_name, r["column"]])
        assert (r["min"], r["max"]) == (want.loc["min", r["column"]], want.loc["max", r["column"]])


def test_peek(spark):
    df = spark.range(100).selectExpr("99 - id AS x")
    assert [r["x"] for r in P.peek(df, 3, ["x"]).collect()] == [0, 1, 2]
    assert P.peek(df, 4).count() == 4


@pytest.mark.parametrize("one_level_rows", [0, 10**9])
@pytest.mark.parametrize("max_rows", [1, 50, 10**6])
def test_quantiles_equal_pandas(spark, max_rows, one_level_rows):
    df = spark.range(4000).selectExpr(
        "CAST(pmod(hash(id), 1000003) AS DOUBLE) / 7 AS spread",
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 11 END AS ties",
        "CASE WHEN id < 3990 THEN 1 ELSE id END AS heavy",
        "CASE WHEN id % 2 = 0 THEN -1.0D / (id + 1) WHEN id % 5 = 0 THEN double('nan') END AS gaps",
        "CAST(NULL AS INT) AS empty",
    )
    probs = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    want = df.toPandas().quantile(list(probs))
    for r in quantiles(df, df.columns, probs, max_rows, one_level_rows=one_level_rows).collect():
        if r["column"] == "empty":
            assert r["value"] is None
        else:
            assert r["value"] == pytest.approx(want.loc[r["prob"], r["column"]], rel=1e-12)


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(3.0,)], ["x"])
    assert {r["value"] for r in quantiles(one, ["x"], max_rows=0).collect()} == {3.0}
    assert quantiles(one.limit(0), ["x"]).where("value IS NOT NULL").count() == 0
    ends = spark.createDataFrame([(float("inf"),), (1.0,), (float("-inf"),)], ["x"])
    assert quantiles(ends, ["x"], [0.5]).first()["value"] == 1.0
