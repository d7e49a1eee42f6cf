import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from support import rows
from tablewright.catalog.fixture import raw
from tablewright.operators import cleaning as C
from tablewright.operators import dedup as D
from tablewright.plans import customer


def test_names_and_fixes(spark):
    df = spark.createDataFrame([("x", 1, 2)], ["customerID", "StreamingTV", "Tenure"])
    out = C.snake_case_columns(df)
    assert out.columns == ["customer_i_d", "streaming_t_v", "tenure"]
    assert C.fix_acronym_names(out, customer.NAME_FIXES).columns == [
        "customer_id",
        "streaming_tv",
        "tenure",
    ]
    assert C.snake_case_columns(df, customer.NAME_FIXES).columns[0] == "customer_id"


def test_names_that_would_collide_are_refused(spark):
    with pytest.raises(ValueError, match="tenure"):
        C.snake_case_columns(spark.createDataFrame([(1, 2)], ["Tenure", "tenure"]))


def test_yes_no(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), (" Yes",), (None,)], ["f"])
    out = C.yes_no_to_int(df, ["f", "absent"])
    assert [r["f"] for r in out.collect()] == [1, 0, None, None, None]
    assert dict(out.dtypes)["f"] == "int"


def test_yes_no_leaves_numbers_and_takes_booleans(spark):
    df = spark.createDataFrame([(1, True, 5), (0, False, 6)], "i int, b boolean, l bigint")
    out = C.yes_no_to_int(df, ["i", "b"])
    assert [tuple(r) for r in out.collect()] == [(1, 1, 5), (0, 0, 6)]
    with pytest.raises(TypeError):
        C.yes_no_to_int(spark.createDataFrame([(1.0,)], ["d"]), ["d"])


def test_cast_int_flags(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,)], "f double")
    out = C.cast_int_flags(df, ["f", "absent"])
    assert [r["f"] for r in out.collect()] == [1, 0, None]
    assert C.cast_int_flags(df, ["absent"]).columns == ["f"]


def test_blank_numbers(spark):
    df = spark.createDataFrame([("29.85",), (" 1e2 ",), (" ",), ("",), (None,), ("NaN",)], ["n"])
    assert [r["n"] for r in C.blank_to_null_numeric(df, ["n"], fill=0.0).collect()] == [
        29.85,
        100.0,
        0.0,
        0.0,
        0.0,
        0.0,
    ]
    kept = [r["n"] for r in C.blank_to_null_numeric(df, ["n"]).collect()]
    assert kept[:5] == [29.85, 100.0, None, None, None] and kept[5] != kept[5]


def test_bad_number_fails_or_becomes_null(spark):
    df = spark.createDataFrame([("60s",), ("1",)], ["n"])
    with pytest.raises(PySparkException):
        C.blank_to_null_numeric(df, ["n"]).collect()
    out = C.blank_to_null_numeric(df, ["n"], on_error="null")
    assert [r["n"] for r in out.collect()] == [None, 1.0]


def test_numbers_of_other_types(spark):
    df = spark.createDataFrame([(7, 2.5)], "i int, d double")
    out = C.blank_to_null_numeric(df, ["i", "d"])
    assert out.dtypes == [("i", "double"), ("d", "double")] and out.first() == (7.0, 2.5)


def test_missing_number_column_is_an_error(spark):
    with pytest.raises(ValueError, match="absent"):
        C.blank_to_null_numeric(spark.range(1), ["absent"])


def test_clean_twice_changes_nothing(spark, sf_dir):
    once = C.clean(raw(spark, sf_dir), customer.CLEAN)
    again = C.CleanSpec(**{**customer.CLEAN.__dict__, "fixes": {}})
    assert once.columns == C.clean(once, again).columns
    assert rows(once) == rows(C.clean(once, again))


def test_clean_removes_a_second_ingestion(spark, sf_dir):
    df = raw(spark, sf_dir)
    assert rows(C.clean(df.unionAll(df), customer.CLEAN)) == rows(C.clean(df, customer.CLEAN))


def test_lost_values_are_counted_by_the_write(spark, tmp_path):
    spec = C.CleanSpec(keys=("k",), yes_no=("flag", "number_flag"), numbers=("n", "d"), on_error="null", order_by=("k",))
    rows_in = [
        (1, "Yes", 1, "1.5", 1.0),
        (2, "perhaps", 0, "60s", None),
        (3, None, 1, " ", 2.0),
        (3, "No", 1, "x", 2.0),
        (4, "no", 0, None, 2.0),
    ]
    df = spark.createDataFrame(rows_in, "k int, flag string, numberFlag int, n string, d double")
    lost = Observation()
    D.dedup_by_key(C.standardise(df, spec, lost), spec.keys, spec.order_by).write.parquet(str(tmp_path / "t"))
    # flags and numbers that were numbers already lose nothing; blanks were empty
    assert lost.get == {C.ROWS_READ: 5, "n": 2, "flag": 2}


def test_a_column_named_like_the_count(spark):
    spec = C.CleanSpec(keys=("k",), numbers=("n",), on_error="null")
    df = spark.createDataFrame([(1, "x"), (2, "3")], "k int, n string")
    lost = Observation()
    C.standardise(df, spec, lost).collect()
    assert lost.get["n"] == 1 and lost.get[C.ROWS_READ] == 2
