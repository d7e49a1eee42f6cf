import pytest

from tablewright.functions.expressions import bucket_index
from tablewright.functions.naming import quoted, rows_of, snake_case, text


@pytest.mark.parametrize(
    "name, expected",
    [
        ("customerID", "customer_i_d"),
        ("CustomerID", "customer_i_d"),
        ("StreamingTV", "streaming_t_v"),
        ("TotalCharges", "total_charges"),
        ("Tenure", "tenure"),
        ("tenure", "tenure"),
        ("already_snake", "already_snake"),
        ("", ""),
        ("A", "a"),
        ("ÄpfelÖl", "äpfelöl"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_quoted_names_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
    assert df.select(quoted("a.b"), quoted("c`d")).first() == (1, 2)


@pytest.mark.parametrize("value", ["plain", "it's", 'say "x"', "back\\slash", "", "ünï", "a\nb"])
def test_text_literal_keeps_every_character(spark, value):
    assert spark.range(1).selectExpr(f"{text(value)} AS v").first()["v"] == value


def test_rows_of(spark):
    out = spark.range(1).selectExpr(rows_of(("a", "b"), [("1", "'x'"), ("2", "'y'")]))
    assert [tuple(r) for r in out.collect()] == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("splits", [[0, 1], [0, 2, 1], [0, 1, 1], [0, float("nan"), 2]])
def test_bad_splits(splits):
    with pytest.raises(ValueError):
        bucket_index("x", splits)


def test_bad_mode():
    with pytest.raises(ValueError):
        bucket_index("x", [0, 1, 2], on_error="ignore")
