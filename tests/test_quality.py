import pytest

from tablewright.operators import quality as Q
from tablewright.plans import customer


def report(df, rules):
    return {r["rule"]: (r["kind"], r["violations"], r["passed"]) for r in Q.run_gate(df, rules).collect()}


@pytest.fixture(scope="module")
def table(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [("a", None, 1), ("a", nan, -1), (None, -1.0, 0), (None, 9.0, 0)],
        "k string, x double, y int",
    )


def test_rules(table):
    got = report(
        table,
        [
            Q.MinRows(n=4),
            Q.MinRows(n=5),
            Q.NotNull(col="k"),
            Q.Unique(keys=("k",)),
            Q.Unique(keys=("k", "x")),
            Q.InRange(col="x", low=0, high=4),
            Q.NonNegative(col="y"),
            Q.AtLeastEqual(col="y", value=0, n=2),
            Q.AtLeastEqual(col="y", value=0, n=3),
            Q.HasColumn(col="k"),
            Q.HasType(col="y", dtype="int"),
            Q.HasType(col="x", dtype="int"),
            Q.NoColumnContaining(text="PK"),
        ],
    )
    assert got == {
        "min_rows_4": ("volume", 0, True),
        "min_rows_5": ("volume", 1, False),
        "not_null_k": ("completeness", 2, False),
        "unique_k": ("uniqueness", 2, False),
        "unique_k_x": ("uniqueness", 0, True),
        "in_range_x": ("logic", 3, False),
        "non_negative_y": ("anomaly", 1, False),
        "at_least_2_y": ("logic", 0, True),
        "at_least_3_y": ("logic", 1, False),
        "has_column_k": ("schema", 0, True),
        "has_type_y": ("schema", 0, True),
        "has_type_x": ("schema", 1, False),
        "no_column_containing_PK": ("schema", 0, True),
    }


def test_minimum_itself_passes(spark):
    assert report(spark.range(1000), [Q.MinRows(n=1000)])["min_rows_1000"][2]
    assert not report(spark.range(999), [Q.MinRows(n=1000)])["min_rows_1000"][2]


def test_missing_columns_are_schema_violations(spark):
    got = report(spark.range(3), customer.gold_rules(min_rows=1))
    assert got["not_null_customer_id"] == ("schema", 1, False)
    assert got["in_range_tenure_group"] == ("schema", 1, False)
    assert got["has_column_event_timestamp"] == ("schema", 1, False)
    assert got["any_column_vec"] == ("schema", 1, False)
    assert got["min_rows_1"] == ("volume", 0, True)


def test_file_signature_in_the_names(spark):
    broken = spark.createDataFrame([(1,)], ["PK\x03\x04"])
    got = report(broken, customer.bronze_rules())
    assert not got["no_column_containing_PK"][2] and not got["has_column_customerID"][2]


def test_empty_table(spark):
    got = report(spark.range(0), [Q.MinRows(n=1), Q.Unique(keys=("id",)), Q.NotNull(col="id")])
    assert got["min_rows_1"] == ("volume", 1, False)
    assert got["unique_id"] == ("uniqueness", 0, True)


def test_border_of_the_bucket_rule(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (4.0,)], ["tenure_group"])
    loose, strict = customer.gold_rules(), customer.gold_rules(bounds=(0, 3))
    assert report(df, loose)["in_range_tenure_group"][1] == 0
    assert report(df, strict)["in_range_tenure_group"][1] == 1


def test_verdict_and_enforcement(table):
    rules = [Q.NotNull(col="k"), Q.NonNegative(col="y", severity=Q.WARN), Q.MinRows(n=1)]
    verdict = Q.gate_verdict(Q.run_gate(table, rules)).first()
    assert (verdict["passed"], verdict["failed_rules"], verdict["reasons"]) == (
        False,
        1,
        ["not_null_k"],
    )
    with pytest.raises(Q.GateFailed) as failed:
        Q.enforce_gate(Q.run_gate(table, rules))
    assert failed.value.reasons == ["completeness: not_null_k (2)"]
    assert Q.enforce_gate(Q.run_gate(table, rules[1:])) == ["anomaly: non_negative_y (1)"]
    assert Q.gate_verdict(Q.run_gate(table, rules[1:])).first()["passed"]
