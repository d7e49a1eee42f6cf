"""The raw customer snapshot, derived from the ``customer`` table, in Spark
and in SQL. All arithmetic is on integers up to the last division."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_K = "c_custkey"


def _pick(expr: str, cases: dict[int, str], other: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in cases.items())
    return f"CASE {expr} {whens} ELSE '{other}' END"


def _yes_no(m: int) -> str:
    return f"CASE WHEN ({_K} * {m}) % 5 < 2 THEN 'Yes' ELSE 'No' END"


def _service(m: int, none: str) -> str:
    return _pick(f"({_K} * {m}) % 7", {0: none, 1: "Yes", 2: "Yes", 3: "Yes"}, "No")


_CENTS = f"((1825 + ({_K} * 37) % 10051) * ({_K} % 73) + ({_K} * 11) % 997)"
_NET = "No internet service"


def columns(text: str) -> dict[str, str]:
    """Raw column name -> expression; ``text`` is the dialect's string type."""
    return {
        "customerID": "c_name",
        "gender": f"CASE WHEN {_K} % 2 = 0 THEN 'Female' ELSE 'Male' END",
        "SeniorCitizen": f"CAST(CASE WHEN {_K} % 6 = 0 THEN 1 ELSE 0 END AS INT)",
        "Partner": _yes_no(3),
        "Dependents": _yes_no(7),
        "tenure": f"CAST({_K} % 73 AS INT)",
        "PhoneService": _yes_no(11),
        "MultipleLines": _service(2, "No phone service"),
        "InternetService": _pick(f"{_K} % 3", {0: "DSL", 1: "Fiber optic"}, "No"),
        "OnlineSecurity": _service(3, _NET),
        "OnlineBackup": _service(4, _NET),
        "DeviceProtection": _service(5, _NET),
        "TechSupport": _service(6, _NET),
        "StreamingTV": _service(8, _NET),
        "StreamingMovies": _service(9, _NET),
        "Contract": _pick(f"{_K} % 4", {0: "One year", 1: "Two year"}, "Month-to-month"),
        "PaperlessBilling": _yes_no(13),
        "PaymentMethod": "c_mktsegment",
        "MonthlyCharges": f"CAST(1825 + ({_K} * 37) % 10051 AS DOUBLE) / CAST(100 AS DOUBLE)",
        "TotalCharges": (
            f"CASE WHEN {_K} % 73 = 0 THEN ' ' ELSE concat("
            f"CAST(CAST(floor({_CENTS} / 100.0) AS BIGINT) AS {text}), '.', "
            f"lpad(CAST({_CENTS} % 100 AS {text}), 2, '0')) END"
        ),
        "Churn": _yes_no(17),
    }


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    return table.selectExpr(*[f"{e} AS {n}" for n, e in columns("STRING").items()])


RAW_SQL = (
    "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in columns("VARCHAR").items()) + " FROM customer"
)
