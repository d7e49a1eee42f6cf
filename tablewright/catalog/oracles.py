"""The SQL for each query, for an engine that has the test tables as views."""

from __future__ import annotations

from tablewright.catalog import fixture
from tablewright.catalog.queries import AS_OF, SINCE, TABLES, UNTIL
from tablewright.plans import customer

ORACLES: dict[str, str] = {}

# Raw column, its name in snake case, its name in silver. Written
# out here, so that a wrong rule in the library shows.
EXPECTED = (
    ("customerID", "customer_i_d", "customer_id"),
    ("gender", "gender", "gender"),
    ("SeniorCitizen", "senior_citizen", "senior_citizen"),
    ("Partner", "partner", "partner"),
    ("Dependents", "dependents", "dependents"),
    ("tenure", "tenure", "tenure"),
    ("PhoneService", "phone_service", "phone_service"),
    ("MultipleLines", "multiple_lines", "multiple_lines"),
    ("InternetService", "internet_service", "internet_service"),
    ("OnlineSecurity", "online_security", "online_security"),
    ("OnlineBackup", "online_backup", "online_backup"),
    ("DeviceProtection", "device_protection", "device_protection"),
    ("TechSupport", "tech_support", "tech_support"),
    ("StreamingTV", "streaming_t_v", "streaming_tv"),
    ("StreamingMovies", "streaming_movies", "streaming_movies"),
    ("Contract", "contract", "contract"),
    ("PaperlessBilling", "paperless_billing", "paperless_billing"),
    ("PaymentMethod", "payment_method", "payment_method"),
    ("MonthlyCharges", "monthly_charges", "monthly_charges"),
    ("TotalCharges", "total_charges", "total_charges"),
    ("Churn", "churn", "churn"),
)
YES_NO = (
    "partner",
    "dependents",
    "phone_service",
    "paperless_billing",
    "churn",
)
CATEGORIES = (
    "gender",
    "multiple_lines",
    "internet_service",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "contract",
    "payment_method",
)
VIEW_FIELDS = (
    ("tenure_group", "float"),
    ("billing_ratio", "float"),
    ("is_high_value", "bigint"),
    ("avg_historical_charge", "float"),
    ("monthly_charges", "float"),
    ("total_charges", "float"),
    ("tenure", "float"),
    ("senior_citizen", "bigint"),
    ("partner", "bigint"),
    ("dependents", "bigint"),
    ("phone_service", "bigint"),
    ("paperless_billing", "bigint"),
    ("churn", "bigint"),
    ("gender_vec", "array<float>"),
    ("internet_service_vec", "array<float>"),
    ("contract_vec", "array<float>"),
    ("payment_method_vec", "array<float>"),
    ("multiple_lines_vec", "array<float>"),
    ("online_security_vec", "array<float>"),
    ("online_backup_vec", "array<float>"),
    ("device_protection_vec", "array<float>"),
    ("tech_support_vec", "array<float>"),
    ("streaming_tv_vec", "array<float>"),
    ("streaming_movies_vec", "array<float>"),
)
# End of fixed values.

FIXED = {name: silver for name, _, silver in EXPECTED}
NAMES = list(FIXED.values())

SNAKE = "SELECT " + ", ".join(f'"{n}" AS {s}' for n, s in FIXED.items()) + " FROM raw"

NUMBER = "CAST(nullif(trim(total_charges), '') AS DOUBLE)"


def _flag(c: str) -> str:
    return f"CAST(CASE {c} WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS {c}"


def _clean(c: str) -> str:
    if c in YES_NO:
        return _flag(c)
    return f"coalesce({NUMBER}, 0.0) AS total_charges" if c == "total_charges" else c


SILVER = "SELECT " + ", ".join(map(_clean, NAMES)) + " FROM snake"

DERIVED = """
SELECT *, monthly_charges / avg_historical_charge AS billing_ratio,
       CAST(CASE WHEN tenure > 24 AND monthly_charges > 80 THEN 1 ELSE 0 END AS INTEGER)
         AS is_high_value
FROM (SELECT *,
        CAST(CASE WHEN tenure < 12 THEN 0 WHEN tenure < 24 THEN 1
                  WHEN tenure < 48 THEN 2 ELSE 3 END AS DOUBLE) AS tenure_group,
        CASE WHEN tenure = 0 THEN monthly_charges ELSE total_charges / tenure END
          AS avg_historical_charge
      FROM silver)
"""

PAIRS = " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS col, {c} AS label FROM snake" for c in CATEGORIES
)

VOCAB = """
SELECT col, label,
       row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) - 1 AS slot
FROM pairs WHERE label IS NOT NULL GROUP BY col, label
"""

SLOTTED = """
SELECT p.*, z.k, coalesce(v.slot, z.k) AS slot
FROM pairs p JOIN (SELECT col, count(*) AS k FROM vocab GROUP BY col) z ON p.col = z.col
LEFT JOIN vocab v ON p.col = v.col AND p.label = v.label
"""

STEPS = {
    "raw": fixture.RAW_SQL,
    "snake": SNAKE,
    "silver": SILVER,
    "derived": DERIVED,
    "pairs": PAIRS,
    "vocab": VOCAB,
    "slotted": SLOTTED,
}
SCALARS = [n for n in NAMES if n not in CATEGORIES] + [
    "tenure_group",
    "avg_historical_charge",
    "billing_ratio",
    "is_high_value",
]


def over(body: str, **steps: str) -> str:
    """``body`` over the steps up to silver, features and vocabulary."""
    all_steps = {**STEPS, **steps}
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in all_steps.items()) + " " + body


ORACLES["snake_case_columns"] = (
    "SELECT " + ", ".join(f'"{n}" AS {snake}' for n, snake, _ in EXPECTED) + f" FROM ({fixture.RAW_SQL})"
)
ORACLES["fix_acronym_names"] = over("SELECT * FROM snake")
ORACLES["yes_no_to_int"] = over(
    "SELECT customer_id, " + ", ".join(map(_flag, YES_NO)) + " FROM snake"
)
ORACLES["cast_int_flags"] = over(
    "SELECT customer_id, CAST(senior_citizen AS INTEGER) AS senior_citizen FROM snake"
)
ORACLES["blank_to_null_numeric"] = over(
    f"SELECT customer_id, {NUMBER} AS total_charges FROM snake"
)
ORACLES["fill_null"] = over("SELECT customer_id, total_charges FROM silver")
ORACLES["drop_columns"] = over(
    "SELECT " + ", ".join(n for n in NAMES if n not in CATEGORIES) + " FROM snake"
)
ORACLES["select_existing"] = over("SELECT customer_id, tenure, monthly_charges FROM snake")
ORACLES["select_by_suffix"] = over(
    "SELECT customer_id, monthly_charges, total_charges FROM silver"
)
ORACLES["silver"] = over("SELECT * FROM silver")
ORACLES["silver_ingested_twice"] = over(
    "SELECT DISTINCT * FROM (SELECT * FROM silver UNION ALL SELECT * FROM silver)"
)

ORACLES["dedup_by_key"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r
      FROM orders) WHERE r = 1
"""
ORACLES["dedup_rare"] = """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                   ORDER BY l_linenumber, l_quantity, l_shipdate) AS r
      FROM lineitem) WHERE r = 1
"""
ORACLES["dedup_removed"] = """
SELECT count(*) AS rows_in, count(DISTINCT o_custkey) AS rows_out,
       count(*) - count(DISTINCT o_custkey) AS removed FROM orders
"""
ORACLES["distinct_project"] = "SELECT DISTINCT o_custkey FROM orders"
ORACLES["peek"] = over("SELECT customer_id, tenure FROM silver ORDER BY customer_id LIMIT 10")

ORACLES["filter_is_null"] = over(f"SELECT customer_id, tenure FROM snake WHERE {NUMBER} IS NULL")
ORACLES["filter_out_of_range"] = (
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 4000"
)
ORACLES["filter_negative"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"
ORACLES["filter_equals"] = over(
    "SELECT customer_id, total_charges FROM silver WHERE total_charges = 0.0"
)

ORACLES["bucketize"] = over("SELECT customer_id, tenure, tenure_group FROM derived")
ORACLES["guarded_ratio"] = over("SELECT customer_id, avg_historical_charge FROM derived")
ORACLES["billing_ratio"] = over("SELECT customer_id, billing_ratio FROM derived")
ORACLES["conjunction_flag"] = over("SELECT customer_id, is_high_value FROM derived")
ORACLES["gold_features"] = over(f"SELECT {', '.join(SCALARS)} FROM derived")

PART_PAIRS = " UNION ALL ".join(
    f"SELECT p_partkey, '{c}' AS col, CAST({c} AS VARCHAR) AS label FROM part"
    for c in ("p_brand", "p_type", "p_size")
)
ORACLES["label_counts"] = (
    f'SELECT col AS "column", label, count(*) AS n FROM ({PART_PAIRS}) GROUP BY col, label'
)
ORACLES["fit_vocab"] = over(
    'SELECT col AS "column", label, slot FROM vocab'
)
ORACLES["string_index"] = over(
    "SELECT p_partkey, "
    + ", ".join(
        f"CAST(max(CASE WHEN col = '{c}' THEN slot END) AS DOUBLE) AS {c}_idx"
        for c in ("p_brand", "p_type", "p_size")
    )
    + " FROM slotted GROUP BY p_partkey",
    pairs=PART_PAIRS,
)
LINE_PAIRS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS label FROM lineitem"
    for c in ("l_orderkey", "l_suppkey")
)
ORACLES["fit_vocab_unbounded"] = f"""
SELECT col AS "column", label,
       row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) - 1 AS slot
FROM ({LINE_PAIRS}) GROUP BY col, label
"""
ORACLES["string_index_unbounded"] = """
WITH v AS (
  SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) - 1 AS i
  FROM orders WHERE o_totalprice > 250000 GROUP BY o_custkey)
SELECT o.o_orderkey, o.o_custkey,
       CAST(coalesce(v.i, (SELECT count(*) FROM v)) AS DOUBLE) AS o_custkey_idx
FROM orders o LEFT JOIN v ON o.o_custkey = v.o_custkey
"""
ORACLES["encode_many_wide"] = """
WITH l AS (SELECT o_orderkey, CAST(CAST(floor(o_totalprice / 50) AS BIGINT) AS VARCHAR) AS label FROM orders),
v AS (SELECT label, row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS slot
      FROM l WHERE label IS NOT NULL GROUP BY label)
SELECT o_orderkey, (SELECT count(*) FROM v) + 1 AS length,
       coalesce(slot, (SELECT count(*) FROM v)) AS slot, CAST(1 AS BIGINT) AS n_nonzero
FROM l LEFT JOIN v ON l.label = v.label
"""
SLOT_ROWS = """
SELECT {key}, concat(p.col, '_vec') AS "column", CAST(s.i AS INTEGER) AS slot,
       CASE WHEN s.i = p.slot THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS value
FROM slotted p JOIN (SELECT unnest(range(2000)) AS i) s ON s.i <= p.k
"""
ORACLES["one_hot"] = over(
    SLOT_ROWS.format(key="customer_id"),
    pairs="SELECT customer_id, 'internet_service' AS col, nullif(internet_service, 'No') AS label "
    "FROM snake",
)
ORACLES["encode_many"] = over(SLOT_ROWS.format(key="customer_id"))
ORACLES["vector_to_array"] = over(
    SLOT_ROWS.format(key="p_partkey"),
    pairs=" UNION ALL ".join(
        f"SELECT p_partkey, '{c}' AS col, {c} AS label FROM part" for c in ("p_brand", "p_type")
    ),
)
ORACLES["one_hot_sparse"] = ORACLES["one_hot"]
ORACLES["encode_many_vector"] = ORACLES["encode_many"]
ORACLES["encode_many_sparse"] = over(
    "SELECT customer_id, concat(col, '_vec') AS \"column\", k + 1 AS size, slot, "
    "CAST(1 AS DOUBLE) AS value FROM slotted"
)
ORACLES["encode_many_pairs"] = """
WITH l AS (
  SELECT o_orderkey, 'price_band' AS col, CAST(CAST(floor(o_totalprice / 50) AS BIGINT) AS VARCHAR) AS label
  FROM orders UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders),
v AS (SELECT col, label, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) - 1 AS slot
      FROM l WHERE o_orderkey % 3 > 0 AND label IS NOT NULL GROUP BY col, label),
k AS (SELECT col, count(*) AS k FROM v GROUP BY col)
SELECT o_orderkey, concat(l.col, '_vec') AS "column", k + 1 AS size, coalesce(slot, k) AS slot,
       CAST(1 AS DOUBLE) AS value
FROM l JOIN k USING (col) LEFT JOIN v ON l.col = v.col AND l.label = v.label
"""
GROWN = """
WITH l AS (
  SELECT 'o_custkey' AS col, CAST(o_custkey AS VARCHAR) AS label, o_totalprice, o_orderpriority FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, o_totalprice, o_orderpriority FROM orders),
v AS (SELECT col, label, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) - 1 AS slot
      FROM l WHERE o_totalprice < 200000 AND o_orderpriority <> '1-URGENT' GROUP BY col, label)
"""
ORACLES["extend_vocab"] = f"""{GROWN}
SELECT col AS "column", label, slot FROM v
UNION ALL
SELECT col, label, (SELECT count(*) FROM v WHERE v.col = n.col)
       + row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, label) - 1
FROM l n WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.col = n.col AND v.label = n.label) GROUP BY col, label
"""
ORACLES["vocab_changes"] = f"""{GROWN},
d AS (SELECT col, label, count(*) AS n FROM l WHERE o_totalprice >= 200000 GROUP BY col, label)
SELECT coalesce(v.col, d.col) AS "column", coalesce(v.label, d.label) AS label,
       CASE WHEN v.col IS NULL THEN 'new' WHEN d.col IS NULL THEN 'retired' ELSE 'kept' END AS status,
       coalesce(n, 0) AS n
FROM v FULL JOIN d ON v.col = d.col AND v.label = d.label
"""


def _hot(shift: int) -> str:
    return ", ".join(
        f"CAST(max(CASE WHEN col = '{c}' THEN slot END) + {shift} AS BIGINT) AS {c}_vec"
        for c in CATEGORIES
    )


def _wide(scalars: str, shift: int) -> str:
    return over(
        f"SELECT {scalars}, s.* EXCLUDE (customer_id), "
        f"TIMESTAMP '{AS_OF}' AS event_timestamp, TIMESTAMP '{AS_OF}' AS created_timestamp "
        f"FROM derived d JOIN (SELECT customer_id, {_hot(shift)} FROM slotted "
        f"GROUP BY customer_id) s ON d.customer_id = s.customer_id"
    )


LENGTHS = (
    "(SELECT string_agg(CAST(k + 1 AS VARCHAR), ',' ORDER BY col) "
    "FROM (SELECT col, count(*) AS k FROM vocab GROUP BY col)) AS lengths"
)
FILLED = f"'{','.join('1' for _ in CATEGORIES)}' AS filled"
ORACLES["gold"] = _wide(", ".join([*(f"d.{c}" for c in SCALARS), LENGTHS, FILLED]), 0)
ORACLES["stamp_timestamps"] = over(
    f"SELECT customer_id, TIMESTAMP '{AS_OF}' AS event_timestamp, "
    f"TIMESTAMP '{AS_OF}' AS created_timestamp FROM snake"
)

ORACLES["row_count"] = "SELECT count(*) AS n FROM lineitem"
ORACLES["distinct_count"] = "SELECT count(DISTINCT o_custkey) AS n_distinct FROM orders"
ORACLES["duplicate_count"] = """
SELECT sum(n)::BIGINT AS n, count(*) AS n_distinct, (sum(n) - count(*))::BIGINT AS duplicates
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)
"""
ORACLES["null_profile"] = over(
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE "
        + (f'trim("{n}") = \'\'' if n == "TotalCharges" else f'"{n}" IS NULL')
        + f') AS "{n}"'
        for n in FIXED
    )
    + " FROM raw"
)
LINEITEM = (
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
)
ORACLES["row_count_footers"] = ORACLES["row_count"]
ORACLES["null_profile_footers"] = (
    "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c, _ in LINEITEM) + " FROM lineitem"
)
ORACLES["schema_profile"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type, "
    f"count({c}) AS non_null FROM lineitem"
    for i, (c, t) in enumerate(LINEITEM)
)


def _stats(col: str, source: str) -> str:
    v = f"CAST({col} AS DOUBLE)"
    return (
        f"SELECT '{col}' AS \"column\", count({col}) AS count, round(avg({v}), 6) AS mean, "
        f"round(stddev_samp({v}), 6) AS stddev, min({v}) AS min, max({v}) AS max FROM {source}"
    )


ORACLES["describe_stats"] = " UNION ALL ".join(
    _stats(c, "lineitem") for c, t in LINEITEM if t in ("bigint", "int", "double")
)
ORACLES["describe_billing_ratio"] = over(_stats("billing_ratio", "derived"))


ORACLES["describe_quartiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_partkey")
    for p in (0.25, 0.5, 0.75)
)


def _gate(rows: list[tuple[str, str, str, str, str]]) -> str:
    """(rule, kind, severity, violations, source) per line."""
    return " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{k}' AS kind, '{s}' AS severity, "
        f"CAST({v} AS BIGINT) AS violations, ({v}) = 0 AS passed FROM {t}"
        for r, k, s, v, t in rows
    )


def _gold_gate(source: str, min_rows: int, vectors: int) -> list[tuple[str, str, str, str, str]]:
    keys = "(count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END))"
    rows = [
        (f"min_rows_{min_rows}", "volume", f"greatest({min_rows} - count(*), 0)"),
        ("not_null_customer_id", "completeness", "count(*) FILTER (WHERE customer_id IS NULL)"),
        ("has_column_event_timestamp", "schema", "count(*) * 0"),
        (
            "not_null_event_timestamp",
            "completeness",
            "count(*) FILTER (WHERE event_timestamp IS NULL)",
        ),
        ("unique_customer_id", "uniqueness", f"count(*) - {keys}"),
        ("has_column_tenure_group", "schema", "count(*) * 0"),
        (
            "in_range_tenure_group",
            "logic",
            "count(*) FILTER (WHERE tenure_group < 0 OR tenure_group > 4)",
        ),
        ("has_column_billing_ratio", "schema", "count(*) * 0"),
        ("non_negative_billing_ratio", "anomaly", "count(*) FILTER (WHERE billing_ratio < 0)"),
        ("any_column_vec", "schema", f"count(*) * 0 + {vectors}"),
    ]
    return [(r, k, "error", v, source) for r, k, v in rows]


STAMPED = f"SELECT *, TIMESTAMP '{AS_OF}' AS event_timestamp FROM derived"
BROKEN = """
SELECT CASE WHEN tenure <> 7 THEN customer_id END AS customer_id,
       CASE WHEN tenure = 9 THEN 5.0 ELSE tenure_group END AS tenure_group,
       CASE WHEN tenure = 11 THEN -billing_ratio ELSE billing_ratio END AS billing_ratio,
       CASE WHEN tenure <> 13 THEN event_timestamp END AS event_timestamp, is_high_value
FROM stamped
"""
FAULTY = {
    "stamped": STAMPED,
    "broken": BROKEN,
    "faulty": "SELECT * FROM broken UNION ALL SELECT * FROM broken WHERE is_high_value = 1",
}
ORACLES["quality_gate"] = over(_gate(_gold_gate("stamped", 1000, 0)), stamped=STAMPED)
ORACLES["quality_gate_faulty"] = over(_gate(_gold_gate("faulty", 1_000_000, 1)), **FAULTY)
ORACLES["gate_verdict"] = over(
    "SELECT count(*) = 0 AS passed, count(*) AS failed_rules, "
    f"string_agg(rule, ',' ORDER BY rule) AS reasons FROM ({_gate(_gold_gate('faulty', 1000, 1))}) "
    "WHERE NOT passed",
    **FAULTY,
)
ORACLES["bronze_silver_checks"] = over(
    _gate(
        [
            ("no_column_containing_PK", "schema", "error", "count(*) * 0", "raw"),
            ("has_column_customerID", "schema", "warn", "count(*) * 0", "raw"),
            (
                "not_null_total_charges",
                "completeness",
                "error",
                "count(*) FILTER (WHERE total_charges IS NULL)",
                "silver",
            ),
            (
                "at_least_11_total_charges",
                "logic",
                "warn",
                "greatest(11 - count(*) FILTER (WHERE total_charges = 0.0), 0)",
                "silver",
            ),
            ("has_type_senior_citizen", "schema", "warn", "count(*) * 0", "silver"),
            ("has_type_churn", "schema", "warn", "count(*) * 0", "silver"),
        ]
    )
)

ORACLES["bronze_silver_checks_faulty"] = over(
    _gate(
        [
            ("no_column_containing_PK", "schema", "error", "count(*) * 0 + 1", "raw"),
            ("has_column_customerID", "schema", "warn", "count(*) * 0 + 1", "raw"),
            (
                "not_null_total_charges",
                "completeness",
                "error",
                "count(*) FILTER (WHERE tenure IN (0, 7))",
                "silver",
            ),
            (
                "at_least_11_total_charges",
                "logic",
                "warn",
                "greatest(11 - count(*) FILTER (WHERE total_charges = 0.0 AND tenure NOT IN (0, 7)), 0)",
                "silver",
            ),
            ("has_type_senior_citizen", "schema", "warn", "count(*) * 0 + 1", "silver"),
            ("has_type_churn", "schema", "warn", "count(*) * 0 + 1", "silver"),
        ]
    )
)

ORACLES["coercion_gate"] = over(
    _gate(
        [
            ("min_rows_1", "volume", "error", "greatest(1 - count(*), 0)", "raw"),
            *[
                (f"few_coerced_{c}", "coercion", "error", "count(*) * 0", "raw")
                for c in ("churn", "dependents", "paperless_billing", "phone_service")
            ],
            (
                "few_coerced_partner",
                "coercion",
                "error",
                "greatest(count(*) FILTER (WHERE tenure % 7 = 3) - 10, 0)",
                "raw",
            ),
            (
                "few_coerced_total_charges",
                "coercion",
                "error",
                "greatest(count(*) FILTER (WHERE tenure % 9 = 5) - 10, 0)",
                "raw",
            ),
        ]
    )
)
ORACLES["src_tabular_kept"] = f"SELECT * FROM ({fixture.RAW_SQL}) WHERE tenure % 10 NOT IN (3, 6, 8)"
ORACLES["src_tabular_quarantined"] = f"""
SELECT "customerID" AS customer_id,
       CAST(CASE tenure % 10 WHEN 3 THEN 2 WHEN 6 THEN 22 ELSE 21 END AS INTEGER) AS n_cells
FROM ({fixture.RAW_SQL}) WHERE tenure % 10 IN (3, 6, 8)
"""
ORACLES["volume_gate_footers"] = _gate(
    [
        ("min_rows_1000", "volume", "error", "greatest(1000 - count(*), 0)", "events"),
        ("not_null_event_id", "completeness", "error", "count(*) - count(event_id)", "events"),
        ("not_null_ts", "completeness", "error", "count(*) - count(ts)", "events"),
        ("has_column_value", "schema", "error", "count(*) * 0", "events"),
    ]
)

SQL_TYPES = {"float": "FLOAT", "bigint": "BIGINT"}
ORACLES["feature_view_project"] = _wide(
    "d.customer_id, "
    + ", ".join(
        f"CAST(d.{c} AS {SQL_TYPES[t]}) AS {c}" for c, t in VIEW_FIELDS if t in SQL_TYPES
    ),
    1,
)


def _found(c: str) -> str:
    if c == "customer_id":
        return "string"
    if c.endswith("_vec"):
        return "array<double>"
    if c.endswith("_timestamp"):
        return "timestamp"
    doubles = ("charges", "ratio", "charge", "group")
    return "double" if c.endswith(doubles) else "int"


def _contract(c: str, declared: str) -> str:
    source = c.removesuffix("_vec") if c not in SCALARS else c
    counted = "count(*)" if c.endswith("_timestamp") else f"count({source})"
    status = "ok" if _found(c) == declared else "cast"
    return (
        f"SELECT '{c}' AS field, '{declared}' AS declared, '{_found(c)}' AS actual, "
        f"'{status}' AS status, {counted} AS non_null, CAST(0 AS BIGINT) AS lost FROM derived"
    )


ORACLES["feature_view_apply"] = over(
    " UNION ALL ".join(
        _contract(c, t)
        for c, t in [
            ("customer_id", "string"),
            *VIEW_FIELDS,
            ("event_timestamp", "timestamp"),
            ("created_timestamp", "timestamp"),
        ]
    )
)
ORACLES["feature_view_mismatches"] = over(
    """
    SELECT 'contract_vec' AS field, 'array<float>' AS declared, CAST(NULL AS VARCHAR) AS actual,
           'missing' AS status, CAST(0 AS BIGINT) AS non_null, CAST(0 AS BIGINT) AS lost
    UNION ALL
    SELECT 'is_high_value', 'bigint', 'string', 'cast', count(*), count(*) FROM derived
    UNION ALL
    SELECT * FROM (
      SELECT 'total_charges', 'float', 'double', 'cast', count(*),
             count(*) FILTER (WHERE total_charges * 1e36 > 3.4028235677973366e38) AS lost
      FROM derived) WHERE lost > 0
    """
)

HISTORY = """
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, ts AS created, event_type, value
FROM events
"""


def _latest(where: str) -> str:
    return f"""
    SELECT user_id, event_type, value, day, created
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY day DESC, created DESC, event_type DESC, value DESC) AS r
          FROM ({HISTORY}) WHERE {where}) WHERE r = 1
    """


ORACLES["materialize_latest"] = _latest(f"day <= TIMESTAMP '{UNTIL}'")
ORACLES["materialize_incremental"] = _latest(f"day <= TIMESTAMP '{UNTIL}'")
ORACLES["materialize_incremental_stream"] = _latest("TRUE")
ORACLES["materialize_late"] = _latest(f"day <= TIMESTAMP '{UNTIL}'")
ORACLES["materialize_repeated"] = _latest(f"day <= TIMESTAMP '{UNTIL}'")
ORACLES["materialize_stream_restart"] = _latest("TRUE")
ORACLES["online_lookup"] = f"""
SELECT c.c_custkey AS user_id, s.event_type, s.value
FROM customer c LEFT JOIN ({_latest(f"day <= TIMESTAMP '{UNTIL}'")}) s ON c.c_custkey = s.user_id
"""

ORACLES["online_lookup_ttl"] = f"""
SELECT c.c_custkey AS user_id, s.event_type, s.value, s.day
FROM customer c LEFT JOIN (
    SELECT * FROM ({_latest(f"day <= TIMESTAMP '{UNTIL}'")})
    WHERE day >= TIMESTAMP '{UNTIL}' - INTERVAL 2 DAY
) s ON c.c_custkey = s.user_id
"""


def _as_of(events: str) -> str:
    return f"""
    WITH e AS ({events}),
    bought AS (SELECT event_id, user_id, ts FROM e WHERE event_type = 'purchase'),
    seen AS (SELECT user_id, ts AS viewed, event_id AS view_id, value AS view_value
             FROM e WHERE event_type = 'view')
    SELECT event_id, user_id, ts,
           CASE WHEN fresh THEN view_id END AS view_id,
           CASE WHEN fresh THEN view_value END AS view_value,
           CASE WHEN fresh THEN viewed END AS viewed
    FROM (SELECT b.event_id, b.user_id, b.ts, s.viewed, s.view_id, s.view_value,
                 s.viewed >= b.ts - INTERVAL 7 DAY AS fresh
          FROM bought b ASOF LEFT JOIN seen s
          ON b.user_id = s.user_id AND b.ts >= s.viewed)
    """


ORACLES["point_in_time_join"] = _as_of("SELECT * FROM events")
ORACLES["point_in_time_join_hot"] = _as_of(
    "SELECT event_id, ts, event_type, value, "
    "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id FROM events"
)
ORACLES["point_in_time_join_hot_many"] = _as_of(
    "SELECT event_id, ts, event_type, value, "
    "CASE WHEN event_id % 7 < 5 THEN -1 - dayofyear(ts) % 5 ELSE user_id END AS user_id FROM events"
)



def _as_of_views(events: str) -> str:
    def last(kind: str, key: str) -> str:
        return (
            f"(SELECT {key}, ts AS at, event_id AS {kind}_id, value AS {kind}_value "
            f"FROM e WHERE event_type = '{kind}')"
        )

    return f"""
    WITH e AS (SELECT *, user_id % 10 AS cell FROM ({events})),
    bought AS (SELECT event_id, user_id, cell, ts FROM e WHERE event_type = 'purchase')
    SELECT b.event_id, b.user_id, b.cell, b.ts,
           CASE WHEN v.at >= b.ts - INTERVAL 7 DAY THEN v.view_id END AS view_id,
           CASE WHEN v.at >= b.ts - INTERVAL 7 DAY THEN v.view_value END AS view_value,
           c.click_id, c.click_value, c.at AS clicked,
           CASE WHEN r.at >= b.ts - INTERVAL 1 HOUR THEN r.error_id END AS error_id,
           CASE WHEN r.at >= b.ts - INTERVAL 1 HOUR THEN r.error_value END AS error_value
    FROM bought b
    ASOF LEFT JOIN {last("view", "user_id")} v ON b.user_id = v.user_id AND b.ts >= v.at
    ASOF LEFT JOIN {last("click", "user_id")} c ON b.user_id = c.user_id AND b.ts >= c.at
    ASOF LEFT JOIN {last("error", "cell")} r ON b.cell = r.cell AND b.ts >= r.at
    """


ORACLES["point_in_time_join_views"] = _as_of_views("SELECT event_id, ts, event_type, value, user_id FROM events")
ORACLES["point_in_time_join_views_hot"] = _as_of_views(
    "SELECT event_id, ts, event_type, value, "
    "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id FROM events"
)

ARRIVING = _latest(f"day <= TIMESTAMP '{UNTIL}'").replace(
    "ts AS created", "CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 30 DAY ELSE ts END AS created"
)
ORACLES["refresh_store"] = ARRIVING
ORACLES["lookup_store"] = f"""
SELECT c.c_custkey AS user_id, s.event_type, s.value, s.day
FROM customer c LEFT JOIN ({ARRIVING}) s ON c.c_custkey = s.user_id WHERE c.c_custkey % 20 = 0
"""

ORACLES["src_tabular"] = fixture.RAW_SQL
ORACLES["src_bronze"] = fixture.RAW_SQL
ORACLES["src_silver"] = over("SELECT * FROM silver")
ORACLES["src_gold"] = ORACLES["gold"]
ORACLES["src_feature"] = HISTORY
ORACLES["sink_table"] = over("SELECT * FROM snake")
ORACLES["sink_gold"] = ORACLES["gold"]
ORACLES["sink_dated"] = """
SELECT event_id, user_id, ts, CASE WHEN day(ts) <= 15 THEN -value ELSE value END AS value,
       CAST(ts AS DATE) AS event_date FROM events
"""
ORACLES["materialize_dated"] = _latest(f"day > TIMESTAMP '{SINCE}' AND day <= TIMESTAMP '{UNTIL}'")
ORACLES["raw_file_audit"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '50415231' AS header_hex, FALSE AS is_zip" for t in TABLES
)

# No customer lacks a feature, and the model beats a coin on held-out rows.
ORACLES["train_eval"] = """
SELECT count(*) FILTER (NOT test) AS n_train, count(*) FILTER (test) AS n_test,
       0::BIGINT AS n_skipped, TRUE AS above_half
FROM (SELECT ('0x' || substr(md5(c_name), 1, 8))::BIGINT % 100 < 20 AS test FROM customer)
"""

# The model separates the classes, so what it predicts is the label.
ORACLES["cross_validate"] = """
SELECT CAST(('0x' || substr(md5(c_name), 1, 8))::BIGINT % 5 AS INTEGER) AS fold,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, label AS predicted,
       count(*) AS n
FROM customer GROUP BY ALL
"""
