"""Preset: the customer snapshot with its silver rules, gold features, gate
and feature view. Every operator takes these values as parameters."""

from __future__ import annotations

from datetime import timedelta

from tablewright.operators.cleaning import CleanSpec
from tablewright.operators.quality import (
    WARN,
    AnyColumnWithSuffix,
    AtLeastEqual,
    HasColumn,
    HasType,
    InRange,
    MinRows,
    NoColumnContaining,
    NonNegative,
    NotNull,
    Unique,
)
from tablewright.operators.views import Entity, FeatureSource, FeatureView, Field
from tablewright.plans.layers import FeatureSpec, RatioSpec

# Column names, bounds and types that the tables must have.
KEY = "customer_id"
RAW_KEY = "customerID"
NAME_FIXES = {"customer_i_d": "customer_id", "streaming_t_v": "streaming_tv"}
YES_NO = ("partner", "dependents", "phone_service", "paperless_billing", "churn")
INT_FLAGS = ("senior_citizen",)
TEXT_NUMBERS = ("total_charges",)
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
TENURE_SPLITS = (0, 12, 24, 48, float("inf"))
HIGH_VALUE = {"tenure": 24, "monthly_charges": 80}
MIN_ROWS = 1000
BUCKET_BOUNDS = (0, 4)
MIN_ZERO_CHARGES = 11
TTL = timedelta(days=3650)
FLOAT, LONG, FLOATS = "float", "bigint", "array<float>"
VIEW_FIELDS = (
    ("tenure_group", FLOAT),
    ("billing_ratio", FLOAT),
    ("is_high_value", LONG),
    ("avg_historical_charge", FLOAT),
    ("monthly_charges", FLOAT),
    ("total_charges", FLOAT),
    ("tenure", FLOAT),
    ("senior_citizen", LONG),
    ("partner", LONG),
    ("dependents", LONG),
    ("phone_service", LONG),
    ("paperless_billing", LONG),
    ("churn", LONG),
    ("gender_vec", FLOATS),
    ("internet_service_vec", FLOATS),
    ("contract_vec", FLOATS),
    ("payment_method_vec", FLOATS),
    ("multiple_lines_vec", FLOATS),
    ("online_security_vec", FLOATS),
    ("online_backup_vec", FLOATS),
    ("device_protection_vec", FLOATS),
    ("tech_support_vec", FLOATS),
    ("streaming_tv_vec", FLOATS),
    ("streaming_movies_vec", FLOATS),
)
# End of fixed values.

CLEAN = CleanSpec(
    keys=(KEY,),
    fixes=NAME_FIXES,
    yes_no=YES_NO,
    int_flags=INT_FLAGS,
    numbers=TEXT_NUMBERS,
    fill=0.0,
)

FEATURES = FeatureSpec(
    bucket_col="tenure",
    bucket_splits=TENURE_SPLITS,
    bucket_out="tenure_group",
    average=RatioSpec("total_charges", "tenure", "avg_historical_charge", "monthly_charges"),
    ratio=RatioSpec("monthly_charges", "avg_historical_charge", "billing_ratio"),
    above=HIGH_VALUE,
    above_out="is_high_value",
    categories=CATEGORIES,
)


def bronze_rules() -> list:
    return [NoColumnContaining(text="PK"), HasColumn(col=RAW_KEY, severity=WARN)]


def silver_rules(min_zeros: int = MIN_ZERO_CHARGES) -> list:
    return [
        NotNull(col="total_charges"),
        AtLeastEqual(col="total_charges", value=0.0, n=min_zeros, severity=WARN),
        HasType(col="senior_citizen", dtype="int", severity=WARN),
        HasType(col="churn", dtype="int", severity=WARN),
    ]


def gold_rules(min_rows: int = MIN_ROWS, bounds: tuple[float, float] = BUCKET_BOUNDS) -> list:
    """The upper bucket bound equals the number of buckets, one above the
    greatest index; pass ``bounds=(0, 3)`` for the strict test."""
    return [
        MinRows(n=min_rows),
        NotNull(col=KEY),
        HasColumn(col="event_timestamp"),
        NotNull(col="event_timestamp"),
        Unique(keys=(KEY,)),
        HasColumn(col="tenure_group"),
        InRange(col="tenure_group", low=bounds[0], high=bounds[1]),
        HasColumn(col="billing_ratio"),
        NonNegative(col="billing_ratio"),
        AnyColumnWithSuffix(suffix="_vec"),
    ]


def feature_view(path: str = "", fmt: str = "parquet") -> FeatureView:
    return FeatureView(
        name="customer_features",
        entities=(Entity(KEY, "string", "Unique id of the customer"),),
        fields=tuple(Field(name, dtype) for name, dtype in VIEW_FIELDS),
        source=FeatureSource(path=path, format=fmt),
        ttl=TTL,
    )
