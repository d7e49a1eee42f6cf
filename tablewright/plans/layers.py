"""The layers as lazy plans: bronze to silver to gold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame

from tablewright.functions import expressions as X
from tablewright.operators.cleaning import CleanSpec, clean
from tablewright.operators.columns import conjunction_flag, stamp_timestamps
from tablewright.operators.encoding import Vocabulary, encode_many, fit_vocab
from tablewright.operators.features import bucketize, guarded_ratio, plain_ratio


@dataclass(frozen=True)
class RatioSpec:
    """``num / den``; with ``when_zero``, that column where ``den`` is 0."""

    num: str
    den: str
    out: str
    when_zero: str | None = None


@dataclass(frozen=True)
class FeatureSpec:
    bucket_col: str
    bucket_splits: tuple[float, ...]
    bucket_out: str
    average: RatioSpec
    ratio: RatioSpec
    above: Mapping[str, float] = field(default_factory=dict)
    above_out: str = "flag"
    categories: tuple[str, ...] = ()
    max_labels: int | None = None
    on_error: str = X.RAISE


def silver(bronze: DataFrame, spec: CleanSpec) -> DataFrame:
    """Clean names, flags and numbers; one row per key."""
    return clean(bronze, spec)


def derive(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The numeric features: one projection."""
    df = bucketize(df, spec.bucket_col, spec.bucket_splits, spec.bucket_out, spec.on_error)
    for r in (spec.average, spec.ratio):
        if r.when_zero is None:
            df = plain_ratio(df, r.num, r.den, r.out, spec.on_error)
        else:
            df = guarded_ratio(df, r.num, r.den, r.when_zero, r.out, spec.on_error)
    return conjunction_flag(df, spec.above, spec.above_out)


def gold(
    silver_df: DataFrame,
    spec: FeatureSpec,
    *,
    vocab: Vocabulary | None = None,
    as_of: str | datetime | None = None,
) -> DataFrame:
    """Features, one-hot vectors and timestamps, without a shuffle unless a
    vocabulary is too large to broadcast. Without a saved ``vocab`` the labels
    are learned here, in one narrow pass."""
    if vocab is None:
        vocab = fit_vocab(silver_df, spec.categories, spec.max_labels)
    df = encode_many(derive(silver_df, spec), vocab, spec.categories)
    return stamp_timestamps(df, as_of=as_of)
