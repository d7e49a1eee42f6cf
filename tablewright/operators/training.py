"""Training and scoring a model on a served feature table with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted
from tablewright.session import scratch_path, through_storage


def _hashed(keys: Sequence[str]) -> Column:
    """The MD5 of a key as a number of 32 bits."""
    text = F.concat_ws("|", *[F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def holdout(keys: Sequence[str], percent: int) -> Column:
    """Whether a row belongs to the test part: by the MD5 of its key, so the
    same entity is on the same side in every run and on every cluster."""
    return _hashed(keys) % 100 < percent


def fold_of(keys: Sequence[str], folds: int) -> Column:
    """The fold of a row, from 0 up, by the same hash of its key."""
    return (_hashed(keys) % folds).cast("int")


def _prepared(
    df: DataFrame, label: str, keys: Sequence[str], features: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Keys, label, inputs and whether a row can be used. Arrays become vectors;
    vectors, such as sparse ones of an encoder, are taken as they are."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.linalg import VectorUDT

    ready, usable = df, F.col(quoted(label)).isNotNull()
    for name in features:
        col, kind = F.col(quoted(name)), df.schema[name].dataType
        usable &= col.isNotNull()
        if isinstance(kind, T.ArrayType):
            values = col.cast("array<double>")
            usable &= ~F.exists(values, lambda x: x.isNull() | F.isnan(x))
            ready = ready.withColumn(f"__{name}", array_to_vector(values))
        elif isinstance(kind, VectorUDT):
            ready = ready.withColumn(f"__{name}", col)
        else:
            usable &= ~F.isnan(col.cast("double"))
            ready = ready.withColumn(f"__{name}", col.cast("double"))
    inputs = [f"__{name}" for name in features]
    return ready.select(
        *map(quoted, keys),
        F.col(quoted(label)).cast("double").alias("__label"),
        *map(quoted, inputs),
        F.coalesce(usable, F.lit(False)).alias("__usable"),
    ), inputs


def _fitted(train: DataFrame, inputs: Sequence[str], reg: float, max_iter: int):
    """A logistic regression, stored in the shared folder and loaded from there:
    a freshly fitted one still holds its training session, which cannot be sent
    to tasks once the session has observed a write."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    path = scratch_path(train.sparkSession, "model")
    Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="__features", handleInvalid="error"),
            LogisticRegression(
                featuresCol="__features",
                labelCol="__label",
                predictionCol="__prediction",
                regParam=reg,
                maxIter=max_iter,
            ),
        ]
    ).fit(train).write().save(path)
    return PipelineModel.load(path)


def train_eval(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    features: Sequence[str],
    *,
    test_percent: int = 20,
    reg: float = 0.01,
    max_iter: int = 50,
):
    """Fit a logistic regression and score it on the held-out keys. Returns
    the model and (n_train, n_test, n_skipped, accuracy). Rows without label
    or with a NULL or NaN feature cannot be used: they are counted as skipped.
    """
    ready, inputs = _prepared(df, label, keys, features)
    ready = ready.withColumn("__test", holdout(keys, test_percent))
    skipped = ready.agg(F.count_if(~F.col("__usable")).alias("n_skipped")).first()["n_skipped"]
    ready = ready.where("__usable").drop("__usable")
    model = _fitted(ready.where(~F.col("__test")), inputs, reg, max_iter)
    hit = (F.col("__prediction") == F.col("__label")).cast("double")
    scored = model.transform(ready).agg(
        F.count_if(~F.col("__test")).alias("n_train"),
        F.count_if("__test").alias("n_test"),
        F.lit(skipped).cast("long").alias("n_skipped"),
        F.avg(F.when(F.col("__test"), hit)).alias("accuracy"),
    )
    return model, scored


def cross_validate(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    features: Sequence[str],
    *,
    folds: int = 5,
    reg: float = 0.01,
    max_iter: int = 50,
) -> DataFrame:
    """(keys, fold, label, predicted): every usable row as predicted by the model
    of its fold, which was fitted on the rows of all others. Folds go by the hash
    of the key, so an entity is in one fold only, in every run and on every
    cluster. The inputs are stored once for all fits and the predictions of a
    fold once it is scored, so reading them fits nothing again. A fold whose
    other rows hold no row at all predicts NULL.
    """
    ready, inputs = _prepared(df, label, keys, features)
    ready = through_storage(
        ready.where("__usable").drop("__usable").withColumn("__fold", fold_of(keys, folds)),
        "fold-inputs",
    )
    out = None
    for fold in range(folds):
        mine = ready.where(F.col("__fold") == fold)
        others = ready.where(F.col("__fold") != fold)
        if others.isEmpty():
            scored = mine.withColumn("__prediction", F.lit(None).cast("double"))
        else:
            scored = _fitted(others, inputs, reg, max_iter).transform(mine)
        scored = through_storage(
            scored.select(
                *map(quoted, keys),
                F.col("__fold").alias("fold"),
                F.col("__label").alias("label"),
                F.col("__prediction").alias("predicted"),
            ),
            "fold-predictions",
        )
        out = scored if out is None else out.unionAll(scored)
    return out


def confusion(predictions: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    """(by, label, predicted, n): exact counts of every cell that occurs."""
    return predictions.groupBy(*map(quoted, by), "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def scores(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, accuracy, precision, recall) for the label 1; a ratio without
    cases is NULL. One aggregation over the predictions."""
    hit = F.count_if((F.col("label") == 1) & (F.col("predicted") == 1))
    return predictions.groupBy(*map(quoted, by)).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.count_if(F.col("label") == F.col("predicted")), F.count(F.lit(1))).alias("accuracy"),
        F.try_divide(hit, F.count_if(F.col("predicted") == 1)).alias("precision"),
        F.try_divide(hit, F.count_if(F.col("label") == 1)).alias("recall"),
    )
