"""Session building and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.naming import quoted

# The planner settings every job here relies on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def delta_conf() -> dict[str, str]:
    """Settings that switch on the Delta connector when its jar is present."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def s3a_conf(
    endpoint: str,
    *,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Settings for an S3-compatible store. Keys are inputs, never defaults:
    leave them out to use the credential providers of the cluster."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def sizing_conf(input_bytes: int, *, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle width for an input of this size.

    One shuffle partition per ``partition_bytes``; adaptive execution merges
    the small ones, so rounding up is cheap and rounding down spills.
    """
    partitions = max(8, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(
    conf: dict[str, str] | None = None, *, app_name: str = "tablewright", master: str | None = None
) -> SparkSession:
    """One session builder for every job; storage and sizing come in as ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Temporary folders of local sessions that name none, by application.
_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share for checkpoints and written tables.

    It is the one named by ``spark.checkpoint.dir``. Only a local session,
    where there is just one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    if context.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[context.applicationId] = tempfile.mkdtemp(prefix="tablewright-")
    return _LOCAL_SCRATCH[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def through_storage(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: later uses
    neither compute them again nor see other values, even if executors are
    lost in between."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> bool:
    """Whether a side is small enough to send to every task, by counting all its
    rows and bytes; each task sends one row of sums."""
    width = " + ".join(f"coalesce(octet_length(CAST({quoted(c)} AS STRING)), 0)" for c in df.columns)
    size = (
        df.selectExpr(f"{width} AS width")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("width"), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["n"] <= max_rows and size["bytes"] <= max_bytes
