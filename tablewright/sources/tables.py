"""Stored tables: read, full overwrite, and published snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.naming import quoted

LOG = "published"


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    return spark.read.format(fmt).options(**(options or {})).load(path)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table for counts. Row counts, filled values, and greatest and
    least numbers are answered from the footers of its files: the aggregate is
    pushed into the scan, which then reads no column. Any other use works as
    well and reads the data. The DataFrame belongs to a session of its own with
    the reader that can do this, as the setting holds for all reads of one."""
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    *,
    only_partitions: bool = False,
) -> None:
    """Write the whole table; by default a second run replaces the first. The
    path must not be one that ``df`` reads. With ``only_partitions`` an overwrite
    replaces the partitions that ``df`` has rows of and leaves the others."""
    if only_partitions and not partition_by:
        raise ValueError("only_partitions needs columns to partition by")
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_dated(
    df: DataFrame, path: str, event: str, date_column: str = "event_date", fmt: str = "parquet"
) -> None:
    """Write rows by the day of their event time: a run replaces the days that
    it has rows of, so repeating it changes nothing and other days stay. Rows without a time are a day of their own.
    A source that names ``date_column`` (``FeatureSource.date_partition``) is
    read by days."""
    dated = df.withColumn(date_column, F.to_date(F.col(quoted(event))))
    write_table(dated, path, fmt, partition_by=[date_column], only_partitions=True)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", **kwargs) -> int:
    """Write and return the number of rows, counted by the write itself. It is
    meant for the log: a stage that runs again after a lost executor counts
    its rows again."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), path, fmt, **kwargs)
    return seen.get["n"]


def publish_snapshot(
    df: DataFrame, root: str, version: str, until: str | datetime, fmt: str = "parquet"
) -> str:
    """Write ``df`` as a new version under ``root``, then add one line to the
    list of published versions. Readers see a version only when its data is
    complete, and a published version is never written again; what a failed
    attempt left under its name is."""
    spark, text = df.sparkSession, instant(until)
    if is_published(spark, root, version):
        raise ValueError(f"version {version} is published already")
    path = f"{root.rstrip('/')}/v-{version}"
    write_table(df, path, fmt)
    line = spark.range(1).select(
        F.lit(version).alias("version"),
        F.lit(text).alias("until"),
        F.lit(fmt).alias("format"),
        F.current_timestamp().alias("published"),
    )
    line.write.mode("append").json(f"{root.rstrip('/')}/{LOG}")
    return path


def instant(value: str | datetime) -> str:
    """A point in time as text of one form, so that texts sort as times do.
    Offsets are turned into UTC."""
    if not isinstance(value, datetime):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value.isoformat(sep=" ")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark opens."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per publication, or None before the first."""
    path = f"{root.rstrip('/')}/{LOG}"
    if not path_exists(spark, path):
        return None
    return spark.read.schema("version string, until string, format string, published timestamp").json(path)


def is_published(spark: SparkSession, root: str, version: str) -> bool:
    log = _log(spark, root)
    return log is not None and bool(log.where(F.col("version") == version).head(1))


def current_snapshot(spark: SparkSession, root: str) -> tuple[DataFrame, str, str] | None:
    """The newest published (table, until, version), or None before the first."""
    log = _log(spark, root)
    newest = [] if log is None else log.orderBy(F.desc("published"), F.desc("version")).head(1)
    for row in newest:
        path = f"{root.rstrip('/')}/v-{row['version']}"
        return read_table(spark, path, row["format"]), row["until"], row["version"]
    return None
