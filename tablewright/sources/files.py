"""Raw files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted
from tablewright.session import scratch_path
from tablewright.sources.prefix import file_prefixes
from tablewright.sources.tables import read_table, write_table

# Reader options per format for a file with a header line, types taken from
# the data, and empty cells read as NULL.
TABULAR_OPTIONS = {
    "csv": {"header": "true", "inferSchema": "true"},
    "excel": {
        "header": "true",
        "inferSchema": "true",
        "treatEmptyValuesAsNulls": "true",
        "addColorColumns": "false",
    },
}

# First bytes of a zip container, which every .xlsx workbook is.
ZIP_HEADER = "504B0304"


def read_tabular(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A header-bearing file of any format on the class path (csv, json, orc
    and parquet are built in; ``excel`` needs its connector). Give a
    ``schema`` for large inputs: inferring types reads the file once more."""
    settings = {**TABULAR_OPTIONS.get(fmt, {}), **(options or {})}
    reader = spark.read.format(fmt)
    if schema is not None:
        settings.pop("inferSchema", None)
        reader = reader.schema(schema)
    return reader.options(**settings).load(path)


# Where a reader puts the text of a row that does not fit the schema, and the
# column that tells such rows apart in a table of both.
CORRUPT, QUARANTINED, ORIGIN = "corrupt_record", "quarantined", "source_file"


def infer_schema(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    sample_lines: int = 1_000,
) -> T.StructType:
    """The types of a line-based file, from its first ``sample_lines`` lines
    alone: the data is not read a second time for them. Rows further on that do
    not fit are for :func:`quarantined`."""
    lines = spark.read.text(path).limit(sample_lines).collect()
    sample = scratch_path(spark, "sample")
    spark.createDataFrame([(r[0],) for r in lines], "value string").coalesce(1).write.text(sample)
    return read_tabular(spark, sample, fmt, options=options).schema


def quarantined(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows of a csv or json file with three columns more: whether the row
    does not fit the schema (``quarantined``), its text if so, and its file. A
    value that is not of its column's type and a row with more or fewer cells
    than columns do not fit; nothing is dropped and nothing fails. Without a
    ``schema`` the types come from the first lines."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"{fmt} has no rows that can fail on their own")
    schema = infer_schema(spark, path, fmt, options) if schema is None else schema
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    clash = [c for c in schema.names if c.lower() in (CORRUPT, QUARANTINED, ORIGIN)]
    if clash:
        raise ValueError(f"the file has columns {clash} of its own")
    settings = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = read_tabular(spark, path, fmt, T.StructType([*schema, T.StructField(CORRUPT, T.StringType())]), settings)
    # Both together keep all cells in the parser: it cannot skip those nobody reads.
    return rows.select(
        *map(quoted, schema.names),
        CORRUPT,
        F.col("_metadata.file_path").alias(ORIGIN),
        F.col(CORRUPT).isNotNull().alias(QUARANTINED),
    )


def ingest_quarantined(
    spark: SparkSession,
    path: str,
    target: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    table_format: str = "parquet",
) -> dict[str, int]:
    """Parse a file once and write it once, rows that fit and rows that do not
    into folders of their own: ``target`` and ``quarantined=false`` or ``=true``
    below it. Returns how many rows were ``read``, ``kept`` and ``quarantined``,
    counted by that write. Read them back with :func:`kept_rows` and
    :func:`quarantined_rows`."""
    seen = Observation()
    rows = quarantined(spark, path, fmt, schema, options).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(~F.col(QUARANTINED)).alias("kept"), F.count_if(QUARANTINED).alias(QUARANTINED)
    )
    write_table(rows, target, table_format, partition_by=[QUARANTINED])
    return dict(seen.get)


def _sorted_out(spark: SparkSession, target: str, table_format: str, wanted: bool) -> DataFrame:
    rows = read_table(spark, target, table_format)
    return rows.where(F.col(QUARANTINED) == wanted).drop(QUARANTINED)


def kept_rows(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame:
    """The rows that fit, under the file's columns; the others are not opened."""
    return _sorted_out(spark, target, table_format, False).drop(CORRUPT, ORIGIN)


def quarantined_rows(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame:
    """Text and file of each row that did not fit."""
    return _sorted_out(spark, target, table_format, True).select(CORRUPT, ORIGIN)


def raw_file_audit(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, header_hex, is_zip) of every file under ``path``: the
    first four bytes tell a workbook from a mislabelled text file. Tasks read
    four bytes of each file, whatever its size (see :mod:`.prefix`); an empty
    file has an empty header. Where the store is one that only Spark can open,
    its reader for whole files is used: it skips empty files, and fails on one
    that is too large for a cell of a row (2 GB)."""
    found = file_prefixes(spark, path, 4, glob)
    if found is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob is not None:
            reader = reader.option("pathGlobFilter", glob)
        start = F.substring("content", 1, 4)
        found = reader.load(path).select("path", "length", start.alias("prefix"))
    header = F.hex("prefix")
    return found.select(
        "path", "length", header.alias("header_hex"), (header == ZIP_HEADER).alias("is_zip")
    )
