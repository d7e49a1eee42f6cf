"""What several operators share."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import scratch_path, through_storage

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the folder named by ``spark.checkpoint.dir``."""
    return through_storage(df, f"llm-{label}")


def staged_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``staged``, with the path, for tables that are dropped again."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def drop_staged(spark: SparkSession, path: str) -> None:
    """Deletes a staged table that no later step reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Plain ``lower`` is faster and says
    the same where every character is one byte."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Names a row by id and text, so rows that repeat an id stay apart and
    rows that repeat both share one result."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th")]


def join_keyed(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Joins on the row key; the columns of ``right`` beside the key are added."""
    renamed = right.withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    on = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth"))
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_rid", "_rth")


def rekeyed(key: Column, kind: str = "long") -> Column:
    """The same value under an expression the planner cannot see through, so
    that a join on an aggregate gets an exchange of its own; adaptive execution
    can then split a hot key's partition."""
    return key.bitwiseXOR(F.lit(0).cast("long")) if kind == "long" else F.concat(key, F.lit(""))


def constant(values: list, kind: str) -> Column:
    """A constant array, folded when the query is planned; one expression,
    however many entries."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used.
    Inside lambdas the engine shares no common parts by itself."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scanned(items: Column, zero: Column, step, out_type: str, block: int = 400) -> Column:
    """The list of what ``step`` makes of each item, from left to right.
    ``step(state, item)`` gives a struct of the next ``state`` and of ``out``.

    The engine copies what a fold has gathered at each of its steps, which is
    quadratic in the items. So items are folded in blocks, and the blocks'
    results in a fold over blocks: only the short list of a block is copied at
    each item, and the long one once a block. In a block, what a step makes is
    added by the next one, so that each step is computed once.
    """
    none, nothing = F.array().cast(f"array<{out_type}>"), F.lit(None).cast(out_type)

    def gathered(acc: Column) -> Column:
        return F.when(acc["n"] > 0, F.array_append(acc["now"], acc["made"]["out"])).otherwise(acc["now"])

    def add(acc: Column, item: Column) -> Column:
        made = step(acc["made"]["state"], item).alias("made")
        return F.struct(made, (acc["n"] + 1).alias("n"), gathered(acc).alias("now"))

    def add_block(acc: Column, part: Column) -> Column:
        first = F.struct(acc["state"].alias("state"), nothing.alias("out")).alias("made")
        end = lambda x: F.struct(x["made"]["state"].alias("state"), gathered(x).alias("now"))
        folded = F.aggregate(part, F.struct(first, F.lit(0).alias("n"), none.alias("now")), add, end)
        more = lambda x: F.struct(x["state"].alias("state"), F.array_append(acc["done"], x["now"]).alias("done"))
        return let(folded, more)

    def in_blocks(every: Column) -> Column:
        last = F.floor((F.size(every) - 1) / block).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(every, b * block + 1, F.lit(block)))
        start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("done"))
        folded = F.aggregate(parts, start, add_block, lambda acc: F.flatten(acc["done"]))
        return F.when(F.size(every) > 0, folded).otherwise(none)

    return let(items, in_blocks)
