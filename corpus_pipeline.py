"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept; all but the last return the columns
of ``documents``. Part of ``tablewright.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, staged, table
from tablewright.llm.decontamination import decontaminate
from tablewright.llm.lines import dedup_lines
from tablewright.llm.pieces import encode_documents, read_model
from tablewright.llm.quality import fit_quality, verdict
from tablewright.llm.simhash import keep_one

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; each row is judged by its own text."""
    trees = fit_quality(docs, table(spark, sf_dir, "labels"))
    mark = free_name(docs, "_verdict")
    return docs.withColumn(mark, verdict(F.col("text"), trees)).where(f"`{mark}`.kept").drop(mark)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; ``n_chars`` follows the text. Documents
    that were repeats altogether go on without text."""
    out = dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the least id."""
    return keep_one(docs, shingle=3, max_bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go, each row by its id and
    text; an empty benchmark lets all stay."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), keyed=True)
    id_, th = free_name(docs, "_clean_id"), free_name(docs, "_clean_th")
    clean = found.where("NOT contaminated").select(F.col("doc_id").alias(id_), F.col("_th").alias(th)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(th))
    return docs.join(clean, same, "left_semi")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return encode_documents(docs, read_model(MODEL_PATH))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding", encode),
]

# The stages' models and hashes have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next reads it.
    Rows without words (NULL or empty texts) fail the first stage, and an empty
    table passes through all of them as one. Rows that repeat id and text are told
    apart by no stage: the third keeps one of them. Ties go as each stage says."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"stage{number + 1}")
    return docs
