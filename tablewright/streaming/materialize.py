"""Incremental materialisation by file arrival.

The same refresh as ``materialize_incremental``, but the progress is kept by
the query's checkpoint instead of an event-time bound: each new file of the
feature history is read exactly once, so rows that arrive late are merged too.
Run it on a schedule (``availableNow`` stops when the backlog is done) or let
it run on.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.functions.naming import quoted
from tablewright.operators.serving import materialize_latest, merge_snapshot
from tablewright.operators.views import FeatureView
from tablewright.session import through_storage
from tablewright.sources.tables import current_snapshot, instant, is_published, publish_snapshot


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """The feature history as a stream of files. Batches are large because
    each one rewrites the snapshot once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", files_per_batch).load(path)


def stream_materialize(
    history: DataFrame,
    view: FeatureView,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge every batch of ``history`` into the snapshot published at
    ``root``. A batch that is run again after a failure finds its version
    published and is skipped; merging it twice would change nothing either.
    Versions carry the id that the checkpoint gives the query, so a stream with
    a new checkpoint on the same root has versions of its own."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        version = f"batch-{query}-{batch_id:012d}"
        if is_published(spark, root, version):
            return
        last = current_snapshot(spark, root)
        newest = through_storage(materialize_latest(batch, view), "newest")
        event = F.max(quoted(view.source.event_timestamp)).cast("string")
        until = newest.agg(event).first()[0]
        if until is None:  # no row with a key: nothing to publish
            return
        if last is None:
            table = newest
        else:
            table, until = merge_snapshot(last[0], newest, view), max(instant(until), last[1])
        publish_snapshot(table, root, version, until)

    return (
        history.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
