from datetime import datetime, timedelta

from support import rows
from tablewright.operators import views as W
from tablewright.operators.serving import materialize_latest
from tablewright.sources import current_snapshot
from tablewright.streaming.materialize import read_history, stream_materialize

VIEW = W.FeatureView(
    name="v",
    entities=(W.Entity("k", "string"),),
    fields=(W.Field("v", "int"),),
    source=W.FeatureSource(event_timestamp="event", created_timestamp=None),
)
START = datetime(2024, 1, 1)


def add(spark, path, data):
    table = [(k, START + timedelta(days=d), v) for k, d, v in data]
    df = spark.createDataFrame(table, "k string, event timestamp_ntz, v int")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def test_new_files_late_rows_and_restart(spark, tmp_path):
    source, root, progress = (str(tmp_path / n) for n in ("in", "online", "progress"))

    def run():
        stream = read_history(spark, source, schema, files_per_batch=1)
        query = stream_materialize(stream, VIEW, root, progress)
        query.awaitTermination()
        return current_snapshot(spark, root)

    schema = add(spark, source, [("a", 5, 1), ("b", 5, 2)])
    table, until, _ = run()
    assert rows(table.select("k", "v")) == [("a", 1), ("b", 2)] and until.startswith("2024-01-06")

    # A late row of a known key, one of a new key, and a newer one.
    add(spark, source, [("a", 1, 9), ("c", 2, 3)])
    add(spark, source, [("b", 8, 4), (None, 9, 5)])
    table, until, version = run()
    assert rows(table.select("k", "v")) == [("a", 1), ("b", 4), ("c", 3)]
    whole = materialize_latest(spark.read.parquet(source), VIEW)
    assert rows(table) == rows(whole)

    # Nothing new: nothing is published.
    assert run()[2] == version


def test_new_checkpoint_on_the_same_root(spark, tmp_path):
    root = str(tmp_path / "online")
    for turn, data in enumerate(([("a", 5, 1)], [("a", 6, 2), ("b", 5, 3)])):
        source = str(tmp_path / f"in{turn}")
        schema = add(spark, source, data)
        stream = read_history(spark, source, schema)
        stream_materialize(stream, VIEW, root, str(tmp_path / f"progress{turn}")).awaitTermination()
    assert rows(current_snapshot(spark, root)[0].select("k", "v")) == [("a", 2), ("b", 3)]


def test_batch_without_keys_publishes_nothing(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "online")
    schema = add(spark, source, [(None, 1, 1)])
    stream = read_history(spark, source, schema)
    stream_materialize(stream, VIEW, root, str(tmp_path / "progress")).awaitTermination()
    assert current_snapshot(spark, root) is None
