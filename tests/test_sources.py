import zipfile

import pytest

from support import rows
from tablewright import session
from tablewright.catalog.fixture import raw
from tablewright.sources import prefix
from tablewright.sources.tables import instant
from tablewright.sources import (
    current_snapshot,
    infer_schema,
    ingest_quarantined,
    publish_snapshot,
    quarantined,
    raw_file_audit,
    read_table,
    read_tabular,
    write_counted,
    write_dated,
    write_table,
)
from tablewright.sources.files import kept_rows, quarantined_rows


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_round_trip_and_overwrite(spark, sf_dir, tmp_path, fmt):
    df, path = raw(spark, sf_dir), str(tmp_path / fmt)
    for _ in range(2):
        write_table(df, path, fmt)
    back = read_table(spark, path, fmt).select(*df.columns)
    assert rows(back) == rows(df)


def test_csv_types_and_blanks(spark, tmp_path):
    (tmp_path / "in.csv").write_text("customerID,tenure,TotalCharges\na,1,29.85\nb,0, \nc,,\n")
    df = read_tabular(spark, str(tmp_path / "in.csv"))
    assert df.dtypes == [("customerID", "string"), ("tenure", "int"), ("TotalCharges", "string")]
    assert [tuple(r) for r in df.collect()] == [("a", 1, "29.85"), ("b", 0, " "), ("c", None, None)]


def test_given_schema_is_not_inferred(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n")
    df = read_tabular(spark, str(tmp_path / "in.csv"), schema="a string, b double")
    assert df.first() == ("1", 2.0)


def test_counted_write(spark, tmp_path):
    assert write_counted(spark.range(17), str(tmp_path / "t")) == 17
    assert spark.read.parquet(str(tmp_path / "t")).count() == 17


def test_partitioned_write(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS part")
    write_table(df, str(tmp_path / "t"), partition_by=["part"])
    assert (tmp_path / "t" / "part=1").is_dir()


def test_dated_write_replaces_the_days_it_has(spark, tmp_path):
    path = str(tmp_path / "dated")
    df = spark.range(96).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS t", "id AS v")
    df = df.unionAll(spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ), -1L"))
    write_dated(df, path, "t")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "dated").rglob("*.parquet")}
    again = df.where("t >= timestamp_ntz'2024-01-03' AND t < timestamp_ntz'2024-01-04'").selectExpr("t", "v + 1000 AS v")
    for _ in range(2):
        write_dated(again, path, "t")
    back = spark.read.parquet(path)
    assert back.count() == 97 and back.where("v >= 1000").count() == 24
    other = [p for p in before if "event_date=2024-01-03" not in str(p)]
    assert len(other) < len(before) and all(p.stat().st_mtime_ns == before[p] for p in other)
    with pytest.raises(ValueError, match="only_partitions"):
        write_table(df, path, only_partitions=True)


BAD_CSV = "a,b,c\n1,x,2.5\ntwo,y,3\n3,z\n4,w,1,more\n5,,\n"


def test_malformed_rows_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "in.csv").write_text(BAD_CSV)
    target = str(tmp_path / "landing")
    counts = ingest_quarantined(spark, str(tmp_path / "in.csv"), target, schema="a int, b string, c double")
    assert counts == {"read": 5, "kept": 2, "quarantined": 3}
    assert rows(kept_rows(spark, target)) == rows(spark.createDataFrame([(1, "x", 2.5), (5, None, None)], "a int, b string, c double"))
    bad = quarantined_rows(spark, target).collect()
    assert sorted(r["corrupt_record"] for r in bad) == ["3,z", "4,w,1,more", "two,y,3"]
    assert all(r["source_file"].endswith("in.csv") for r in bad)
    # few columns are read, but rows are judged by all
    assert kept_rows(spark, target).select("b").count() == 2


def test_a_file_without_bad_rows_and_json(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a": 1}\n{"a": 2, "b": "x"}\n{"a": \n')
    target = str(tmp_path / "landing")
    counts = ingest_quarantined(spark, str(tmp_path / "in.json"), target, "json", "a int, b string")
    assert counts == {"read": 3, "kept": 2, "quarantined": 1}
    (tmp_path / "good.csv").write_text("a\n1\n2\n")
    counts = ingest_quarantined(spark, str(tmp_path / "good.csv"), target + "2")
    assert counts == {"read": 2, "kept": 2, "quarantined": 0}
    assert kept_rows(spark, target + "2").dtypes == [("a", "int")]
    assert quarantined_rows(spark, target + "2").collect() == []
    with pytest.raises(ValueError, match="no rows that can fail"):
        quarantined(spark, target, "parquet", "a int")
    with pytest.raises(ValueError, match="of its own"):
        quarantined(spark, target, "csv", "a int, Corrupt_Record string")


def test_types_come_from_the_first_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,v\n" + "".join(f"{i},{i}\n" for i in range(50)) + "late,1.5\n")
    found = infer_schema(spark, str(tmp_path / "in.csv"), sample_lines=20)
    assert [f.dataType.simpleString() for f in found] == ["int", "int"]
    counts = ingest_quarantined(spark, str(tmp_path / "in.csv"), str(tmp_path / "landing"), schema=found)
    assert counts == {"read": 51, "kept": 50, "quarantined": 1}


def test_file_audit(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "book.xlsx", "w") as book:
        book.writestr("x", "y" * 50)
    (tmp_path / "fake.xlsx").write_text("customerID,gender")
    (tmp_path / "empty.xlsx").write_bytes(b"")
    (tmp_path / "short.xlsx").write_bytes(b"PK")
    (tmp_path / "other.csv").write_text("a,b")
    (tmp_path / "_started.xlsx").write_text("hidden")
    inside = tmp_path / "with space" / "below"
    inside.mkdir(parents=True)
    (inside / "deep.xlsx").write_bytes(b"PK\x03\x04...")
    audit = raw_file_audit(spark, str(tmp_path), "*.xlsx")
    got = {r["path"].removeprefix(str(tmp_path)): tuple(r)[1:] for r in audit.collect()}
    size = (tmp_path / "book.xlsx").stat().st_size
    assert got == {
        "/book.xlsx": (size, "504B0304", True),
        "/fake.xlsx": (17, "63757374", False),
        "/empty.xlsx": (0, "", False),
        "/short.xlsx": (2, "504B", False),
        "/with space/below/deep.xlsx": (7, "504B0304", True),
    }
    assert raw_file_audit(spark, str(inside / "deep.xlsx")).count() == 1
    assert raw_file_audit(spark, str(tmp_path), "*.none").collect() == []


def test_file_audit_reads_four_bytes_of_any_size(spark, tmp_path):
    with open(tmp_path / "huge.xlsx", "wb") as out:  # 3 GB, most of it a hole
        out.write(b"PK\x03\x04")
        out.truncate(3 << 30)
    (row,) = raw_file_audit(spark, str(tmp_path)).collect()
    assert (row["length"], row["is_zip"]) == (3 << 30, True)


def test_stores_that_only_spark_opens(spark, tmp_path, monkeypatch):
    (tmp_path / "a.xlsx").write_bytes(b"PK\x03\x04")
    monkeypatch.setattr(prefix, "KNOWN_STORES", ())
    (row,) = raw_file_audit(spark, str(tmp_path)).collect()
    assert row["is_zip"]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "online")
    assert current_snapshot(spark, root) is None
    publish_snapshot(spark.range(3), root, "1", "2024-01-01")
    first = current_snapshot(spark, root)
    publish_snapshot(first[0].selectExpr("id + 1 AS id"), root, "2", "2024-02-01")
    table, until, version = current_snapshot(spark, root)
    assert (until, version) == ("2024-02-01 00:00:00", "2") and rows(table) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="published already"):
        publish_snapshot(spark.range(1), root, "1", "2024-03-01")
    assert instant("2024-01-12T10:00:00") < instant("2024-01-12 23:00:00")
    assert instant("2024-01-12T10:00:00+02:00") == "2024-01-12 08:00:00"
    # Data without its line in the list is not seen.
    write_table(spark.range(9), f"{root}/v-3")
    assert current_snapshot(spark, root)[2] == "2"


def test_session_settings():
    conf = session.s3a_conf("http://store:9000")
    assert not any("key" in k for k in conf)
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    keyed = session.s3a_conf("x", access_key="a", secret_key="b", ssl=True)
    assert keyed["spark.hadoop.fs.s3a.secret.key"] == "b"
    assert "DeltaCatalog" in str(session.delta_conf())
    assert session.sizing_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"
    assert session.sizing_conf(1)["spark.sql.shuffle.partitions"] == "8"


class Session:
    """The two things of a session that name the shared folder."""

    def __init__(self, master, conf):
        self.conf, self.sparkContext = conf, self
        self.master, self.applicationId = master, f"app-{master}"


def test_scratch_follows_the_session(spark):
    named = Session("spark://host:7077", {session.CHECKPOINT_DIR: "hdfs:///shared/"})
    assert session.scratch_path(named, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session("spark://host:7077", {}))
    local = Session("local[2]", {})
    assert session.scratch_dir(local) == session.scratch_dir(local)
    assert session.through_storage(spark.range(5), "t").count() == 5


def test_broadcast_measure(spark):
    df = spark.range(10).selectExpr("id", "repeat('x', 100) AS t")
    assert session.fits_broadcast(df, 10)
    assert not session.fits_broadcast(df, 9)
    assert not session.fits_broadcast(df, 10, max_bytes=500)
    assert session.fits_broadcast(df.limit(0), 0)
