from datetime import timedelta

import pytest

from tablewright.operators import views as W
from tablewright.plans import customer


def view(*fields, created="created"):
    return W.FeatureView(
        name="v",
        entities=(W.Entity("k", "string"),),
        fields=tuple(W.Field(n, t) for n, t in fields),
        source=W.FeatureSource(event_timestamp="event", created_timestamp=created),
        ttl=timedelta(days=1),
    )


@pytest.fixture(scope="module")
def table(spark):
    return spark.sql(
        "SELECT 'a' AS k, 1.5D AS x, 1 AS n, array(0D, 1D) AS v, 'drop' AS other, "
        "TIMESTAMP '2024-01-01' AS event, TIMESTAMP '2024-01-02' AS created"
    )


def test_preset_has_all_fields():
    preset = customer.feature_view()
    assert len(preset.fields) == 24 and len(preset.columns) == 27
    assert sum(f.dtype == "array<float>" for f in preset.fields) == 11
    assert preset.ttl == timedelta(days=3650)


def test_conform(table):
    out = W.conform(table, view(("x", "float"), ("n", "bigint"), ("v", "array<float>")))
    assert out.columns == ["k", "x", "n", "v", "event", "created"]
    assert [t for _, t in out.dtypes] == [
        "string",
        "float",
        "bigint",
        "array<float>",
        "timestamp",
        "timestamp",
    ]
    with pytest.raises(ValueError, match="absent"):
        W.conform(table, view(("absent", "float")))


def status(df, *fields):
    checked = W.check_view(df, view(*fields)).collect()
    return {r["field"]: (r["status"], r["non_null"], r["lost"]) for r in checked}


def test_contract(table):
    got = status(
        table,
        ("x", "float"),
        ("n", "int"),
        ("v", "array<float>"),
        ("other", "bigint"),
        ("absent", "float"),
        ("k", "array<float>"),
    )
    assert got["x"] == ("cast", 1, 0)
    assert got["n"] == ("ok", 1, 0)
    assert got["v"] == ("cast", 1, 0)
    assert got["other"] == ("cast", 1, 1)
    assert got["absent"] == ("missing", 0, 0)
    assert got["k"][0] in ("mismatch", "ok")
    assert got["event"] == ("ok", 1, 0) and got["created"] == ("ok", 1, 0)
    names = [r["field"] for r in W.view_mismatches(table, view(("x", "float"), ("other", "int"))).collect()]
    assert names == ["other"]


def test_lost_values(spark, table):
    big = spark.sql(
        "SELECT 'a' AS k, x, array(x) AS v, CAST(x AS STRING) AS s, CAST(id AS BIGINT) AS n, "
        "TIMESTAMP_NTZ '2024-01-01' AS event, TIMESTAMP '2024-01-01' AS created "
        "FROM VALUES (1D, 1), (1e39D, 3000000000), (double('inf'), 2), (double('nan'), NULL), "
        "(NULL, 4) AS t(x, id)"
    )
    got = status(big, ("x", "float"), ("v", "array<float>"), ("s", "float"), ("n", "int"))
    assert got["x"] == ("cast", 4, 1)
    assert got["v"] == ("cast", 5, 1)
    assert got["s"] == ("cast", 4, 1)
    assert got["n"] == ("cast", 4, 1)
    assert got["event"] == ("ok", 5, 0)


def test_source_reads(spark, tmp_path, table):
    path = str(tmp_path / "t")
    table.write.orc(path)
    source = W.FeatureSource(path=path, format="orc", event_timestamp="event")
    assert source.read(spark).count() == 1


def test_view_without_created_time(table):
    assert view(("x", "float"), created=None).timestamps == ["event"]
