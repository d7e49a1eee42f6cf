import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from support import rows
from tablewright.operators import encoding as E


def frame(spark, values, dtype="string"):
    return spark.createDataFrame(list(enumerate(values)), f"i int, c {dtype}")


def vocab_of(df, **kwargs):
    return {(r["label"], r["slot"]) for r in E.fit_vocab(df, ["c"], **kwargs).collect()}


def test_slots_by_count_then_label(spark):
    assert vocab_of(frame(spark, list("babca"))) == {("a", 0), ("b", 1), ("c", 2)}
    assert vocab_of(frame(spark, [10, 9], "int")) == {("10", 0), ("9", 1)}


def test_null_and_unseen_take_the_last_slot(spark):
    df = frame(spark, ["b", None, "a", "new"])
    out = E.encode_many(df, {"c": ["a", "b"]}, ["c"], keep_raw=True)
    got = {r["i"]: list(r["c_vec"]) for r in out.collect()}
    assert got == {0: [0, 1, 0], 1: [0, 0, 1], 2: [1, 0, 0], 3: [0, 0, 1]}
    index = E.string_index(df, {"c": ["a", "b"]}, ["c"])
    assert {r["i"]: r["c_idx"] for r in index.collect()} == {0: 1.0, 1: 2.0, 2: 0.0, 3: 2.0}


def test_odd_labels(spark):
    labels = ["", "it's", "back\\slash", 'q"q', "ü", " "]
    df = frame(spark, labels)
    index = E.string_index(df, E.fit_vocab(df, ["c"]), ["c"])
    assert [r["c"] for r in index.orderBy("c_idx").collect()] == sorted(labels)


def test_column_without_labels(spark):
    df = frame(spark, [None, None])
    out = E.encode_many(df, E.fit_vocab(df, ["c"]), ["c"])
    assert [list(r["c_vec"]) for r in out.collect()] == [[1.0], [1.0]]


@pytest.mark.parametrize("n", [5, 64, 65, 200])
def test_literal_and_composed_vectors(spark, n):
    df = spark.range(n + 1).selectExpr("id AS i", "nullif(concat('v', lpad(id, 4, '0')), 'x') AS c")
    labels = [f"v{i:04d}" for i in range(n)]
    out = E.encode_many(df, {"c": labels}, ["c"]).orderBy("i").collect()
    for i, r in enumerate(out):
        assert len(r["c_vec"]) == n + 1 and sum(r["c_vec"]) == 1.0 and r["c_vec"][i] == 1.0


def test_a_bound_is_only_what_the_caller_asks_for(spark):
    df = frame(spark, [f"v{i}" for i in range(20)])
    with pytest.raises(ValueError, match="more than 10 labels"):
        E.fit_vocab(df, ["c"], max_labels=10)
    with pytest.raises(ValueError, match="more than 10 labels"):
        E.collect_vocab(E.fit_vocab(df, ["c"]), ["c"], max_labels=10)
    assert E.fit_vocab(df, ["c"], max_labels=20).count() == 20


@pytest.mark.parametrize("window_labels", [100_000, 100])
def test_thousands_of_labels(spark, window_labels):
    """Every slot and every vector of 6,000 labels, with NULL and unseen values."""
    known = spark.range(6000).selectExpr("CAST(id AS STRING) AS c")
    vocab = E.fit_vocab(known, ["c"], window_labels=window_labels)
    assert dict(vocab.dtypes)["slot"] == "bigint"
    df = spark.range(6002).selectExpr("id AS i", "nullif(CAST(id AS STRING), '6000') AS c")
    out = E.encode_many(df, vocab, ["c"], keep_raw=True)
    assert out.columns == ["i", "c", "c_vec"]
    want = {label: slot for slot, label in enumerate(sorted(map(str, range(6000))))}
    got = out.selectExpr(
        "c", "size(c_vec) AS n", "array_position(c_vec, 1D) - 1 AS slot", "size(array_remove(c_vec, 0D)) AS ones"
    ).collect()
    assert len(got) == 6002
    for r in got:
        assert (r["n"], r["slot"], r["ones"]) == (6001, want.get(r["c"], 6000), 1)


def test_every_form_gives_the_same_slots(spark):
    df = spark.range(3000).selectExpr("id AS i", "CAST(pow(id % 60, 2) AS INT) % 97 AS c")
    df = df.withColumn("d", df["c"] % 5)
    cols = ["c", "d"]
    window, sort = E.fit_vocab(df, cols), E.fit_vocab(df, cols, window_labels=3)
    assert rows(window) == rows(sort.select(*window.columns))
    for encode in (E.string_index, E.encode_many):
        plain = encode(df, window, cols, literal_labels=1000)
        for vocab in (sort, E.collect_vocab(window, cols)):
            joined = encode(df, vocab, cols, literal_labels=3)
            assert plain.columns == joined.columns and rows(plain) == rows(joined)


def test_equal_to_ml(spark):
    df = spark.range(500).selectExpr(
        "id AS i",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE concat('a', id % 5) END AS c",
        "CAST(id % 13 AS INT) AS d",
    )
    cols = ["c", "d"]
    native = E.encode_many(df, E.fit_vocab(df, cols), cols)
    ml = E.encode_many_ml(df, cols)
    assert native.columns == ml.columns
    assert rows(native) == rows(ml)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from([None, "x", "y", "z", "", "'"]), min_size=1, max_size=30))
def test_every_vector_has_one_hot_slot(spark, values):
    df = frame(spark, values)
    vocab = E.fit_vocab(df, ["c"])
    size = vocab.count() + 1
    for r in E.encode_many(df, vocab, ["c"], keep_raw=True).collect():
        assert len(r["c_vec"]) == size and sorted(r["c_vec"])[-1] == 1.0 == sum(r["c_vec"])
        assert (r["c_vec"][-1] == 1.0) == (r["c"] is None)


def test_saved_vocabulary_keeps_slots(spark, tmp_path):
    path = str(tmp_path / "vocab")
    E.fit_vocab(frame(spark, list("aab")), ["c"]).write.parquet(path)
    later = frame(spark, list("bbbca"))
    index = E.string_index(later, spark.read.parquet(path), ["c"]).orderBy("i")
    assert [r["c_idx"] for r in index.collect()] == [1.0, 1.0, 1.0, 2.0, 0.0]


@pytest.mark.parametrize("broadcast_labels", [0, 100])
def test_all_forms_hold_the_same_vectors(spark, broadcast_labels):
    values = ["b", None, "a", "new", "b", "it's"]
    df = spark.createDataFrame([(i, v, None if v is None else v * 2) for i, v in enumerate(values)], "i int, c string, d string")
    vocab = E.fit_vocab(df.where("i <> 3"), ["c", "d"])
    how = {"literal_labels": 1, "broadcast_labels": broadcast_labels}
    dense = E.encode_many(df, vocab, ["c", "d"], **how)
    sparse = E.encode_many(df, vocab, ["c", "d"], form=E.SPARSE, **how)
    ml = E.encode_many(df, vocab, ["c", "d"], form=E.VECTOR, **how)
    assert dense.columns == sparse.columns == ml.columns == ["i", "c_vec", "d_vec"]
    assert rows(dense) == rows(E.sparse_to_dense(sparse)) == rows(E.vector_to_array(ml))
    assert sparse.first()["c_vec"].size == 4
    assert rows(E.encode_many(df, vocab, ["c", "d"])) == rows(dense)


def test_sparse_is_no_wider_for_more_labels(spark):
    one = spark.range(1).selectExpr("CAST(id AS DOUBLE) AS c_idx")
    wide = E.one_hot(one, {"c_idx": 3_000_000_000}, form=E.SPARSE).first()["c_vec"]
    assert (wide.size, wide.indices, wide["values"]) == (3_000_000_000, [0], [1.0])
    with pytest.raises(ValueError, match="form must be"):
        E.one_hot(one, {"c_idx": 3}, form="thin")


def test_empty_sparse_vectors_and_null_are_dense_too(spark):
    kind = "v struct<size: bigint, indices: array<bigint>, values: array<double>>"
    df = spark.createDataFrame([((0, [], []),), ((3, [0, 2], [1.5, -1.0]),), (None,)], kind)
    assert [r["v"] for r in E.sparse_to_dense(df, ["v"]).collect()] == [[], [1.5, 0.0, -1.0], None]


@pytest.mark.parametrize("window_labels", [0, 100])
def test_slots_stay_when_a_vocabulary_grows(spark, window_labels):
    first = E.fit_vocab(frame(spark, list("bbbaac")), ["c"])
    grown = E.extend_vocab(first, frame(spark, ["a", "y", "x", "y", None, "z"]), ["c"], window_labels=window_labels)
    slots = {r["label"]: r["slot"] for r in grown.collect()}
    assert slots == {"b": 0, "a": 1, "c": 2, "y": 3, "x": 4, "z": 5}
    again = E.extend_vocab(grown, frame(spark, ["z", "b"]), ["c"])
    assert {r["label"]: r["slot"] for r in again.collect()} == slots
    from_nothing = E.extend_vocab(first.limit(0), frame(spark, list("abb")), ["c"])
    assert {r["label"]: r["slot"] for r in from_nothing.collect()} == {"b": 0, "a": 1}


def test_changes_of_a_vocabulary(spark):
    first = E.fit_vocab(frame(spark, list("bba")), ["c"])
    found = E.vocab_changes(first, frame(spark, ["b", "n", "n", None]), ["c"])
    assert {tuple(r) for r in found.collect()} == {("c", "b", "kept", 1), ("c", "a", "retired", 0), ("c", "n", "new", 2)}
