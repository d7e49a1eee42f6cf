"""The steps in order, over files, as a scheduler would run them."""

import pytest
from pyspark.sql import functions as F

from support import rows
from tablewright.catalog.fixture import raw
from tablewright.operators.encoding import encode_many, fit_vocab
from tablewright.operators.quality import GateFailed
from tablewright.operators.refresh import store_of
from tablewright.operators.training import confusion, cross_validate, scores, train_eval
from tablewright.plans import customer, jobs
from tablewright.sources import current_snapshot, read_table


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    paths = {n: str(root / n) for n in ("raw", "bronze", "silver", "gold", "online", "vocab")}
    df = raw(spark, "/root/testdata/sf0.01")
    keep = dict(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.unionAll(df.limit(40)).write.option("header", True).options(**keep).csv(paths["raw"])
    assert jobs.ingest(spark, paths["raw"], paths["bronze"]) == 1540
    assert jobs.clean(spark, paths["bronze"], paths["silver"]) == (1540, 1500)
    written = jobs.features(
        spark, paths["silver"], paths["gold"], vocab=paths["vocab"], as_of="2024-06-01"
    )
    assert written == 1500
    return paths


def test_layers_and_gate(spark, layers):
    gold = read_table(spark, layers["gold"])
    assert len(gold.columns) == 27
    assert not set(customer.CATEGORIES) & set(gold.columns)
    assert jobs.gate(spark, layers["gold"]) == []
    jobs.apply(spark, layers["gold"])


def test_second_run_changes_nothing(spark, layers):
    before = rows(read_table(spark, layers["gold"]))
    jobs.features(
        spark,
        layers["silver"],
        layers["gold"],
        vocab=layers["vocab"],
        relearn=False,
        as_of="2024-06-01",
    )
    assert rows(read_table(spark, layers["gold"])) == before


def test_rare_duplicates_give_the_same_silver(spark, layers, tmp_path):
    other = str(tmp_path / "silver")
    assert jobs.clean(spark, layers["bronze"], other, few_duplicates=True) == (None, 1500)
    assert rows(read_table(spark, other)) == rows(read_table(spark, layers["silver"]))


def test_failing_gate_and_contract(spark, layers, tmp_path):
    small = str(tmp_path / "gold")
    read_table(spark, layers["gold"]).limit(10).drop("contract_vec").write.parquet(small)
    with pytest.raises(GateFailed, match="min_rows_1000"):
        jobs.gate(spark, small)
    with pytest.raises(GateFailed, match="contract_vec"):
        jobs.apply(spark, small)


def test_materialise_twice(spark, layers):
    jobs.materialize(spark, layers["gold"], layers["online"], "2024-05-01 00:00:00")
    assert current_snapshot(spark, layers["online"])[0].count() == 0
    jobs.materialize(spark, layers["gold"], layers["online"], "2024-07-01 00:00:00")
    table, until, _ = current_snapshot(spark, layers["online"])
    assert table.count() == 1500 and until == "2024-07-01 00:00:00"


def test_rewritten_and_late_rows_are_served(spark, tmp_path):
    from datetime import datetime

    from tablewright.operators.views import Entity, FeatureSource, FeatureView, Field

    view = FeatureView(
        name="v",
        entities=(Entity("k", "string"),),
        fields=(Field("v", "int"),),
        source=FeatureSource(event_timestamp="event", created_timestamp=None),
    )
    gold, online, until = str(tmp_path / "g"), str(tmp_path / "o"), "2024-02-01 00:00:00"

    def refresh(data):
        table = [(k, datetime(2024, 1, day), v) for k, day, v in data]
        df = spark.createDataFrame(table, "k string, event timestamp_ntz, v int")
        df.write.mode("overwrite").parquet(gold)
        jobs.materialize(spark, gold, online, until, view)
        return sorted((r.k, r.v) for r in current_snapshot(spark, online)[0].collect())

    assert refresh([("a", 5, 1)]) == [("a", 1)]
    # the same bound again: a rewritten value, and a new key from before it
    assert refresh([("a", 5, 2), ("b", 1, 3)]) == [("a", 2), ("b", 3)]


def test_all_steps(spark, layers, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda conf: spark)
    root = str(tmp_path / "root")
    command = ["all", "--raw", layers["raw"], "--root", root, "--until", "2024-06-01 00:00:00"]
    assert jobs.main([*command, "--min-rows", "2000"]) == 1
    assert current_snapshot(spark, f"{root}/online") is None
    assert jobs.main(command) == 0
    assert current_snapshot(spark, f"{root}/online")[0].count() == 1500


def test_exit_codes(spark, layers, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_session", lambda conf: spark)
    assert jobs.main(["gate", "--gold", layers["gold"]]) == 0
    assert jobs.main(["gate", "--gold", layers["gold"], "--min-rows", "100000"]) == 1
    assert jobs.main(["clean", "--bronze", str(tmp_path / "none"), "--silver", "x"]) == 1
    assert jobs.main(["apply", "--gold", layers["gold"]]) == 0
    online = str(tmp_path / "online")
    assert jobs.main(["materialize", "--gold", layers["gold"], "--online", online]) == 0
    with pytest.raises(SystemExit):
        jobs.main(["unknown"])


def test_labels_are_joined_as_of_their_time_and_trained_on(spark, layers, tmp_path, monkeypatch):
    from dataclasses import replace

    from pyspark.sql import functions as F

    monkeypatch.setattr(jobs, "build_session", lambda conf: spark)
    gold, labels = read_table(spark, layers["gold"]), str(tmp_path / "labels")
    early = F.col("tenure") < 24  # asked before their features were known
    at = F.when(early, F.lit("2024-05-01")).otherwise(F.lit("2024-06-02")).cast("timestamp")
    gold.select("customer_id", "churn", at.alias("asked")).write.parquet(labels)
    spine = read_table(spark, labels)
    got = jobs.retrieve(spark, layers["gold"], spine, "asked")
    n_early = gold.where(early).count()
    assert got.count() == 1500 and got.where("tenure IS NULL").count() == n_early
    command = ["train", "--gold", layers["gold"], "--labels", labels, "--label", "churn"]
    assert jobs.main([*command, "--time", "asked", "--model", str(tmp_path / "model")]) == 0
    result = jobs.train(spark, layers["gold"], labels, "churn", "asked", str(tmp_path / "model"))
    assert result["n_skipped"] == n_early
    assert result["n_train"] + result["n_test"] == 1500 - n_early
    offline = replace(customer.feature_view(layers["gold"]), online=False)
    with pytest.raises(ValueError, match="not served online"):
        jobs.materialize(spark, layers["gold"], str(tmp_path / "o"), "2024-06-02", offline)


def test_model(spark, layers):
    from tablewright.operators.training import train_eval
    from tablewright.operators.views import conform

    served = conform(read_table(spark, layers["gold"]), customer.feature_view())
    inputs = [c for c, _ in customer.VIEW_FIELDS if c != "churn"]
    model, score = train_eval(served, "churn", [customer.KEY], inputs, max_iter=10)
    row = score.first()
    assert row["n_train"] + row["n_test"] == 1500 and row["n_test"] > 200 and row["n_skipped"] == 0
    share = served.where("churn = 0").count() / 1500
    assert row["accuracy"] >= share


def test_model_counts_what_it_cannot_use(spark):
    from tablewright.operators.training import train_eval

    rows = [(f"k{i}", i % 2, None if i % 4 == 0 else float(i % 2), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, y int, a double, b double")
    row = train_eval(df, "y", ["k"], ["a", "b"], max_iter=5)[1].first()
    assert row["n_skipped"] == 100 and row["n_train"] + row["n_test"] == 300


def test_a_vocabulary_grows_between_snapshots(spark, layers, tmp_path):
    silver, gold, vocab = (str(tmp_path / n) for n in ("silver", "gold", "vocab"))
    newer = read_table(spark, layers["silver"]).withColumn("contract", F.concat("contract", F.lit("!")))
    newer.write.parquet(silver)
    jobs.features(spark, silver, gold, vocab=vocab, extend=layers["vocab"], as_of="2024-07-01")
    old = {(r["column"], r["label"]): r["slot"] for r in read_table(spark, layers["vocab"]).collect()}
    new = {(r["column"], r["label"]): r["slot"] for r in read_table(spark, vocab).collect()}
    assert old.items() <= new.items() and len(new) == len(old) + 3
    assert {len(r["contract_vec"]) for r in read_table(spark, gold).select("contract_vec").collect()} == {7}


def test_lost_values_fail_the_job_if_asked(spark, layers, tmp_path):
    bronze = str(tmp_path / "bronze")
    broken = F.when(F.col("tenure") == 5, "unknown").otherwise(F.col("Partner"))
    read_table(spark, layers["bronze"]).withColumn("Partner", broken).write.parquet(bronze)
    lost = read_table(spark, bronze).where("Partner = 'unknown'").count()
    assert lost > 0
    assert jobs.clean(spark, bronze, str(tmp_path / "a"), max_coerced=lost) == (1540, 1500)
    with pytest.raises(GateFailed, match=f"few_coerced_partner \\({lost}\\)"):
        jobs.clean(spark, bronze, str(tmp_path / "b"), max_coerced=0)
    with pytest.raises(ValueError, match="not counted"):
        jobs.clean(spark, bronze, str(tmp_path / "c"), max_coerced=0, few_duplicates=True)


def test_malformed_rows_stop_before_bronze_if_asked(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b\n1,x\ny,2\n")
    raw_file, bronze = str(tmp_path / "raw.csv"), str(tmp_path / "bronze")
    with pytest.raises(GateFailed, match="1 rows do not fit"):
        jobs.ingest_sorted(spark, raw_file, str(tmp_path / "l1"), bronze, schema="a int, b string", max_quarantined=0)
    assert not (tmp_path / "bronze").exists()
    counts = jobs.ingest_sorted(spark, raw_file, str(tmp_path / "l2"), bronze, schema="a int, b string")
    assert counts["kept"] == 1 and rows(read_table(spark, bronze)) == [(1, "x")]


def test_buckets_serve_what_a_snapshot_does(spark, layers, tmp_path):
    root = str(tmp_path / "store")
    for _ in range(2):
        jobs.materialize(spark, layers["gold"], root, "2024-06-01", buckets=8)
    view = customer.feature_view()
    store = store_of(root, view, 8)
    served = store.read(spark, store.current(spark))
    jobs.materialize(spark, layers["gold"], str(tmp_path / "plain"), "2024-06-01")
    plain = current_snapshot(spark, str(tmp_path / "plain"))[0]
    assert rows(served) == rows(plain.select(*served.columns))


def test_folds_are_whole_and_told_apart(spark):
    df = spark.range(400).selectExpr(
        "concat('k', id) AS k", "CAST(id % 2 AS DOUBLE) AS x", "CAST(id % 3 AS DOUBLE) AS z", "CAST(id % 2 AS INT) AS y"
    )
    df = df.withColumn("x", F.expr("CASE WHEN k = 'k7' THEN NULL ELSE x END"))
    found = cross_validate(df, "y", ["k"], ["x", "z"], folds=4, reg=0.001)
    assert found.count() == 399 and found.select("k").distinct().count() == 399
    cells = confusion(found).collect()
    assert sum(r["n"] for r in cells) == 399 and all(r["label"] == r["predicted"] for r in cells)
    assert {r["fold"] for r in cells} == {0, 1, 2, 3}
    (row,) = scores(found).collect()
    assert (row["accuracy"], row["precision"], row["recall"]) == (1.0, 1.0, 1.0)
    assert rows(cross_validate(df, "y", ["k"], ["x", "z"], folds=4, reg=0.001)) == rows(found)
    alone = cross_validate(df.limit(1).where("x IS NOT NULL"), "y", ["k"], ["x", "z"], folds=2)
    assert [r["predicted"] for r in alone.collect()] == [None]


def test_sparse_vectors_train_like_dense_ones(spark):
    df = spark.range(300).selectExpr("id AS k", "concat('c', id % 5) AS c", "CAST(id % 5 = 2 AS INT) AS y")
    vocab = fit_vocab(df, ["c"])
    dense = encode_many(df, vocab, ["c"])
    sparse = encode_many(df, vocab, ["c"], form="vector")
    results = [train_eval(t, "y", ["k"], ["c_vec"], reg=0.001)[1].first() for t in (dense, sparse)]
    assert results[0] == results[1] and results[0]["accuracy"] == 1.0
