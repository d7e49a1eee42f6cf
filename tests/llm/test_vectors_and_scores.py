"""Frames, centroids and positive-unlabelled scores against brute force and small cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, difference
from tablewright.llm import catalog, centroids, middle, positive

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_fill_in_middle"])
def test_equals_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, SF), connect(SF), catalog.ORACLES[name]) is None


# fill in the middle


def fim_by_definition(id_, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in middle.MARKERS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng, n):
    return "".join(rng.choice(["a", "B", "zz", " ", "\n", "é", "😀", "[", "`", "{", "@", "0", "abc" * 9]) for _ in range(n))


@pytest.mark.parametrize("frame_chars", [1, 7, 32_768])
def test_fim_against_definition(spark, make, frame_chars):
    rng = random.Random(frame_chars)
    texts = [None, "", "a", "<P>", "x<S>y", "abc", "...", "a" * 100] + [random_text(rng, rng.randrange(60)) for _ in range(150)]
    docs = make(texts, [*range(len(texts) - 3), 5, 5, None])  # repeated and absent ids
    out = middle.fill_in_middle(middle.frame_documents(docs, frame_chars=frame_chars))
    got = middle.with_digests(out.withColumn("text", middle.output_text("output"))).collect()
    ids = [r.doc_id for r in docs.select("doc_id").collect()]

    def digest(text):
        return hashlib.sha256((text or "").encode()).hexdigest()

    want = []
    for id_, text in zip(ids, texts):
        n, form, p, m, new = fim_by_definition(id_, text)
        want.append((id_, n, form, p, m, new, digest(new), digest(text)))
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_written_again():
    import zstandard

    pack, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    frames = middle.to_frames("one two three " * 1000, 500, pack)
    output, _, _ = middle.Parts(pack, unpack).moved(frames, "psm", 1111, 4321)
    old = {f["data"] for f in frames}
    assert sum(f["data"] in old for f in output) == len(frames) - 2
    stream = zstandard.ZstdDecompressor().stream_reader(b"".join(f["data"] for f in output), read_across_frames=True)
    assert sum(f["chars"] for f in output) == len(stream.read().decode())


def test_fim_of_long_text_and_empty_table(spark, make):
    text = "word " * 400_000 + "é" * 300_000
    (row,) = middle.transformed(make([text], [3])).collect()
    n, form, p, m, new = fim_by_definition(3, text)
    assert (row.n, row.form, row.prefix_chars, row.middle_chars) == (n, form, p, m)
    assert row.output_sha256 == hashlib.sha256(new.encode()).hexdigest()
    assert row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert middle.transformed(make([])).collect() == []


# centroids

VECTORS = "vec_id long, embedding array<float>, label int, q string, cluster string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "y") for i, e in rows], VECTORS)


def clusters_by_definition(rows, k, rounds, dims, scale, seed):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e):
            kept.append((i, [int(np.floor(scale * float(np.float32(x)))) for x in e]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    points = [list(q) for _, q in order[:k]]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((distance(q, c), j) for j, c in enumerate(points)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(points)):
            mine = [q for (_, q), (_, c) in zip(kept, found) if c == j]
            if mine:
                points[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = assign()
    inertia = {j: sum(d for d, c in found if c == j) for _, j in found}
    total = sum(inertia.values())
    sha = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, c, d, inertia[c], total, sha[c]) for (i, _), (d, c) in zip(kept, found)), key=repr)


@pytest.mark.parametrize("spread", [0.01, 1.0, 1000.0])
def test_clusters_against_definition(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    rows = [(i, [float(x) for x in rng.normal(0, spread, 6)]) for i in range(300)]
    rows += rows[:40] + [(400 + i, rows[7][1]) for i in range(30)]  # repeated rows, and equal vectors
    rows += [(None, rows[3][1]), (1, None), (2, []), (3, [1.0] * 5), (4, [1.0] * 5 + [None]), (5, [float("nan")] * 6)]
    rows += [(6, [float("inf")] * 6), (7, [1.0] * 7)]
    got = centroids.cluster(vectors(spark, rows), k=9, rounds=3, dims=6, scale=256, seed=2).drop("n_exact")
    assert sorted(map(tuple, got.collect()), key=repr) == clusters_by_definition(rows, 9, 3, 6, 256, 2)


def test_bounds_rule_out_centroids_but_no_nearest(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 4, (12, 8))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 0.1, 8)]) for i in range(600)]
    out = centroids.cluster(vectors(spark, rows), k=12, rounds=4, dims=8, scale=256, seed=2)
    assert out.agg(F.avg("n_exact")).first()[0] < 5
    assert sorted(map(tuple, out.drop("n_exact").collect()), key=repr) == clusters_by_definition(rows, 12, 4, 8, 256, 2)


def test_few_and_no_vectors(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    got = centroids.cluster(vectors(spark, rows), k=40, rounds=2, dims=2)
    assert sorted((r.vec_id, r.distance, r.inertia) for r in got.collect()) == [(1, 0, 0), (2, 0, 0)]
    empty = centroids.cluster(vectors(spark, [(1, None)]), k=40, rounds=2, dims=2)
    assert empty.collect() == [] and empty.columns == got.columns
    with pytest.raises(Exception, match="components beyond"):
        centroids.cluster(vectors(spark, [(1, [1e30, 0.0])]), dims=2).collect()


# positive-unlabelled scores


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = positive.quality_scores(docs, labels)
    rows = out.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean(np.subtract.outer(good, bad) > 0) > 0.99
    # labels that may not be learned from change nothing
    folded = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(folded, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {(r.doc_id, round(r.score, 4)) for r in positive.quality_scores(docs, flipped).collect()}
    assert again == {(r.doc_id, round(r.score, 4)) for r in out.collect()}


def test_risk_is_the_greater_of_two_and_its_slope_is_right():
    rng = np.random.default_rng(2)
    x = np.concatenate([np.ones((500, 1)), rng.normal(0, 1, (500, 4))], axis=1)
    trusted, prior = rng.random(500) < 0.3, 0.6
    for scale in (0.1, 1.0, 3.0):
        w = rng.normal(0, scale, 5)
        sums = positive.sums_of(x, trusted, w)
        risk = positive.risk_of(sums, w, prior, 1e-3, 200.0)
        g = x @ w
        p, u = g[trusted], g[~trusted]
        plain = prior * np.log1p(np.exp(-p)).mean()
        unlabelled = np.log1p(np.exp(u)).mean() - prior * np.log1p(np.exp(p)).mean()
        assert risk.negative_part == pytest.approx(unlabelled)
        assert risk.value == pytest.approx(plain + max(0, unlabelled) + 1e-3 * w @ w / 2, abs=0.004)
        for i in range(5):
            step = np.eye(5)[i] * 1e-6
            there = positive.risk_of(positive.sums_of(x, trusted, w + step), w + step, prior, 1e-3, 200.0)
            assert (there.value - risk.value) / 1e-6 == pytest.approx(risk.gradient[i], abs=1e-3)


def test_prior_of_a_known_mixture(spark):
    rng = np.random.default_rng(3)
    width = len(positive.STATISTICS)
    rows = []
    for share, trusted, n in ((1.0, True, 1500), (0.7, False, 3000)):
        good = rng.random(n) < share
        x = rng.normal(0, 1, (n, width)) + np.where(good, 0, 4)[:, None]
        rows += [(i, False, [float(v) for v in r], trusted) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "doc_id long, held_out boolean, x array<double>, trusted boolean")
    model = positive.fit_positive_unlabelled(table)
    assert model.prior == pytest.approx(0.7, abs=0.07)


def test_scores_of_odd_rows(spark, make):
    texts = [None, "", " \n", "one", "one", "x" * 300_000, "a b c. " * 50] + [f"Words of text number {i}, in order." for i in range(40)]
    docs = make(texts, [None, 1, 1, *range(2, len(texts) - 1)])
    labels = spark.createDataFrame(
        [(i, int(i > 6), None, "x") for i in range(45)] + [(None, 1, 0, "x"), (9, None, 0, "x"), (10, 0, 0, "x")],
        "doc_id long, quality int, toxic int, trusted string",
    )
    got = positive.quality_scores(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    none = positive.quality_scores(docs, labels.where("quality = 0")).collect()
    assert {r.score for r in none} == {0.5}
    assert positive.quality_scores(make([]), labels).collect() == []
    assert len(positive.quality_scores(docs, labels.limit(0)).collect()) == len(texts)
