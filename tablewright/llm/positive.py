"""Quality scores learned from trusted positives and unlabelled text.

The model is additive over document statistics and minimises the non-negative
unbiased risk of positive-unlabelled learning. With the logistic loss l and a
class prior p that risk is the greater of two convex functions,

    A = p E+[l(g)]   and   B = p E+[l(g) - l(-g)] + Eu[l(-g)] = Eu[l(-g)] - p E+[g],

so the cut at zero of its negative part (B < A) keeps it convex, and Newton steps
on a smooth maximum find its minimum. The expectations go over all trusted
positives and all unlabelled documents: each step is one pass over the stored
statistics, whose sums are added up in Spark. The prior is not given but
estimated from how the scores of both sets are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import staged

SPACES = b" \t\n\x0b\x0c\r"
LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
STOPS = b".,;:!?\"'()-"

STATISTICS = (
    "log_words",
    "word_length",
    "other_share",
    "upper_share",
    "digit_share",
    "stop_share",
    "stops_per_word",
    "distinct_share",
    "repeat_share",
    "dup_line_share",
    "words_per_line",
    "longest_word",
    "echo_share",
    "bare_share",
)


def statistics_of(text: str | None) -> tuple[float, ...]:
    """The statistics of a whole text; NULL and empty texts have no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(sum(map(len, words)), 1)
    some = max(n, 1)

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    letters, digits, stops = share(LETTERS), share(DIGITS), share(STOPS)
    spaces = (len(raw) - len(raw.translate(None, SPACES))) / size
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    triples = list(zip(words, words[1:], words[2:]))
    return (
        np.log1p(n),
        size / some,
        max(len(raw) / size - letters - digits - stops - spaces, 0.0),
        share(UPPER),
        digits,
        stops,
        (raw.count(b".") + raw.count(b",")) / some,
        len(set(words)) / some,
        1 - len(set(triples)) / max(len(triples), 1) if triples else 0.0,
        1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        np.log1p(n / max(len(lines), 1)),
        np.log1p(max(map(len, words), default=0)),
        sum(map(eq, words, words[1:])) / some,
        sum(len(word) == 1 and not word.isalnum() for word in words) / some,
    )


def statistics(text: Column) -> Column:
    """An array of :data:`STATISTICS` per text."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(statistics_of)

    return measured(text)


@dataclass(frozen=True)
class Scale:
    """Centre and spread of each statistic among the trusted positives."""

    mean: np.ndarray
    width: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """A constant, and of each statistic how far and on which side it lies
        from the positives' mean, bounded, so no document outweighs the rest."""
        z = np.clip((x - self.mean) / self.width, -8.0, 8.0)
        return np.concatenate([np.ones((len(z), 1)), z / 2, np.abs(z) - 1], axis=1)


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def sums_of(x: np.ndarray, trusted: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What the risk, its gradient and its curvature need of some rows, as one
    vector of sums: over positives and over unlabelled rows the count, the loss,
    the slope and the upper half of the curvature; over positives the mean, too."""
    g, half = x @ w, np.triu_indices(len(w))
    p, u = x[trusted], x[~trusted]
    gp, gu = g[trusted], g[~trusted]
    parts = [[len(p)], [softplus(-gp).sum()], p.T @ -sigmoid(-gp), ((p * (sigmoid(gp) * sigmoid(-gp))[:, None]).T @ p)[half]]
    parts += [[len(u)], [softplus(gu).sum()], u.T @ sigmoid(gu), ((u * (sigmoid(gu) * sigmoid(-gu))[:, None]).T @ u)[half]]
    return np.concatenate([*parts, p.sum(axis=0)])


@dataclass(frozen=True)
class Risk:
    """The smoothed risk at one set of weights, with gradient and curvature."""

    value: float
    gradient: np.ndarray
    curvature: np.ndarray
    negative_part: float


def risk_of(sums: np.ndarray, w: np.ndarray, prior: float, decay: float, sharpness: float) -> Risk:
    d = len(w)
    half = np.triu_indices(d)
    at = 0

    def take(n: int) -> np.ndarray:
        nonlocal at
        at += n
        return sums[at - n : at]

    def square(upper: np.ndarray) -> np.ndarray:
        full = np.zeros((d, d))
        full[half] = upper
        return full + np.triu(full, 1).T

    def mean_terms() -> tuple[float, np.ndarray, np.ndarray]:
        n = max(float(take(1)[0]), 1.0)
        return float(take(1)[0]) / n, take(d) / n, square(take(len(half[0]))) / n

    n_positive = max(float(sums[0]), 1.0)
    p_loss, p_slope, p_curve = mean_terms()
    u_loss, u_slope, u_curve = mean_terms()
    p_mean = take(d) / n_positive
    a, a_slope, a_curve = prior * p_loss, prior * p_slope, prior * p_curve
    b, b_slope, b_curve = u_loss - prior * float(p_mean @ w), u_slope - prior * p_mean, u_curve
    top = max(a, b)
    value = top + np.log(np.exp(sharpness * (a - top)) + np.exp(sharpness * (b - top))) / sharpness
    share = float(sigmoid(np.array(sharpness * (a - b))))
    apart = a_slope - b_slope
    ridge = decay * np.eye(d)  # of the constant, too: a prior set too high would let it grow without end
    return Risk(
        float(value + w @ ridge @ w / 2),
        share * a_slope + (1 - share) * b_slope + ridge @ w,
        share * a_curve + (1 - share) * b_curve + sharpness * share * (1 - share) * np.outer(apart, apart) + ridge,
        b - a,
    )


@dataclass(frozen=True)
class Learner:
    """Stored statistics with the mark of trusted positives, and their scale."""

    rows: DataFrame
    scale: Scale

    def added(self, w: np.ndarray) -> np.ndarray:
        """:func:`sums_of` over all rows. A task sends one vector of sums, as one
        row per entry, and Spark adds them up."""
        scale, width = self.scale, len(STATISTICS)
        size = len(sums_of(np.zeros((0, len(w))), np.zeros(0, bool), w))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
                total += sums_of(scale.features(x), trusted, w)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "s"])

        found = self.rows.select("x", "trusted").mapInArrow(partial, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
        out = np.zeros(size)
        for r in found.collect():
            out[r["at"]] = r["s"]
        return out

    def fit(self, w: np.ndarray, prior: float, *, decay: float, sharpness: float, steps: int) -> np.ndarray:
        """Newton steps from ``w``, halved while the risk does not fall."""
        here = risk_of(self.added(w), w, prior, decay, sharpness)
        size = 1.0
        for _ in range(steps):
            step = -np.linalg.solve(here.curvature, here.gradient)
            there = w + size * step
            risk = risk_of(self.added(there), there, prior, decay, sharpness)
            if risk.value > here.value:
                size /= 4
                continue
            done = here.value - risk.value < 1e-6
            w, here, size = there, risk, min(1.0, 2 * size)
            if done:
                break
        return w

    def prior(self, w: np.ndarray, *, bins: int = 200, confidence: float = 0.1) -> float:
        """The share of positives among the unlabelled rows.

        Above a score that no negative reaches, the unlabelled rows have the
        prior's share of what the positives have; a lower score only adds
        negatives. So the least ratio of the two upper shares is taken, with a
        margin for small counts that also picks the score.
        """
        scale, width = self.scale, len(STATISTICS)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 * bins)
            for batch in batches:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(int)
                place = np.minimum((sigmoid(scale.features(x) @ w) * bins).astype(int), bins - 1)
                total += np.bincount(2 * place + trusted, minlength=2 * bins)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * bins)), pa.array(total)], names=["at", "s"])

        counts = np.zeros((bins, 2))
        found = self.rows.select("x", "trusted").mapInArrow(partial, "at long, s double").groupBy("at").agg(F.sum("s").alias("s"))
        for r in found.collect():
            counts[r["at"] // 2, r["at"] % 2] = r["s"]
        upper = counts[::-1].cumsum(axis=0)[::-1]
        n_u, n_p = np.maximum(counts.sum(axis=0), 1)
        share_u, share_p = upper[:, 0] / n_u, upper[:, 1] / n_p
        margin = np.sqrt(np.log(4 / confidence) / (2 * n_u)) + np.sqrt(np.log(4 / confidence) / (2 * n_p))
        some = share_p > 0
        ratio = share_u[some] / share_p[some]
        best = int((ratio + margin / share_p[some]).argmin())
        return float(np.clip(ratio[best], 0.01, 0.99))


@dataclass(frozen=True)
class Model:
    scale: Scale
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale.features(x) @ self.weights)


def held_out(id_: Column, folds: int) -> Column:
    """Whether a row's label is never learned from; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == 0


def learning_rows(docs: DataFrame, labels: DataFrame, folds: int) -> DataFrame:
    """``doc_id``, ``held_out``, statistics ``x`` and ``trusted``: labelled good,
    and not held out. An id that is labelled twice is trusted if all its labels
    are good. Ids are joined beside statistics, never beside texts."""
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), folds))
        .groupBy(F.col("doc_id").cast("long").alias("_label_id"))
        .agg(F.min("quality").alias("_least"))
        .where("_least = 1")
        .select("_label_id")
    )
    id_ = F.col("doc_id").cast("long")
    rows = docs.select(id_.alias("doc_id"), held_out(id_, folds).alias("held_out"), statistics(F.col("text").cast("string")).alias("x"))
    return rows.join(good, F.col("doc_id") == F.col("_label_id"), "left").select(
        "doc_id", "held_out", "x", F.col("_label_id").isNotNull().alias("trusted")
    )


def fit_positive_unlabelled(
    rows: DataFrame, *, decay: float = 1e-3, sharpness: float = 200.0, steps: int = 25
) -> Model | None:
    """The model, from all rows that are not held out; None without positives.

    A first fit, as if half were positive, only ranks. It sees half of the rows,
    by the hash of their statistics, so copies stay together; how its scores are
    distributed in the other half gives the prior for the second fit, on all
    rows. Few positives call for smoother weights."""
    train = rows.where(~F.col("held_out"))
    measures = [
        f(F.when(F.col("trusted"), F.col("x")[i])).alias(f"{name}{i}")
        for i in range(len(STATISTICS))
        for name, f in (("m", F.avg), ("s", F.stddev_pop))
    ]
    found = train.agg(F.count_if("trusted").alias("n"), *measures).first()
    if not found["n"]:
        return None
    mean = np.array([found[f"m{i}"] for i in range(len(STATISTICS))])
    width = np.array([found[f"s{i}"] for i in range(len(STATISTICS))])
    learner = Learner(train, Scale(mean, np.maximum(width, 1e-3)))
    options = {"decay": decay + 2 / found["n"], "sharpness": sharpness, "steps": steps}
    start = np.zeros(1 + 2 * len(STATISTICS))
    seen = F.xxhash64("x") % 2 == 0
    ranking = replace(learner, rows=train.where(seen)).fit(start, 0.5, **options)
    prior = replace(learner, rows=train.where(~seen)).prior(ranking)
    return Model(learner.scale, np.round(learner.fit(ranking, prior, **options), 6), prior)


def quality_scores(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` and
    ``predicted``.

    Only labels of rows that are not held out, and of them only the good ones,
    are learned from. NULL and empty texts have no words and are scored as such;
    rows that repeat an id are each scored; without trusted positives every score
    is 0.5; an empty table gives no rows. No other column is read.
    """
    rows = staged(learning_rows(docs, labels, folds), "statistics")
    model = fit_positive_unlabelled(rows)
    width = len(STATISTICS)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= threshold).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.select("doc_id", "held_out", "x").mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")
