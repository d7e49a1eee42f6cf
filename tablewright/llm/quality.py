"""Quality rules: gradient-boosted trees over document statistics.

The trees are trained here on a bounded sample of labelled rows, with a sign
fixed for the features that may only lower the score, and flattened into numpy
node arrays. Statistics and score of a batch of documents are one call in the
Python worker; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "shout_share",
    "distinct_share",
    "words_per_line",
    "stops_per_word",
)
# Features that may only lower the score: more of them never makes a document better.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "shout_share": -1}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    counts, total, covered = Counter(grams), 0, 0
    for at, gram in enumerate(grams):
        if counts[gram] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def text_stats(text: str | None) -> tuple:
    """The base counts of one text, then its features. NULL has no words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # splits bytes at exactly the six ASCII white-space characters
    n, size = len(words), max(len(raw), 1)
    word_chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    some, chars = max(n, 1), max(word_chars, 1)
    return (
        n,
        word_chars,
        symbols,
        dup_lines,
        repeats,
        np.log1p(n),
        word_chars / some,
        symbols / chars,
        dup_lines / max(len(lines), 1),
        repeats / some,
        (len(raw) - len(raw.translate(None, UPPER))) / size,
        (len(raw) - len(raw.translate(None, DIGITS))) / size,
        (raw.count(b"!") + raw.count(b"?")) / some,
        len(set(words)) / some,
        n / max(len(lines), 1),
        raw.count(b".") / some,
    )


def stats_frame(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in texts], columns=[*BASE, *FEATURES], index=texts.index)


@dataclass
class FlatTrees:
    """All trees in five arrays; a leaf points to itself on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of good quality, for each row of ``x``."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    *,
    n_trees: int = 40,
    depth: int = 3,
    bins: int = 48,
    rate: float = 0.2,
    l2: float = 1.0,
    min_rows: int = 5,
) -> FlatTrees:
    """Newton boosting on the log loss over binned features.

    ``monotone`` maps a feature to +1 or -1. A split on such a feature is taken
    only if the two sides' weights are in that order, and the midpoint of the
    two then bounds all weights further down, so the sum of trees is monotone.
    With no rows or one class the result is a constant.
    """
    monotone = monotone or {}
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1 - 1e-3
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(weight: float) -> int:
        me = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(me), right.append(me), value.append(weight)
        return me

    if len(y) and 0 < y.mean() < 1:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        raw = np.full(len(y), base)
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = p - y, p * (1 - p)
            root = node(0.0)
            roots.append(root)
            todo = [(root, np.arange(len(y)), -np.inf, np.inf, 0)]
            while todo:
                me, rows, low, high, level = todo.pop()
                g_all, h_all = g[rows].sum(), h[rows].sum()
                weight = float(np.clip(-g_all / (h_all + l2), low, high))
                best = None
                for f in range(x.shape[1]) if level < depth else ():
                    if not len(edges[f]):
                        continue
                    b, width = binned[rows, f], len(edges[f]) + 1
                    gl = np.bincount(b, g[rows], width).cumsum()[:-1]
                    hl = np.bincount(b, h[rows], width).cumsum()[:-1]
                    nl = np.bincount(b, minlength=width).cumsum()[:-1]
                    wl = np.clip(-gl / (hl + l2), low, high)
                    wr = np.clip(-(g_all - gl) / (h_all - hl + l2), low, high)
                    gain = -(gl * wl + 0.5 * (hl + l2) * wl**2)
                    gain -= (g_all - gl) * wr + 0.5 * (h_all - hl + l2) * wr**2
                    fits = (nl >= min_rows) & (len(rows) - nl >= min_rows)
                    if f in monotone:
                        fits &= monotone[f] * (wr - wl) >= 0
                    if fits.any():
                        cut = int(np.where(fits, gain, -np.inf).argmax())
                        if best is None or gain[cut] > best[0]:
                            best = (gain[cut], f, cut, float(wl[cut]), float(wr[cut]))
                alone = -(g_all * weight + 0.5 * (h_all + l2) * weight**2)
                if best is None or best[0] <= alone + 1e-6:
                    value[me] = rate * weight
                    raw[rows] += rate * weight
                    continue
                _, f, cut, wl_, wr_ = best
                feature[me], threshold[me] = f, float(edges[f][cut])
                left[me], right[me] = node(0.0), node(0.0)
                sides, middle = [(low, high), (low, high)], (wl_ + wr_) / 2
                if monotone.get(f) == 1:
                    sides = [(low, middle), (middle, high)]
                elif monotone.get(f) == -1:
                    sides = [(middle, high), (low, middle)]
                goes = binned[rows, f] <= cut
                todo.append((left[me], rows[goes], *sides[0], level + 1))
                todo.append((right[me], rows[~goes], *sides[1], level + 1))
    return FlatTrees(
        np.array(feature, np.int32),
        np.array(threshold, float),
        np.array(left, np.int32),
        np.array(right, np.int32),
        np.array(value, float),
        np.array(roots, np.int32),
        depth,
        base,
    )


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, seed: int = 7) -> pd.DataFrame:
    """Features and label of at most ``max_rows`` labelled documents: those whose
    hashed id is least. An id labelled twice counts once, as its lower label."""
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(max_rows)
    )

    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield stats_frame(texts)[list(FEATURES)]

    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # repeated ids may bring more rows than labels; the bound holds for rows too, in a fixed order
    drawn = found.select("doc_id", F.xxhash64("text").alias("th"), features("text").alias("f"), "y")
    kept = drawn.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "th").limit(max_rows)
    return kept.select("f.*", "y").toPandas()


def fit_quality(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000) -> FlatTrees:
    """Trains on at most ``max_rows`` labelled documents (the only bound here;
    statistics and verdicts cover every document)."""
    rows = training_rows(docs, labels, max_rows).sort_values([*FEATURES, "y"])
    signs = {FEATURES.index(name): sign for name, sign in MONOTONE.items()}
    return fit_trees(rows[list(FEATURES)].to_numpy(float), rows["y"].to_numpy(float), signs)


JUDGED = ", ".join(f"{c} long" for c in BASE) + ", score double, base_failed boolean, kept boolean"


def verdict(text: Column, trees: FlatTrees, *, threshold: float = 0.5, min_words: int = 50) -> Column:
    """One struct per text: the base counts, the score and the verdict.

    ``base_failed``: fewer than ``min_words`` words, or over half of them in
    repeated 3-word windows. ``kept``: not failed and scored at or above
    ``threshold``. NULL and empty texts have no words and fail; a text of any
    length is judged whole.
    """

    @F.pandas_udf(JUDGED)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            stats = stats_frame(texts)
            out = stats[list(BASE)].astype("int64")
            out["score"] = trees.score(stats[list(FEATURES)].to_numpy(float).reshape(len(stats), len(FEATURES)))
            out["base_failed"] = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
            out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
            yield out

    return judge(text)


def quality_rules(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, base counts, ``score``,
    ``base_failed`` and ``kept``. Rows that repeat an id are each judged; an empty
    table gives no rows, and without labels every text has one score; no other
    column of ``docs`` is read, so their names may clash with these."""
    trees = fit_quality(docs, labels, max_rows=max_rows)
    judged = docs.select("doc_id", verdict(F.col("text"), trees, threshold=threshold).alias("v"))
    return judged.select("doc_id", "v.*")
