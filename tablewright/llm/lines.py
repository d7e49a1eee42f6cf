"""Line deduplication by winnowing over line hashes.

A window is the shortest stretch of lines, from a line onward or up to a line,
that holds ``min_words`` words. In each window the line with the least hash is
its fingerprint, so equal windows have the same one at the same place, and
windows that lie over each other mostly share it: few lines are selected, and
each run of lines with that many words has one in common with its repeat.

The places of a fingerprint are joined with its first place, and each match is
extended line by line to both sides; windows that lie in the match are repeats.
Behind a common line there may be several texts. The windows that the first
place does not explain are therefore matched once more, by the hash of the whole
stretch. Equal windows share place and surroundings of their fingerprint, so the
first place explains all of them or none: no run is missed, whatever its
fingerprint, and a fingerprint of a third of all rows meets one place only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, row_key, staged

SPACES = b" \t\n\x0b\x0c\r"
DIGEST = 16

# A fingerprint ``fp`` in line ``at`` of the lines with words. ``hashes`` are those
# of all lines that its windows touch, of which it is number ``off``; ``lines``
# their numbers in the text; ``windows`` the first line and the line behind the
# last of each window, counted in ``hashes``.
PRINTS = (
    "_id long, _th long, fp long, at int, off int, hashes binary, lines array<int>, windows array<int>"
)
PRINTS_ARROW = pa.schema(
    [
        ("_id", pa.int64()),
        ("_th", pa.int64()),
        ("fp", pa.int64()),
        ("at", pa.int32()),
        ("off", pa.int32()),
        ("hashes", pa.binary()),
        ("lines", pa.list_(pa.int32())),
        ("windows", pa.list_(pa.int32())),
    ]
)

# Lines from ``start`` to ``end`` that repeat the first place, or, with a hash of
# the stretch, a window that the first place does not explain.
MATCHES = "_id long, _th long, start int, end int, fp long, s1 long, s2 long"
MATCHES_ARROW = pa.schema(
    [
        ("_id", pa.int64()),
        ("_th", pa.int64()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("fp", pa.int64()),
        ("s1", pa.int64()),
        ("s2", pa.int64()),
    ]
)


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def windows_of(sums: list[int], min_words: int) -> list[tuple[int, int]]:
    """First line and line behind the last of each window, by the running number
    of words."""
    n, found, end = len(sums) - 1, set(), 0
    for start in range(n):  # onward from each line
        end = max(end, start + 1)
        while end <= n and sums[end] - sums[start] < min_words:
            end += 1
        if end > n:
            break
        found.add((start, end))
    start = 0
    for end in range(1, n + 1):  # up to each line
        while start + 1 < end and sums[end] - sums[start + 1] >= min_words:
            start += 1
        if sums[end] - sums[start] >= min_words:
            found.add((start, end))
    return sorted(found)


def fingerprints(text: str, min_words: int) -> list[dict]:
    """The selected lines of a text. Of lines with the same least hash in a
    window the first is taken. Lines without a word lie in no window by
    themselves."""
    lines, digests, sums = [], [], [0]
    for at, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        line = line.strip(SPACES)
        if line:
            lines.append(at)
            digests.append(xxhash.xxh3_128_digest(line))
            sums.append(sums[-1] + len(line.split()))
    selected: dict[int, list[tuple[int, int]]] = {}
    for start, end in windows_of(sums, min_words):
        least = digests.index(min(digests[start:end]), start)
        selected.setdefault(least, []).append((start, end))
    out = []
    for at, windows in selected.items():
        low, high = min(w[0] for w in windows), max(w[1] for w in windows)
        out.append(
            {
                "fp": number(digests[at][:8]),
                "at": at,
                "off": at - low,
                "hashes": b"".join(digests[low:high]),
                "lines": lines[low:high],
                "windows": [x - low for w in windows for x in w],
            }
        )
    return out


def extended(own: bytes, off: int, first: bytes, first_off: int) -> tuple[int, int]:
    """First line of ``own``, and line behind the last, of the run around the
    fingerprint that is equal at both places; none if it is not the same line."""
    a = [own[i : i + DIGEST] for i in range(0, len(own), DIGEST)]
    b = [first[i : i + DIGEST] for i in range(0, len(first), DIGEST)]
    if a[off] != b[first_off]:
        return off, off
    back, ahead = 0, 1
    while back < min(off, first_off) and a[off - back - 1] == b[first_off - back - 1]:
        back += 1
    while off + ahead < len(a) and first_off + ahead < len(b) and a[off + ahead] == b[first_off + ahead]:
        ahead += 1
    return off - back, off + ahead


def explained(row: dict) -> Iterator[dict]:
    """The windows of a fingerprint at a later place: those in the match with the
    first place as they are, all others with the hash of their stretch."""
    low, high = extended(row["hashes"], row["off"], row["f_hashes"], row["f_off"])
    key = {"_id": row["_id"], "_th": row["_th"]}
    for start, end in zip(row["windows"][::2], row["windows"][1::2]):
        span = {**key, "start": row["lines"][start], "end": row["lines"][end - 1]}
        if low <= start and end <= high:
            yield {**span, "fp": None, "s1": None, "s2": None}
        else:
            whole = xxhash.xxh3_128_digest(row["hashes"][start * DIGEST : end * DIGEST])
            yield {**span, "fp": row["fp"], "s1": number(whole[:8]), "s2": number(whole[8:])}


def without_lines(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the lines from ``start`` to ``end`` of each span."""
    kept, at = [], 0
    lines = text.split("\n")
    for start, end in sorted(spans):
        kept += lines[at:start] if start > at else []
        at = max(at, end + 1)
    return "\n".join(kept + lines[at:])


def repeated_runs(docs: DataFrame, *, min_words: int = 50) -> DataFrame:
    """``_id``, ``_th`` and ``cuts`` (spans of line numbers) of each text with
    lines to delete. Kept is the first place in the order of id (NULL first),
    text hash and line."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                rows = [
                    {"_id": row["_id"], "_th": row["_th"], **found}
                    for row in part.to_pylist()
                    for found in fingerprints(row["text"], min_words)
                ]
                yield pa.RecordBatch.from_pylist(rows, PRINTS_ARROW)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                rows = [found for row in part.to_pylist() for found in explained(row)]
                yield pa.RecordBatch.from_pylist(rows, MATCHES_ARROW)

    texts = docs.select(*row_key("doc_id", "text"), "text").where("text IS NOT NULL")
    texts = texts.select(F.col("_id").cast("long").alias("_id"), "_th", "text")
    found = staged(texts.mapInArrow(select, PRINTS), "line-prints")
    # the first place of each fingerprint that has several, reduced in the map tasks
    first = (
        found.groupBy("fp")
        .agg(F.min(F.struct("_id", "_th", "at", "off", "hashes")).alias("f"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("fp").alias("f_fp"), "f")
    )
    place = F.struct("_id", "_th", "at")
    later = found.join(first, F.col("fp") == F.col("f_fp")).where(place > F.struct("f._id", "f._th", "f.at"))
    joined = later.select(
        *found.columns, F.col("f.off").alias("f_off"), F.col("f.hashes").alias("f_hashes")
    ).mapInArrow(match, MATCHES)
    matches = staged(joined, "line-matches")

    # behind a common line: texts that the first place does not have
    rest = matches.where("s1 IS NOT NULL")
    place = F.struct("_id", "_th", "start")
    heads = (
        rest.groupBy("fp", "s1", "s2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("fp").alias("f_fp"), F.col("s1").alias("f_s1"), F.col("s2").alias("f_s2"), "first")
    )
    same = (F.col("fp") == F.col("f_fp")) & (F.col("s1") == F.col("f_s1")) & (F.col("s2") == F.col("f_s2"))
    more = rest.join(heads, same).where(place > F.col("first"))
    spans = ["_id", "_th", "start", "end"]
    every = matches.where("s1 IS NULL").select(*spans).unionAll(more.select(*spans))
    return every.groupBy("_id", "_th").agg(F.collect_set(F.struct("start", "end")).alias("cuts"))


def dedup_lines(docs: DataFrame, *, min_words: int = 50, cuts_as: str | None = None) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from ``text``.

    A line goes if it lies in a stretch of lines with ``min_words`` words or
    more that occurs at an earlier place, in another text or the same one (there
    the two may overlap). Lines are compared without white space at their ends;
    lines without a word neither count nor part a run, and go if they lie inside
    a shortest such stretch. A text that loses all its lines stays, empty. Repeated rows
    of one id and text count as one place. NULL texts stay NULL, an empty table
    gives none, and texts of any length are taken whole. All columns of ``docs``
    are returned; ``cuts_as`` names one more with the deleted spans.
    """
    cuts = repeated_runs(docs, min_words=min_words)
    name = free_name(docs, "_cuts")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [None if t is None else without_lines(t, [(s["start"], s["end"]) for s in c]) for t, c in zip(texts, spans)],
            dtype=object,
        )

    id_, th = free_name(docs, "_id"), free_name(docs, "_th")
    keyed = docs.select("*", F.col("doc_id").alias(id_), F.xxhash64("text").alias(th))
    right = cuts.select(F.col("_id").alias(id_ + "r"), F.col("_th").alias(th + "r"), F.col("cuts").alias(name))
    joined = keyed.join(right, F.col(id_).eqNullSafe(F.col(id_ + "r")) & (F.col(th) == F.col(th + "r")), "left")
    # untouched texts do not travel to Python
    new = F.when(F.col(name).isNotNull(), cut(F.when(F.col(name).isNotNull(), F.col("text")), F.col(name)))
    out = [F.coalesce(new, F.col("text")).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*out, *([F.col(name).alias(cuts_as)] if cuts_as else []))
