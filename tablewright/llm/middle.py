"""Fill-in-the-middle on seekable compressed frames.

Texts are stored as independent zstandard frames of bounded size, each with the
counts of units and characters up to its end. A cut at a unit needs the one
frame that holds it: the two cut frames are decompressed and written again in
two parts, all others move to their new place as they are. Digests and texts
stream the frames in order, one at a time.

A unit is a run of letters A-Z in either case, or one other character.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import staged

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

# The order of the parts in the text and in each form of the output.
TEXT = (PREFIX, MIDDLE, SUFFIX)
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

# Of a frame: units that start before its end, characters before its end, whether
# its first character belongs to the unit before it, and the compressed text.
FRAME = "struct<units: long, chars: long, joined: boolean, data: binary>"
FRAME_ARROW = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("joined", pa.bool_()), ("data", pa.binary())])
FRAMED = f"doc_id long, n long, n_chars long, marked boolean, frames array<{FRAME}>"
FRAMED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("n_chars", pa.int64()),
        ("marked", pa.bool_()),
        ("frames", pa.list_(FRAME_ARROW)),
    ]
)

# Rows that a task holds as Python objects at one time.
ROWS = 256


def unit_starts(text: str, joined: bool) -> np.ndarray:
    """The positions where a unit starts. With ``joined`` the first character, if
    it is a letter, goes on the unit before."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes | 32) - 97 < 26) & (codes < 128)  # unsigned: below "a" wraps around
    before = np.empty_like(letter)
    before[:1], before[1:] = joined, letter[:-1]
    return np.flatnonzero(~(letter & before))


def is_letter(char: str) -> bool:
    return char.isascii() and char.isalpha()


def to_frames(text: str, frame_chars: int, pack: zstandard.ZstdCompressor) -> list[dict]:
    """The frames of a text; an empty text has none."""
    frames, units, joined = [], 0, False
    for at in range(0, len(text), frame_chars):
        part = text[at : at + frame_chars]
        joined = joined and is_letter(part[0])
        units += len(unit_starts(part, joined))
        frames.append(
            {
                "units": units,
                "chars": at + len(part),
                "joined": joined,
                "data": pack.compress(part.encode("utf-8", "surrogatepass")),
            }
        )
        joined = is_letter(part[-1])
    return frames


def from_frame(frame: dict, unpack: zstandard.ZstdDecompressor) -> str:
    return unpack.decompress(frame["data"]).decode("utf-8", "surrogatepass")


def frame_documents(docs: DataFrame, *, frame_chars: int = 32_768, level: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n`` units, ``n_chars``,
    ``marked`` (the text holds a marker) and ``frames``, which hold up to
    ``frame_chars`` characters each. NULL counts as the empty text, which has no
    frames; texts of any length are framed whole; no other column is read."""

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                rows = []
                for row in part.to_pylist():
                    text = row["text"] or ""
                    frames = to_frames(text, frame_chars, pack)
                    rows.append(
                        {
                            "doc_id": row["doc_id"],
                            "n": frames[-1]["units"] if frames else 0,
                            "n_chars": len(text),
                            "marked": any(m in text for m in MARKERS),
                            "frames": frames,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, FRAMED_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frame, FRAMED)


def cut_at(frames: list[dict], unit: int, unpack: zstandard.ZstdDecompressor) -> tuple[int, int]:
    """(frame, characters of it that lie before the unit): only the frame in
    which the unit starts is decompressed."""
    at = bisect_right([f["units"] for f in frames], unit)
    if at == len(frames):
        return at, 0
    starts = unit_starts(from_frame(frames[at], unpack), frames[at]["joined"])
    return at, int(starts[unit - (frames[at - 1]["units"] if at else 0)])


class Parts:
    """The parts of one framed text between cuts, as lists of frames."""

    def __init__(self, pack: zstandard.ZstdCompressor, unpack: zstandard.ZstdDecompressor):
        self.pack, self.unpack = pack, unpack
        self.marks = {m: self.framed(m) for m in MARKERS}

    def framed(self, text: str) -> dict:
        return {"chars": len(text), "data": self.pack.compress(text.encode("utf-8", "surrogatepass"))}

    def between(self, frames: list[dict], low: tuple[int, int], high: tuple[int, int]) -> list[dict]:
        """Frames from one cut to the next, with the characters in each."""
        out = []
        for at in range(low[0], min(high[0] + 1, len(frames))):
            size = frames[at]["chars"] - (frames[at - 1]["chars"] if at else 0)
            start = low[1] if at == low[0] else 0
            end = high[1] if at == high[0] else size
            if start == 0 and end == size:
                out.append({"chars": size, "data": frames[at]["data"]})
            elif start < end:
                out.append(self.framed(from_frame(frames[at], self.unpack)[start:end]))
        return out

    def moved(self, frames: list[dict], form: str, first: int, second: int) -> tuple[list[dict], int | None, int | None]:
        """The output's frames, and the characters of prefix and middle."""
        if form == "plain":
            return self.between(frames, (0, 0), (len(frames), 0)), None, None
        low, high = cut_at(frames, first, self.unpack), cut_at(frames, second, self.unpack)
        parts = {
            PREFIX: self.between(frames, (0, 0), low),
            MIDDLE: self.between(frames, low, high),
            SUFFIX: self.between(frames, high, (len(frames), 0)),
        }
        out = [f for mark in FORMS[form] for f in (self.marks[mark], *parts[mark])]
        sizes = {mark: sum(f["chars"] for f in part) for mark, part in parts.items()}
        return out, sizes[PREFIX], sizes[MIDDLE]


PART = "struct<chars: long, data: binary>"
MOVED = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<{PART}>"
MOVED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.list_(pa.struct([("chars", pa.int64()), ("data", pa.binary())]))),
    ]
)


def draw(id_: Column, seed: int, number: int) -> Column:
    """The ``number``-th 8-digit group of the SHA-256 of seed and id, as a number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * number - 7, 8), 16, 10).cast("long")


def fill_in_middle(framed: DataFrame, *, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """One row per row of ``framed`` (see :func:`frame_documents`): ``doc_id``,
    ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, the frames
    of the new text in order. Put end to end their data is one zstandard stream.

    The prefix ends after the smaller of two drawn numbers of units, the middle
    after the larger. Empty texts, texts with a marker and those above
    ``percent`` stay ``plain``; of the others ``spm_percent`` have the suffix
    first. Draws depend on seed and id alone, so rows that repeat an id draw
    alike; a NULL id draws as the empty text. An empty table gives none.
    """
    h1, h2, h3, h4 = (draw(F.col("doc_id"), seed, i) for i in range(1, 5))
    first, second = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor())
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                rows = []
                for row in part.to_pylist():
                    output, prefix, middle = parts.moved(row["frames"], row["form"], row["first"], row["second"])
                    rows.append({**row, "prefix_chars": prefix, "middle_chars": middle, "output": output})
                yield pa.RecordBatch.from_pylist(rows, MOVED_ARROW)

    drawn = framed.select(
        "doc_id",
        "n",
        form.alias("form"),
        F.least(first, second).alias("first"),
        F.greatest(first, second).alias("second"),
        "frames",
    )
    return drawn.mapInArrow(move, MOVED)


def restored_order(output: list[dict], form: str, unpack: zstandard.ZstdDecompressor) -> Iterator[dict]:
    """The frames of the original text, found from output and form alone."""
    if form == "plain":
        yield from output
        return
    parts: dict[str, list[dict]] = {}
    for frame in output:
        text = from_frame(frame, unpack) if frame["chars"] == len(PREFIX) else ""
        if text in MARKERS:
            mark = text
            parts[mark] = []
        else:
            parts[mark].append(frame)
    for mark in TEXT:
        yield from parts[mark]


def digest(frames: Iterator[dict] | list[dict], unpack: zstandard.ZstdDecompressor) -> str:
    out = hashlib.sha256()
    for frame in frames:
        out.update(unpack.decompress(frame["data"]))
    return out.hexdigest()


def with_digests(moved: DataFrame) -> DataFrame:
    """Adds ``output_sha256`` and ``restored_sha256``, of the UTF-8 bytes of the
    output and of the text put together again from output and form. Frames are
    decompressed one at a time; ``output`` itself is left out."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                rows = part.select(["output", "form"]).to_pylist()
                outputs = [digest(r["output"], unpack) for r in rows]
                restored = [digest(restored_order(r["output"], r["form"], unpack), unpack) for r in rows]
                kept = part.drop_columns(["output"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(outputs, pa.string()), pa.array(restored, pa.string())],
                    names=[*kept.schema.names, "output_sha256", "restored_sha256"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in moved.schema if f.name != "output")
    return moved.mapInArrow(hashed, f"{kept}, output_sha256 string, restored_sha256 string")


def output_text(output: Column) -> Column:
    """The text of a list of frames, of ``fill_in_middle`` or ``frame_documents``."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        unpack = zstandard.ZstdDecompressor()
        for rows in batches:
            yield rows.map(lambda frames: "".join(from_frame(f, unpack) for f in frames))

    return text(output)


def transformed(docs: DataFrame, *, seed: int = 1) -> DataFrame:
    """Documents framed, stored in the shared folder, moved and digested: one row
    per row of ``docs``, as :func:`fill_in_middle` and :func:`with_digests` say."""
    return with_digests(fill_in_middle(staged(frame_documents(docs), "frames"), seed=seed))
