"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reports, at each position of the text,
all pieces that end there, longest first along the output links; one pass of
Viterbi relaxes the best way to reach the position over them. For a unigram
model the best way is the highest sum of scores. A BPE model has no such sum: its
result is the one path on which all neighbouring pieces are stable under the
model's merges, so there a way may be extended only by such a neighbour, and at
most one way reaches a position.

Words are encoded once per worker and then looked up; words at which no piece
can cross are cut beforehand, so this changes no result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the model file format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"
UNKNOWN_PENALTY = 10.0


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a serialized message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What encoding and decoding need of a model file."""

    pieces: list[str]
    scores: list[float]
    types: list[int]
    kind: int
    byte_fallback: bool
    dummy_prefix: bool
    squeeze_spaces: bool
    raw: bytes | None  # the whole file, for models that map characters first


def read_model(path: str) -> Model:
    """Reads a model file on the driver; it is bounded by its vocabulary."""
    with open(path, "rb") as file:
        raw = file.read()
    pieces, scores, types = [], [], []
    trainer, normalizer = {}, {}
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
            types.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE) or USER_DEFINED in types or trainer.get(24, 0):
        raise ValueError("only unigram and BPE models without user-defined pieces and with leading spaces")
    return Model(
        pieces,
        scores,
        types,
        kind,
        bool(trainer.get(35, 0)),
        bool(normalizer.get(3, 1)),
        bool(normalizer.get(4, 1)),
        raw if normalizer.get(2) else None,
    )


class Words(dict):
    """Ids by word. A full table becomes the older one, from which words in use
    come back, so what many texts share stays and memory is bounded."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word.replace(" ", SPACE))
        if len(word) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Coder:
    """Encoder and decoder of one model, with its caches."""

    def __init__(self, model: Model, max_words: int = 400_000):
        self.model = model
        self.ids, self.automaton = {}, ahocorasick.Automaton()
        crossing = False
        for number, (piece, kind) in enumerate(zip(model.pieces, model.types)):
            if kind == NORMAL and piece:
                self.ids[piece] = number
                self.automaton.add_word(piece, (number, len(piece)))
                crossing |= bool(re.search(f"[^{SPACE}]{SPACE}|\n", piece))
        self.automaton.make_automaton()
        self.unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else 0
        self.bytes = {int(p[1:-1], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        self.lowest = min((model.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        self.table = [self.spelt(i) for i in range(len(model.pieces))]
        self.stable_pairs: dict[int, bool] = {}
        self.steps: dict[int, list | None] = {}
        self.stride = len(model.pieces)
        self.known = {c for c in self.ids if len(c) == 1}
        self.words = Words(self.bpe if model.kind == BPE else self.viterbi, max_words)
        # where a piece may run on behind a space or line end, or unknown characters join, texts stay whole
        whole = crossing or not (model.byte_fallback and self.bytes)
        self.cut = None if whole else re.compile(f"\n|[ {SPACE}]+[^ {SPACE}\n]*|[^ {SPACE}\n]+").findall
        self.normalizer = None
        if model.raw:
            import sentencepiece

            self.normalizer = sentencepiece.SentencePieceProcessor(model_proto=model.raw).normalize

    def spelt(self, number: int) -> bytes:
        kind, piece = self.model.types[number], self.model.pieces[number]
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def merges(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """BPE by its definition, for short strings: the best neighbouring pair
        is joined, the leftmost of equals, until none is a piece. Also the score
        of each join, and the last and first part after it."""
        parts, ids, scores, steps = list(text), self.ids, self.model.scores, []
        while len(parts) > 1:
            best = None
            for i, pair in enumerate(zip(parts, parts[1:])):
                number = ids.get(pair[0] + pair[1])
                if number is not None and (best is None or scores[number] > best[0]):
                    best = scores[number], i
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            steps.append((best[0], parts[-1], parts[0]))
        return parts, steps

    def steps_of(self, number: int) -> list[tuple[float, str, str]] | None:
        """How a piece comes about, or None if its own text ends in other pieces."""
        if number not in self.steps:
            piece = self.model.pieces[number]
            parts, steps = self.merges(piece)
            self.steps[number] = steps if parts == [piece] else None
        return self.steps[number]

    def stable(self, left: int, right: int) -> bool:
        """Whether two pieces side by side stay as they are; ``left`` -1 is the
        start. Each comes about by its own joins, best first; the two are
        parted as long as no join across the border is better than those due."""
        a, b = self.steps_of(left) if left >= 0 else [], self.steps_of(right)
        found = b is not None and (left < 0 or self.parted(left, right, a, b))
        if len(self.stable_pairs) > 1_000_000:
            self.stable_pairs.clear()
        self.stable_pairs[left * self.stride + right] = found
        return found

    def parted(self, left: int, right: int, a: list, b: list) -> bool:
        ids, scores = self.ids, self.model.scores
        last, first = self.model.pieces[left], self.model.pieces[right]
        if last + first in ids:
            return False
        last, first, i, j = last[-1], first[0], 0, 0
        while True:
            across = ids.get(last + first)
            due_a = a[i][0] if i < len(a) else None
            due_b = b[j][0] if j < len(b) else None
            if across is not None:
                score = scores[across]
                if (due_a is None or score > due_a) and (due_b is None or score >= due_b):
                    return False
            if due_a is None and due_b is None:
                return True
            if due_b is None or (due_a is not None and due_a >= due_b):
                last, i = a[i][1], i + 1
            else:
                first, j = b[j][2], j + 1

    def fallback(self, char: str) -> tuple[int, ...]:
        if self.model.byte_fallback and self.bytes:
            return tuple(self.bytes[b] for b in char.encode("utf-8", "replace"))
        return (self.unknown,)

    def bpe(self, text: str) -> tuple[int, ...]:
        """The pieces of a stretch of text under a BPE model."""
        if not self.known.issuperset(text):  # no piece holds such a character, so none crosses it
            out, run = [], []
            for char in text:
                if char in self.known:
                    run.append(char)
                    continue
                out += self.bpe("".join(run)) if run else ()
                run.clear()
                out += self.fallback(char)
            return self.joined(out + list(self.bpe("".join(run)) if run else ()))
        # every prefix has exactly one stable way, so positions are reached in order
        known, stable, stride = self.stable_pairs.get, self.stable, self.stride
        last, size, reached = [-1], [0], 0
        for end, (piece, length) in self.automaton.iter(text):
            if end < reached:
                continue
            left = last[end + 1 - length]
            ok = known(left * stride + piece)
            if ok or (ok is None and stable(left, piece)):
                last.append(piece)
                size.append(length)
                reached += 1
        out = []
        while reached > 0:
            out.append(last[reached])
            reached -= size[reached]
        out.reverse()
        return tuple(out)

    def viterbi(self, text: str) -> tuple[int, ...]:
        """The pieces of a stretch of text under a unigram model."""
        n, scores, known = len(text), self.model.scores, self.known
        best: list = [0.0] + [None] * n  # score of the best way to each position
        last, size = [-1] * (n + 1), [0] * (n + 1)
        done = 0

        def settle(upto: int) -> None:
            """Characters that are no piece are steps of their own."""
            nonlocal done
            for at in range(done + 1, upto + 1):
                if text[at - 1] not in known:
                    way = best[at - 1] + self.lowest
                    if best[at] is None or way > best[at]:
                        best[at], last[at], size[at] = way, -1, 1
            done = max(done, upto)

        for end, (piece, length) in self.automaton.iter(text):
            end += 1
            settle(end - 1)
            way = best[end - length] + scores[piece]
            # of equal sums the way with the longer last piece, met first, stays
            if best[end] is None or way > best[end]:
                best[end], last[end], size[end] = way, piece, length
        settle(n)
        out, at = [], n
        while at > 0:
            out.append(self.fallback(text[at - 1]) if last[at] == -1 else (last[at],))
            at -= size[at]
        return self.joined(list(chain.from_iterable(reversed(out))))

    def joined(self, ids: list[int]) -> tuple[int, ...]:
        """Unknown characters side by side are one unknown piece."""
        if self.model.byte_fallback and self.bytes:
            return tuple(ids)
        return tuple(x for i, x in enumerate(ids) if x != self.unknown or i == 0 or ids[i - 1] != x)

    def normalized(self, text: str) -> str:
        """The text as pieces see it, but with plain spaces."""
        if self.normalizer:
            return self.normalizer(text).replace(SPACE, " ")
        if self.model.squeeze_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        return f" {text}" if text and self.model.dummy_prefix else text

    def encode(self, text: str) -> list[int]:
        text = self.normalized(text)
        if self.cut is None:
            return list(self.words.encode(text.replace(" ", SPACE)))
        return list(chain.from_iterable(map(self.words.__getitem__, self.cut(text))))

    def decode(self, ids: list[int]) -> str:
        """The text of pieces; broken byte sequences become replacement characters."""
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


OUT = "doc_id long, token_ids array<int>, n_tokens long, round_trip boolean"


def encode_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``token_ids``, ``n_tokens`` and
    ``round_trip`` (the decoded ids are the normalized text again).

    NULL texts have NULL ids, empty ones none; both count as round trips. Texts
    are encoded whole, whatever their length; rows that repeat are each encoded;
    an empty table gives no rows; no other column is read. The model is broadcast;
    each task builds its automaton, since one that outlived it would hold its
    caches while other stages run.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    lead = 1 if model.dummy_prefix else 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(known.value)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids, offsets, trips = [], [0], []
                texts = part.column("text").to_pylist()
                for text in texts:
                    got = coder.encode(text) if text else []
                    ids.append(np.array(got, np.int32))
                    offsets.append(offsets[-1] + len(got))
                    # a literal space mark reads as the space it stands for
                    plain = coder.normalized(text)[lead:].replace(SPACE, " ") if text else ""
                    trips.append(coder.decode(got) == plain)
                flat = pa.array(np.concatenate(ids) if ids else np.array([], np.int32), pa.int32())
                nulls = pa.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat, mask=nulls)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        lists,
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(trips, pa.bool_()),
                    ],
                    names=["doc_id", "token_ids", "n_tokens", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, OUT)


def decode_documents(encoded: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``encoded``: ``doc_id`` and ``text``, the text that its
    ``token_ids`` spell.

    Bytes that are no character by themselves become replacement characters,
    ids that are NULL or not in the vocabulary the mark of an unknown piece. NULL
    ids give NULL, no ids the empty text. Lists of any length are decoded whole,
    rows that repeat are each decoded, an empty table gives no rows, and no other
    column is read. What encoding loses, white space that the model squeezes or
    characters that it maps, does not come back.
    """
    known = encoded.sparkSession.sparkContext.broadcast(model)
    unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else 0
    size = len(model.pieces)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(known.value)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = []
                for ids in part.column("token_ids").to_pylist():
                    if ids is not None and not all(x is not None and 0 <= x < size for x in ids):
                        ids = [x if x is not None and 0 <= x < size else unknown for x in ids]
                    texts.append(None if ids is None else coder.decode(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
                )

    ids = F.col("token_ids").cast("array<int>")
    return encoded.select(F.col("doc_id").cast("long"), ids.alias("token_ids")).mapInArrow(decode, "doc_id long, text string")
