"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The pieces of a vocabulary file form an automaton. As it reads a text, its output links name all pieces
that end at the current position; each relaxes the best score there, and the path back gives the pieces.
A stretch that no piece covers costs one unknown character, written as byte pieces. Where the
vocabulary allows it (no piece has another character before a space mark, or mixes letters with others),
a text falls into words whose best paths are independent, so the paths of words seen before are looked up.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a vocabulary file
UNKNOWN_PENALTY = 10.0
CACHE = 500_000  # words whose paths a worker keeps, about 120 MB


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, from the driver's disk or any store that Spark reads."""
    if "://" not in path and os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _message(data: bytes):
    """Fields of a protocol-buffer message: number and value."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else (8 if tag & 7 == 1 else 4, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """``(piece, score, kind)`` of a vocabulary file, in the order of their ids."""
    found = []
    for number, value in _message(model):
        if number == 1:
            parts = dict(_message(value))
            score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
            found.append((parts.get(1, b"").decode(), score, parts.get(3, NORMAL)))
    return found


@dataclass
class Vocabulary:
    """What a worker needs of a vocabulary: the automaton, byte pieces, and paths of words seen."""

    pieces: list[tuple[str, float, int]]
    cache: dict = field(default_factory=dict)

    def __post_init__(self):
        self.automaton = ahocorasick.Automaton()
        usable = (NORMAL, USER)
        for i, (piece, score, kind) in enumerate(self.pieces):
            if kind in usable and piece:
                self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        shown = {CONTROL: "", UNKNOWN: " ⁇ "}
        self.bytes_of = [shown.get(kind, p.replace(SPACE, " ")).encode() for p, _, kind in self.pieces]
        for byte, i in self.byte_ids.items():
            self.bytes_of[i] = bytes([byte])
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)
        scores = [s for p, s, kind in self.pieces if kind == NORMAL]
        self.unknown_score = min(scores, default=0.0) - UNKNOWN_PENALTY
        # A best path breaks wherever no piece spans: before a space mark that follows another character,
        # and between letters and other characters, if the vocabulary keeps these apart.
        texts = [p.lstrip(SPACE) for p, _, kind in self.pieces if kind in usable]
        self.words = None
        if not any(SPACE in p for p in texts):
            odd = "".join(sorted(c for c in set().union(*texts) if c.isalnum() and not c.isalpha() and not c.isdecimal()))
            letter, other = f"[^\\W\\d_{odd}]", f"(?:[^\\w{SPACE}]|[\\d_{odd}])"
            mixed = re.compile(f"{letter}{other}|{other}{letter}")
            apart = not any(mixed.search(p) for p in texts)
            one = f"{SPACE}*{letter}+|{SPACE}*{other}+" if apart else f"{SPACE}*[^{SPACE}]+"
            self.words = re.compile(f"{one}|{SPACE}+")

    def viterbi(self, text: str) -> list[int]:
        """Ids of the best path; of equal ones that whose last piece begins first.

        The automaton names the pieces that end at a place longest first, so only a better score replaces.
        """
        n = len(text)
        best, start, piece = [0.0] + [float("-inf")] * n, [0] * (n + 1), [-1] * (n + 1)
        unknown, at = self.unknown_score, 0
        for end, (length, score, number) in self.automaton.iter(text):
            while at < end:  # all pieces that end up to here are in: may an unknown character do better?
                score_unknown = best[at] + unknown
                at += 1
                if score_unknown > best[at]:
                    best[at], start[at], piece[at] = score_unknown, at - 1, -1
            begin = end + 1 - length
            score += best[begin]
            if score > best[end + 1]:
                best[end + 1], start[end + 1], piece[end + 1] = score, begin, number
        while at < n:
            score_unknown = best[at] + unknown
            at += 1
            if score_unknown > best[at]:
                best[at], start[at], piece[at] = score_unknown, at - 1, -1
        out: list[int] = []
        stop = n
        while stop:
            begin = start[stop]
            if piece[stop] >= 0:
                out.append(piece[stop])
            else:
                out += reversed(self.spelled(text[begin:stop]))
            stop = begin
        out.reverse()
        return out

    def spelled(self, character: str) -> list[int]:
        """Byte pieces of a character, or the unknown piece where the vocabulary has none."""
        raw = character.encode("utf-8", "surrogatepass")
        if all(b in self.byte_ids for b in raw):
            return [self.byte_ids[b] for b in raw]
        return [self.unknown]

    def encode(self, text: str | None) -> array | None:
        """Ids of a text; a space becomes a mark, and one is put in front. A mark in the text is spelled in bytes."""
        if text is None:
            return None
        out = array("i")
        if not text:
            return out
        for i, part in enumerate(text.split(SPACE)):  # a mark of the text cannot be told from a space later on
            if i:
                out.extend(self.spelled(SPACE))
            self._add_paths(out, ("" if i else SPACE) + part.replace(" ", SPACE))
        return out

    def _add_paths(self, out: array, marked: str) -> None:
        if self.words is None:
            out.extend(self.viterbi(marked))
            return
        cache, add = self.cache, out.frombytes
        for word in self.words.findall(marked):
            path = cache.get(word)
            if path is None:
                path = array("i", self.viterbi(word)).tobytes()
                if len(word) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[word] = path
            add(path)

    def decode(self, ids: Iterable[int] | None) -> str | None:
        """The text of ids: pieces with spaces for marks, bytes joined to characters, without the space put in front."""
        if ids is None:
            return None
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class SentencePiece:
    """Columns that encode and decode with one vocabulary, sent to the tasks by value (about half a megabyte)."""

    def __init__(self, spark: SparkSession, path: str):
        shared = spark.sparkContext.broadcast({"pieces": read_pieces(read_bytes(spark, path))})

        def vocabulary() -> Vocabulary:
            """Made once per worker: its copy of the broadcast value keeps automaton and paths for later tasks."""
            if "made" not in shared.value:
                shared.value["made"] = Vocabulary(shared.value["pieces"])
            return shared.value["made"]

        def encoded(texts: pa.Array, check) -> pa.ListArray:
            """Ids of all texts, in one buffer; ``check`` sees each text with its ids."""
            words, flat, offsets, unknown = vocabulary(), array("i"), [0], []
            for value in texts:
                text = value.as_py()
                ids = words.encode(text)
                check(words, text, ids)
                unknown.append(ids is None)
                flat.extend(ids or ())
                offsets.append(len(flat))
            values = pa.array(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(unknown, pa.bool_()))

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def encode(texts: pa.Array) -> pa.Array:
            return encoded(texts, lambda words, text, ids: None)

        @F.arrow_udf("ids array<int>, exact boolean")
        def encode_checked(texts: pa.Array) -> pa.Array:
            exact: list[bool] = []
            ids = encoded(texts, lambda words, text, ids: exact.append(words.decode(ids) == text))
            return pa.StructArray.from_arrays([ids, pa.array(exact, pa.bool_())], ["ids", "exact"])

        @F.arrow_udf(T.StringType())
        def decode(ids: pa.Array) -> pa.Array:
            words, flat, offsets = vocabulary(), ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            spans = zip(ids.is_valid().to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist())
            return pa.array([words.decode(flat[a:b].tolist()) if known else None for known, a, b in spans], pa.string())

        self._encode, self._checked, self._decode = encode, encode_checked, decode

    def encode(self, text: str | Column) -> Column:
        """Ids of a text column. Null gives null, an empty text an empty array; texts are encoded whole."""
        return self._encode(text)

    def encode_checked(self, text: str | Column) -> Column:
        """``ids`` as :meth:`encode` makes them, and ``exact``: whether decoding them gives the text (null: null) back.

        One pass in one worker: ids that go to :meth:`decode` as a column take a second worker and are sent twice more.
        """
        return self._checked(text)

    def decode(self, ids: str | Column) -> Column:
        """The text of an id column; exact for whatever :meth:`encode` made. Null gives null."""
        return self._decode(ids)
