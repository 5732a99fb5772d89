"""Packing token sequences by vector bin packing.

Examples are placed under three limits at once: tokens, segments and loss-bearing tokens of a sequence. The
next example of an open sequence is the fitting one whose demand has the largest dot product with the
room that is left, each dimension weighted by its mean demand. Where nothing fits and cutting is allowed, an
example is cut to the room. Each task packs its own rows from a window of bounded size, so there is no
shuffle, no key and no group, and a lost task is simply run again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.sentencepiece import read_bytes

CHUNK_BYTES = 8 << 20  # texts encoded at once
WINDOW = 4096  # examples that a sequence chooses from
CACHE = 200_000  # recurring words whose ids a worker keeps
#: Letters, then marks that neither open a contraction nor occur in a special token.
LETTERS_AND_MARKS = re.compile(r"([^\W\d_]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]+)")
GONE = 1 << 40  # size of an example that has been placed: fits nowhere


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold. ``loss_tokens`` are those that the loss reads."""

    tokens: int = 2048
    segments: int = 512
    loss_tokens: int = 2048


class WordEncoder:
    """Ids of many texts at once: every distinct word of a chunk is encoded once.

    The tokenizer drops white space and no token crosses it, so the ids of a text are those of its words
    between ASCII white space, one after the other.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        ends = [suffix is not None and t.endswith(suffix) for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]
        self.ends_word = np.array(ends) if suffix else None
        normalizer = self.tokenizer.normalizer
        self.folds = normalizer is not None and normalizer.normalize_str("Ab") == "ab"
        self.known: dict[str, int] = {}  # recurring words, numbered
        self.known_ids, self.known_sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has; the tokenizer says which word an id belongs to."""
        groups = [words[i : i + 100] for i in range(0, len(words), 100)]
        found = self.tokenizer.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        sizes = [np.bincount(np.array(e.word_ids, np.int64), minlength=len(g)) for g, e in zip(groups, found)]
        ids = [np.array(e.ids, np.uint32) for e in found]
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate([*sizes, np.zeros(0, np.int64)])

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, joined to texts: each word ends at an id that ends a word.

        A word of letters has at least one end, so as many ends as words show that each has one. If they
        differ, or the vocabulary marks no ends, words are encoded one by one.
        """
        if self.ends_word is None:
            return self._encode_words(words)
        texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([*(np.array(e.ids, np.uint32) for e in found), np.zeros(0, np.uint32)])
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self._encode_words(words)

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of words. Letters with marks behind are encoded apart: no token spans both."""
        stems, others, first, second = {}, {"": 0}, [], []
        for word in words:
            tail = ""
            split = None if word.isalpha() else LETTERS_AND_MARKS.fullmatch(word)
            if split and split[1].lower().isalpha():  # a letter may fold to one and a mark, which joins the marks behind
                word, tail = split.groups()
            if word.isalpha():
                word = word.lower() if self.folds and word.isascii() else word
                first.append(2 * stems.setdefault(word, len(stems)))
            else:
                first.append(2 * others.setdefault(word, len(others)) + 1)
            second.append(others.setdefault(tail, len(others)))
        parts = [self._encode_letters(list(stems)), self._encode_words(list(others))]
        ids, sizes = (np.concatenate(column) for column in zip(*parts))
        first, second = np.array(first, np.int64), np.array(second, np.int64)
        whole = np.where(first % 2 == 0, first // 2, first // 2 + len(stems))
        both = np.stack((whole, second + len(stems)), 1)
        return _gathered(ids, np.cumsum(sizes) - sizes, sizes, both.ravel()), sizes[both].sum(1)

    def _numbered(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each word, and ids and sizes of all numbers. Words that recur are kept for later chunks."""
        names = words.to_pylist()
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(number < 0)
        ids, sizes = self._encode_new([names[i] for i in fresh.tolist()])
        number[fresh] = len(self.known_sizes) + np.arange(len(fresh))
        all_ids, all_sizes = np.concatenate((self.known_ids, ids)), np.concatenate((self.known_sizes, sizes))
        kept = np.flatnonzero((counts[fresh] > 1) & (sizes < 32))[: max(0, CACHE - len(self.known))]
        for n, i in enumerate(fresh[kept].tolist(), len(self.known)):
            self.known[names[i]] = n
        self.known_ids = np.concatenate((self.known_ids, _gathered(ids, np.cumsum(sizes) - sizes, sizes, kept)))
        self.known_sizes = np.concatenate((self.known_sizes, sizes[kept]))
        return number, all_ids, all_sizes

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``end_id``, and the offsets of the texts in them."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        words = split.flatten().dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        number, flat, all_sizes = self._numbered(words.dictionary, np.bincount(which, minlength=len(words.dictionary)))
        sizes, firsts = all_sizes[number], (np.cumsum(all_sizes) - all_sizes)[number]
        lengths = sizes[which]
        text_of = np.repeat(np.arange(len(texts)), per_text)
        starts = np.cumsum(lengths) - lengths + text_of  # one place is kept free after each earlier text
        tokens = np.bincount(text_of, weights=lengths, minlength=len(texts)).astype(np.int64) + 1
        offsets = np.concatenate(([0], np.cumsum(tokens)))
        out = np.full(int(offsets[-1]), end_id, np.uint32)
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(starts, lengths) + within] = flat[np.repeat(firsts[which], lengths) + within]
        return out, offsets


def _gathered(flat: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen runs of ``flat``, one after the other."""
    lengths = sizes[chosen]
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return flat[np.repeat(firsts[chosen], lengths) + within]


def power_below(n: int) -> int:
    """The largest power of two up to ``n``."""
    return 1 << (n.bit_length() - 1)


class Packer:
    """Examples in, sequences of ``(example, start, length)`` out.

    Each example takes one segment, so segments add the same to every dot product and only limit.

    An example has ``n`` tokens, of which those from ``loss_from`` on bear loss. With ``cut``, pieces fill every
    sequence to the limit of tokens or, where segments or loss run out first or the examples end, to a power of
    two. Without, an example is cut only where it exceeds a limit by itself.
    """

    def __init__(self, limits: Limits, cut: bool, window: int = WINDOW):
        self.limits, self.cut, self.window = limits, cut, window
        self.examples: list = []
        size = 2 * window
        self.start, self.end, self.loss_from = (np.zeros(size, np.int64) for _ in range(3))
        self.tokens, self.loss = np.full(size, GONE), np.zeros(size, np.int64)
        self.n = self.alive = self.left = 0

    def _loss(self, start: int, end: int, loss_from: int) -> int:
        return max(0, end - max(start, loss_from))

    def _put(self, example, start: int, end: int, loss_from: int) -> None:
        if self.n == len(self.tokens):
            self._compact()
        at = self.n
        self.examples[at:] = [example]
        self._set(at, start, end, loss_from)
        self.n, self.alive, self.left = at + 1, self.alive + 1, self.left + end - start

    def _set(self, at: int, start: int, end: int, loss_from: int) -> None:
        self.start[at], self.end[at], self.loss_from[at] = start, end, loss_from
        self.tokens[at], self.loss[at] = end - start, self._loss(start, end, loss_from)

    def _compact(self) -> None:
        keep = np.flatnonzero(self.tokens[: self.n] < GONE)
        for a in (self.start, self.end, self.loss_from, self.loss, self.tokens):
            a[: len(keep)] = a[keep]
        self.examples = [self.examples[i] for i in keep.tolist()]
        self.n = len(keep)
        if self.n > len(self.tokens) // 2:
            grow = lambda a, fill: np.concatenate((a, np.full(len(a), fill, np.int64)))
            self.start, self.end, self.loss_from, self.loss = (grow(a, 0) for a in (self.start, self.end, self.loss_from, self.loss))
            self.tokens = grow(self.tokens, GONE)
        self.tokens[self.n :] = GONE

    def add(self, example, n: int, loss_from: int = 0) -> Iterator[list]:
        """Take one example; yields the sequences that this completes."""
        at, most = 0, self.limits
        while n - at > most.tokens or self._loss(at, n, loss_from) > most.loss_tokens:
            size = min(most.tokens, max(loss_from - at, 0) + most.loss_tokens, n - at)
            if size == most.tokens:
                yield [(example, at, size)]
            else:
                self._put(example, at, at + size, loss_from)
            at += size
        if n > at:
            self._put(example, at, n, loss_from)
        while self.alive >= self.window:
            yield self._sequence()

    def finish(self) -> Iterator[list]:
        while self.alive:
            yield self._sequence()

    def _take(self, at: int, size: int) -> tuple:
        piece = (self.examples[at], int(self.start[at]), size)
        self.left -= size
        if size == self.tokens[at]:
            self.tokens[at], self.examples[at] = GONE, None
            self.alive -= 1
        else:
            self._set(at, self.start[at] + size, self.end[at], self.loss_from[at])
        return piece

    def _sequence(self) -> list:
        most = self.limits
        room = power_below(self.left) if self.cut and self.left < most.tokens else most.tokens
        segments, loss_room, pieces, origin = most.segments, most.loss_tokens, [], []
        tokens, loss = self.tokens[: self.n], self.loss[: self.n]
        there = tokens < GONE
        weight_tokens = tokens[there].mean() / most.tokens**3  # demand, room and mean demand, each a share of the limit
        weight_loss = loss[there].mean() / most.loss_tokens**3
        while room and segments and self.alive:
            score = tokens * (weight_tokens * room) + loss * (weight_loss * loss_room)
            score[(tokens > room) | (loss > loss_room)] = -1.0
            at = int(score.argmax())
            size = int(tokens[at])
            if score[at] < 0:
                if not self.cut:
                    break
                sizes = np.minimum(np.maximum(self.loss_from[: self.n] - self.start[: self.n], 0) + loss_room, room)
                at = int(np.where((tokens < GONE) & (sizes > 0), tokens, -1).argmax())
                size = int(sizes[at])
                if size <= 0 or tokens[at] >= GONE:
                    break
            origin.append((at, int(self.end[at]), int(self.loss_from[at])))
            loss_room -= self._loss(int(self.start[at]), int(self.start[at]) + size, int(self.loss_from[at]))
            pieces.append(self._take(at, size))
            room, segments = room - size, segments - 1
        if self.cut:
            self._trim(pieces, origin)
        return pieces

    def _trim(self, pieces: list, origin: list) -> None:
        """Give back what exceeds a power of two, where a sequence is not full."""
        length = sum(p[2] for p in pieces)
        over = 0 if length == self.limits.tokens else length - power_below(length)
        while over:
            example, start, size = pieces.pop()
            _, end, loss_from = origin.pop()
            back = min(size, over)
            over -= back
            if size > back:
                pieces.append((example, start, size - back))
                origin.append((None, end, loss_from))
            self._put(example, start + size - back, start + size, loss_from)


OUT = "start long, length long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


def _packed(rows: Iterable[tuple], limits: Limits, cut: bool, key_type: pa.DataType, window: int) -> Iterator[pa.RecordBatch]:
    """Batches of pieces from ``(key, ids, loss_from)``; ids are copied, so that no chunk is kept for one example."""
    packer, done, held, number = Packer(limits, cut, window), [], 0, 0
    first = TaskContext.get().partitionId() << 33

    def batch() -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "loss_tokens", "ids"]
        types = [key_type, *[pa.int64()] * 6, pa.binary()]
        columns = zip(*done) if done else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def place(sequence: list) -> None:
        nonlocal held, number
        offset = 0
        for (key, ids, loss_from), start, length in sequence:
            loss = max(0, start + length - max(start, loss_from))
            done.append((key, start, length, len(ids), first + number, offset, loss, ids[start : start + length].tobytes()))
            offset += length
            held += 4 * length + 64
        number += 1

    for key, ids, loss_from in rows:
        for sequence in packer.add((key, ids, loss_from), len(ids), loss_from):
            place(sequence)
        if held > CHUNK_BYTES:
            yield batch()
            done, held = [], 0
    for sequence in packer.finish():
        place(sequence)
    yield batch()


def pack(
    examples: DataFrame,
    limits: Limits = Limits(),
    cut: bool = False,
    key: str = "doc_id",
    ids: str = "ids",
    loss_from: str | None = None,
    window: int = WINDOW,
) -> DataFrame:
    """Pieces of token sequences: key (as ``doc_id``), ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``loss_tokens``, ``ids``.

    ``ids`` is an array of token ids, ``loss_from`` the column with the number of leading tokens that bear no
    loss (null: none, as without the column). A sequence's pieces lie one after the other from offset 0. Ids come
    back as little-endian unsigned 32-bit numbers. A null or empty array gives no piece; null keys and repeated
    rows are packed like any other. Other columns are ignored. An empty table gives no rows. The placing depends
    on how the rows are dealt over tasks, the pieces of an example always add up to it.
    """
    loss = F.coalesce(F.col(loss_from).cast("long"), F.lit(0)) if loss_from else F.lit(0)
    rows = examples.select(F.col(key).alias("doc_id"), F.col(ids).cast("array<long>").alias("ids"), loss.cast("long").alias("loss_from"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(first: pa.RecordBatch) -> Iterator[tuple]:
            batch = first
            while batch is not None:
                keys, losses = batch.column("doc_id").to_pylist(), batch.column("loss_from").to_pylist()
                for name, array, begin in zip(keys, batch.column("ids"), losses):
                    if array.is_valid:
                        yield name, array.values.to_numpy(zero_copy_only=False).astype("<u4"), max(begin, 0)
                batch = next(batches, None)

        first = next(batches, None)
        if first is not None:
            yield from _packed(each(first), limits, cut, first.schema.field("doc_id").type, window)

    return rows.mapInArrow(run, f"doc_id {kind}, {OUT}")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    cut: bool = True,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """:func:`pack` over the ids of whole texts, each with ``end_id`` behind: encoded and packed in one pass.

    ``tokenizer`` is the path of a tokenizer definition (JSON) whose tokens do not cross white space; it is
    read by Spark and sent to the tasks (about two megabytes). A null text counts as empty: its one id is ``end_id``.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"definition": read_bytes(docs.sparkSession, tokenizer).decode()})
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "made" not in shared.value:  # once per worker: later tasks find it in its copy of the broadcast value
            shared.value["made"] = WordEncoder(shared.value["definition"])
        encoder = shared.value["made"]

        def each(first: pa.RecordBatch) -> Iterator[tuple]:
            batch = first
            while batch is not None:
                sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // CHUNK_BYTES)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                    part = batch.slice(a, b - a)
                    ids, offsets = encoder.encode(part.column("text"), end_id)
                    for i, name in enumerate(part.column("doc_id").to_pylist()):
                        yield name, ids[offsets[i] : offsets[i + 1]].copy(), 0
                batch = next(batches, None)

        first = next(batches, None)
        if first is not None:
            yield from _packed(each(first), limits, cut, first.schema.field("doc_id").type, window)

    return rows.mapInArrow(run, f"doc_id {kind}, {OUT}")


def padding(pieces: DataFrame, tokens: int = 2048) -> DataFrame:
    """One row: sequences, tokens, and padding to ``tokens`` of the sequences whose length is no power of two."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    exact = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    pad = F.when(exact, 0).otherwise(tokens - F.col("n"))
    return lengths.agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("tokens"), F.coalesce(F.sum(pad), F.lit(0)).alias("padding"))
