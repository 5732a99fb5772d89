"""Chat formatting by columnar byte assembly.

Turns become bytes: opener, escaped text, closer. For each batch of turns numpy works out segment
lengths, their running offsets and the scatter indices of all contents; openers, contents and closers
are copied into one preallocated buffer, which becomes an Arrow string column without another copy.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20  # contents assembled at once; scatter indices take eight times as much


@dataclass(frozen=True)
class Template:
    """How a turn is marked. ``controls`` are the strings that must not appear inside texts and roles."""

    start: str = "<s>"
    openers: tuple[tuple[str, str], ...] = (("user", "[INST] "), ("system", "[SYS] "), ("assistant", ""))
    closers: tuple[tuple[str, str], ...] = (("user", " [/INST]"), ("system", " [/SYS]"), ("assistant", ""))
    other_opener: tuple[str, str] = ("[ROLE]", "[/ROLE] ")  # around the name of any other role
    end: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)

    def _rest(self) -> str:
        return "|".join(re.escape(c[1:]) for c in self.controls)

    def _first(self) -> str:
        return "".join(sorted({re.escape(c[0]) for c in self.controls}))

    def candidate(self) -> str:
        """Pattern of texts that need escaping: a control string, with any backslashes after its first character."""
        return rf"[{self._first()}]\\*(?:{self._rest()})"

    def escaper(self) -> re.Pattern:
        return re.compile(rf"(?<=[{self._first()}])(?=\\*(?:{self._rest()}))")

    def unescaper(self) -> re.Pattern:
        return re.compile(rf"(?<=[{self._first()}])\\(?=\\*(?:{self._rest()}))")

    def escape(self, text: str) -> str:
        """One more backslash after the first character of what reads as a control string, escaped or not."""
        return self.escaper().sub(r"\\", text)

    def unescape(self, text: str) -> str:
        return self.unescaper().sub("", text)

    def turns(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """Read back ``(role, text, start, end)`` of each turn; the positions are those of the escaped text."""
        found, at = [], 0
        openers, closers = dict(self.openers), dict(self.closers)
        marked = sorted(((o, r) for r, o in self.openers if o), key=lambda x: -len(x[0]))
        while at < len(formatted):
            stop = formatted.index(self.end, at)
            begin = at + len(self.start)
            if formatted[at:begin] != self.start:
                raise ValueError("a turn must begin with the start string")
            if formatted.startswith(self.other_opener[0], begin):
                middle = formatted.index(self.other_opener[1], begin)
                role = self.unescape(formatted[begin + len(self.other_opener[0]) : middle])
                first, last = middle + len(self.other_opener[1]), stop
            else:
                role = next((r for o, r in marked if formatted.startswith(o, begin)), None)
                role = role if role is not None else next(r for r, o in self.openers if not o)
                first, last = begin + len(openers[role]), stop - len(closers[role])
            found.append((role, self.unescape(formatted[first:last]), first, last))
            at = stop + len(self.end)
        return found


def _bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts]) if texts.offset else texts
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _escaped(texts: pa.Array, template: Template) -> pa.Array:
    """Only texts in which a control string occurs go through Python."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    hits = pc.match_substring_regex(texts, template.candidate())
    if not pc.any(hits).as_py():
        return texts
    changed = pa.array([template.escape(t) for t in texts.filter(hits).to_pylist()], pa.large_string())
    return pc.replace_with_mask(texts, hits, changed)


def _scatter(out: np.ndarray, to: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``out[to[i]:]``, all segments at once."""
    lengths = np.diff(offsets)
    total = int(offsets[-1] - offsets[0])
    if total:
        index = np.repeat(to - offsets[:-1], lengths) + np.arange(offsets[0], offsets[-1])
        out[index] = data[offsets[0] : offsets[-1]]


def assemble(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer of all turns, their offsets in it, and first and last byte of each escaped text."""
    role_names = pc.dictionary_encode(pc.fill_null(roles.cast(pa.string()), ""))
    names = role_names.dictionary.to_pylist()
    openers, closers = dict(template.openers), dict(template.closers)
    other = lambda r: template.other_opener[0] + template.escape(r) + template.other_opener[1]
    heads = pa.array([template.start + (openers[r] if r in openers else other(r)) for r in names], pa.large_string())
    tails = pa.array([closers.get(r, "") + template.end for r in names], pa.large_string())
    which = role_names.indices
    parts = [_bytes_and_offsets(a) for a in (heads.take(which), _escaped(texts, template), tails.take(which))]
    lengths = [np.diff(offsets) for _, offsets in parts]
    ends = np.cumsum(lengths[0] + lengths[1] + lengths[2])
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else np.zeros(0, np.int64)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = starts.copy()
    for (data, offsets), length in zip(parts, lengths):
        _scatter(out, at, data, offsets)
        at = at + length
    first = starts + lengths[0]
    return out, np.concatenate((starts, ends[-1:])), first, first + lengths[1]


def _chunks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that none but a single row holds more than ``limit`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


PARTS_SCHEMA = "part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def format_chats(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = Template(),
    turns_per_part: int = 256,
) -> DataFrame:
    """One row per conversation and part: ``formatted`` text and the byte spans under the loss mask.

    Part k holds the turns numbered from ``k * turns_per_part`` on; the parts of a conversation in
    order, joined, are its formatted text. So a conversation of any length is dealt over tasks by part,
    and a task holds one chunk of turns at a time. Turns are ordered by number, ties by role and text.
    A null text or role counts as empty, a null turn number as part 0, first in order; null
    conversations form one conversation. Other columns are ignored. An empty table gives no rows.
    """
    kind = turns.schema[conv].dataType.simpleString()
    part = F.coalesce(F.floor(F.col(turn) / turns_per_part), F.lit(0)).cast("long")
    rows = turns.select(
        F.col(conv).alias("conv_id"), part.alias("part"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, pieces = None, []

        def finished():
            texts = b"".join(p[0] for p in pieces)
            base, starts, ends = 0, [], []
            for data, s, e, _ in pieces:
                starts += [base + x for x in s]
                ends += [base + x for x in e]
                base += len(data)
            return (*open_key, sum(p[3] for p in pieces), texts.decode(), starts, ends)

        for batch in _chunks(batches, CHUNK_BYTES):
            data, offsets, first, last = assemble(batch.column("role"), batch.column("text"), template)
            keys = list(zip(batch.column("conv_id").to_pylist(), batch.column("part").to_pylist()))
            learned = pc.is_in(batch.column("role"), pa.array(template.learned)).to_numpy(zero_copy_only=False)
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            done = []
            for a, b in zip(cuts, cuts[1:]):
                if keys[a] != open_key and pieces:
                    done.append(finished())
                    pieces = []
                open_key, mine = keys[a], learned[a:b]
                piece = data[offsets[a] : offsets[b]].tobytes()
                pieces.append((piece, (first[a:b][mine] - offsets[a]).tolist(), (last[a:b][mine] - offsets[a]).tolist(), b - a))
            if done:
                yield _part_batch(done, batch.schema.field("conv_id").type)
        if pieces:
            yield _part_batch([finished()], batch.schema.field("conv_id").type)

    return dealt.mapInArrow(run, f"conv_id {kind}, {PARTS_SCHEMA}")


def _part_batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    spans = pa.list_(pa.int64())
    types = (key_type, pa.int64(), pa.int64(), pa.string(), spans, spans)
    names = ("conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends")
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


DIGEST_SCHEMA = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest_chats(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, read back from its formatted parts.

    The turns are parsed from the text and unescaped; the learned text is cut out by the loss spans.
    Parts stream through in order, so a conversation of any length needs one part in memory.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        missing = object()
        key, state = missing, None

        def row():
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        def batch_of(rows, key_type):
            types = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            done, key_type = [], batch.schema.field("conv_id").type
            for i in range(batch.num_rows):
                conv = batch.column("conv_id")[i].as_py()
                if key is missing or conv != key:
                    if key is not missing:
                        done.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                formatted = batch.column("formatted")[i].as_py()
                for role, text, _, _ in template.turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                raw = formatted.encode()
                for a, b in zip(batch.column("loss_starts")[i].as_py(), batch.column("loss_ends")[i].as_py()):
                    learned = template.unescape(raw[a:b].decode())
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(formatted)
            if done:
                yield batch_of(done, key_type)
        if key is not missing:
            yield batch_of([row()], key_type)

    return dealt.mapInArrow(run, f"conv_id {kind}, {DIGEST_SCHEMA}")
