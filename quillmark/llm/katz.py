"""Language-model scores: Katz backoff over words and word pairs.

Counts are discounted by Good-Turing, and what that frees is given to unseen events by backoff weights
that normalise exactly. With ``r`` the count of a pair (h, w), ``c`` that of a word and ``d`` the discounts:

    p(w | h) = d2(r) r / (c(h) + 1)            where the pair is known
             = a(h) p(w)                       else; a(h) = 1 for an unknown history
    p(w)     = d1(c) c / (N + 1)               where the word is known
             = what the known words leave      else, as one event
    a(h)     = (1 - sum p(w | h)) / (1 - sum p(w)), sums over the words known after h

The one added to each denominator leaves mass even where no count is discounted.

The n-gram tables are dealt over partitions by word. A task packs its tokens by partition: the words and
histories that occur there as sorted hashes, pairs, counts, and the documents of each occurrence. So a
partition holds all there is about its words: it counts pairs, evaluates its tokens, and keeps of each
document sums that do not depend on the discounts. Sums per history are dealt over partitions by history,
where the backoff weights arise and unknown pairs are evaluated. Frequent words, a bounded list, are
dealt by pair instead, so no word is one partition's burden. Nothing that grows is broadcast or collected.
"""

from __future__ import annotations

import ctypes
import math
import pickle
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.rule_ensemble import remainder
from quillmark.llm.text import stored

K = 5  # counts up to this one are discounted
BLOCK_BYTES = 6 << 20  # text that a task packs together
PARTITION_TOKENS = 2_500_000
PARTITIONS = 48  # at least
END, START = b" end", b" start"  # no word holds a blank
SCALE = float(1 << 28)  # sums per document are kept in fixed point: exact to add in any order
PACKED = "kind string, part long, block long, data binary"


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """Columns as bytes: sorted 64-bit hashes by their steps, every column by byte planes, compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    found = {}
    for name, values in columns.items():
        stepped = values.dtype == np.uint64
        a = np.ascontiguousarray(np.diff(values, prepend=np.uint64(0)) if stepped else values)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        found[name] = (a.dtype.str, len(a), stepped, squeeze(planes))
    return pickle.dumps(found)


def unpack(data: bytes) -> dict[str, np.ndarray]:
    spread = zstandard.ZstdDecompressor().decompress
    found = {}
    for name, (kind, n, stepped, planes) in pickle.loads(data).items():
        size = np.dtype(kind).itemsize
        raw = np.frombuffer(spread(planes, max_output_size=max(1, n * size)) if n else b"", np.uint8)
        a = np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()
        found[name] = np.cumsum(a, dtype=np.uint64) if stepped else a
    return found


class Ids(dict):
    """Words to numbers in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokens(text: bytes | None) -> list[bytes]:
    """Words with A-Z in lower case, without the end; bytes fold ASCII letters and split at ASCII blanks only."""
    return (text or b"").lower().split()


def hashes(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64)


def release() -> None:
    """Give memory that Arrow and the C library keep for later back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Rows gathered up to a size of text: other values and texts as bytes."""
    rows, texts, size = [], [], 0
    for batch in batches:
        body = batch.column("text").cast(pa.binary())  # no copy
        names = [c for c in batch.schema.names if c != "text"]
        others = list(zip(*(batch.column(c).to_pylist() for c in names))) if names else [()] * batch.num_rows
        for other, text in zip(others, body):
            text = text.as_py()
            rows.append(other)
            texts.append(text)
            size += len(text or b"") + 1
            if size >= BLOCK_BYTES:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts
    release()


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(word, n)`` of each block: hashes of its tokens and their counts."""
    for _, texts in _blocks(batches):
        ids, seen = Ids(), array("i")
        for text in texts:
            seen.extend(map(ids.__getitem__, tokens(text)))
        counts = np.bincount(np.frombuffer(seen, np.int32), minlength=len(ids)) if len(ids) else np.zeros(0, np.int64)
        words = np.concatenate((hashes(ids), hashes([END])))
        counts = np.concatenate((counts, [len(texts)])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])


def discounts(counts_of_counts: list[int]) -> list[float]:
    """Katz's discounts of counts 0 to K from the numbers of events seen 0 to K + 1 times.

    Where these are too few or too odd for Good-Turing (a discount outside 0 to 1), all counts up to K are
    lowered by the same part of one.
    """
    n = counts_of_counts
    if all(n[1 : K + 2]):
        common = (K + 1) * n[K + 1] / n[1]
        found = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if common != 1 else 0 for r in range(1, K + 1)]
        if all(0 < d <= 1 for d in found):
            return [1.0, *found]
    part = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return [1.0, *((r - min(part, 0.9)) / r for r in range(1, K + 1))]


class Words:
    """Probabilities of single words from their counts."""

    def __init__(self, n: int, counts_of_counts: list[int]):
        self.n, self.d = n, np.array(discounts(counts_of_counts))
        freed = sum((1 - self.d[r]) * r * counts_of_counts[r] for r in range(1, K + 1))
        self.unknown = (freed + 1) / (n + 1)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        d = np.where(counts <= K, self.d[np.minimum(counts, K)], 1.0)
        return np.where(counts > 0, d * counts / (self.n + 1), self.unknown)


def packer(partitions: int, hot: dict[int, int]):
    """A task: blocks of documents become rows ``(kind, part, block, data)``, one for each partition met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        hot_words = np.array(sorted(hot), np.uint64)
        for number, (rows, texts) in enumerate(_blocks(batches)):
            yield _packed_block((task << 24) | number, rows, texts, partitions, hot_words)
            release()

    return run


def _packed_block(block: int, rows: list, texts: list, partitions: int, hot_words: np.ndarray) -> pa.RecordBatch:
    ids, seen, ends = Ids(), array("i"), []
    end = ids[END]
    for text in texts:
        seen.extend(map(ids.__getitem__, tokens(text)))
        seen.append(end)
        ends.append(len(seen))
    held, ends = np.array([r[1] for r in rows], bool), np.array(ends)
    start = ids[START]
    names = hashes(ids)
    order = np.argsort(names)
    rank = np.empty(len(names), np.int32)
    rank[order] = np.arange(len(names), dtype=np.int32)
    names = names[order]
    w = rank[np.frombuffer(seen, np.int32)]
    h = np.concatenate((w[:1], w[:-1]))
    h[np.concatenate(([0], ends[:-1]))] = rank[start]
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(ends, prepend=0))
    part = (names % np.uint64(partitions)).astype(np.int32)[w]
    frequent = np.isin(names, hot_words)[w]
    if frequent.any():
        mixed = names[w[frequent]] * np.uint64(0x9E3779B97F4A7C15) ^ names[h[frequent]]
        part[frequent] = (mixed % np.uint64(partitions)).astype(np.int32)
    order = np.argsort((part.astype(np.int64) * len(names) + w) * len(names) + h, kind="stable")
    part, w, h, doc = part[order], w[order], h[order], doc[order]
    del order, seen, ids
    cuts = np.searchsorted(part, np.arange(partitions + 1))
    out = [("list", 0, block, pickle.dumps(([r[0] for r in rows], held, np.diff(ends, prepend=0))))]
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        at = slice(cuts[p], cuts[p + 1])
        out.append(("pairs", p, block, _packed_pairs(names, w[at], h[at], doc[at], ~held[doc[at]], len(rows))))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
        names=["kind", "part", "block", "data"],
    )


def _packed_pairs(names, w, h, doc, train, n_docs) -> bytes:
    """Tokens of one partition, in order of word and history."""
    first = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (h[1:] != h[:-1]))))
    words, word_at = np.unique(w[first], return_inverse=True)
    past, past_at = np.unique(h[first], return_inverse=True)
    return pack(
        {
            "words": names[words],
            "past": names[past],
            "pairs": np.bincount(word_at).astype(np.int32),
            "past_at": past_at.astype(np.int32),
            "n": np.diff(np.append(first, len(w))).astype(np.int32),
            "train": np.add.reduceat(train.astype(np.int32), first),
            "doc": doc,
            "n_docs": np.array([n_docs], np.int32),
        }
    )


STATS = ("known", "base", "logs", *(f"m{r}" for r in range(1, K + 1)))
PAST = ("c", "mass", *(f"k{r}" for r in range(1, K + 1)))


def evaluator(words: Words, hot: dict[int, int], past_parts: int):
    """A partition: count its pairs, sum its tokens by document, and deal histories and unknown pairs on."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        p = key[0].as_py()
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "block", "data"))), key=lambda r: r[:2])
        out = [("list", p, block, data) for kind, block, data in rows if kind == "list"]
        blobs = [(block, unpack(data)) for kind, block, data in rows if kind == "pairs"]
        if blobs:
            out += _evaluate(p, blobs, words, hot, past_parts)
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        names = ["kind", "part", "block", "data"]
        del rows, blobs
        release()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def _evaluate(p, blobs, words, hot, past_parts) -> list[tuple]:
    all_words = np.unique(np.concatenate([b["words"] for _, b in blobs]))
    all_past = np.unique(np.concatenate([b["past"] for _, b in blobs]))
    word_at = [np.repeat(np.searchsorted(all_words, b["words"]).astype(np.int32), b["pairs"]) for _, b in blobs]
    past_at = [np.searchsorted(all_past, b["past"]).astype(np.int32)[b["past_at"]] for _, b in blobs]
    sizes = [len(x) for x in word_at]
    flat_word, flat_past = np.concatenate(word_at), np.concatenate(past_at)
    train = np.concatenate([b["train"] for _, b in blobs])
    keys, pair = np.unique(flat_word.astype(np.int64) * len(all_past) + flat_past, return_inverse=True)
    r = np.bincount(pair, weights=train, minlength=len(keys)).astype(np.int64)
    c = np.bincount(flat_word, weights=train, minlength=len(all_words)).astype(np.int64)
    for i, name in enumerate(all_words.tolist()) if hot else ():
        if name in hot:
            c[i] = hot[name]
    end = hashes([END])[0]
    p1 = words.probability(c)
    log_c = np.where((c > 0) & (all_words != end), np.log10(c + 1.0), 0.0)
    log_base = np.log10(c + 0.1)
    log_r = np.log10(np.maximum(r, 1))
    out, stop = [], np.cumsum(sizes)
    unseen = []
    for (block, b), to, size in zip(blobs, stop, sizes):
        mine = np.repeat(np.arange(to - size, to), b["n"])
        w, pairs, doc, n_docs = flat_word[mine], pair[mine], b["doc"], int(b["n_docs"][0])
        times = r[pairs]
        fixed = lambda values: np.rint(np.bincount(doc, values, n_docs) * SCALE).astype(np.int64)
        stats = {"known": np.bincount(doc[c[w] > 0], minlength=n_docs).astype(np.int32)}
        stats |= {"base": fixed(log_base[w]), "logs": fixed(log_r[pairs] - log_c[w])}
        stats |= {f"m{i}": np.bincount(doc[times == i], minlength=n_docs).astype(np.int32) for i in range(1, K + 1)}
        out.append(("stats", p, block, pack(stats)))
        new = times == 0
        if new.any():
            unseen.append((block, doc[new], flat_past[mine[new]], np.log10(p1[w[new]])))
    ones = np.bincount(np.minimum(r, K + 2), minlength=K + 3)
    out.append(("counts", p, 0, pickle.dumps(ones.tolist())))
    known = r > 0
    pair_past, pair_word, pair_r = (keys % len(all_past))[known], (keys // len(all_past))[known], r[known]
    past = {"c": np.bincount(pair_past, pair_r, len(all_past)).astype(np.int64)}
    past["mass"] = np.bincount(pair_past, p1[pair_word], len(all_past))
    for i in range(1, K + 1):
        past[f"k{i}"] = np.bincount(pair_past[pair_r == i], minlength=len(all_past)).astype(np.int32)
    of_part = (all_past % np.uint64(past_parts)).astype(np.int64)
    for q in range(past_parts):
        chosen = np.flatnonzero((of_part == q) & (past["c"] > 0))
        if len(chosen):
            out.append(("past", q, p, pack({"past": all_past[chosen], **{k: v[chosen] for k, v in past.items()}})))
    for block, doc, at, logs in unseen:
        parts = of_part[at]
        for q in np.unique(parts).tolist():
            mine = np.flatnonzero(parts == q)
            names, which = np.unique(all_past[at[mine]], return_inverse=True)
            columns = {"past": names, "at": which.astype(np.int32), "doc": doc[mine], "log": logs[mine].astype(np.float32)}
            out.append(("unseen", q, block, pack(columns)))
    return out


def backoff(pair_discounts: list[float], least: float):
    """A partition of histories: backoff weights, and the sums of unknown pairs by document."""
    freed = np.array([(1 - d) * r for r, d in enumerate(pair_discounts)])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        q = key[0].as_py()
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "block", "data"))), key=lambda r: r[:2])
        found = [unpack(data) for kind, _, data in rows if kind == "past"]
        names = np.unique(np.concatenate([f["past"] for f in found])) if found else np.zeros(0, np.uint64)
        at = [np.searchsorted(names, f["past"]) for f in found]
        sums = {}
        for column in PAST:
            sums[column] = np.zeros(len(names))
            for f, i in zip(found, at):
                sums[column][i] += f[column]
        left = sum((freed[i] * sums[f"k{i}"] for i in range(1, K + 1)), np.ones(len(names)))
        # log a(h), and log (c(h) + 1) back, which the document's sum has subtracted for the word h; what
        # the words known after h leave is never less than the mass of unknown words
        weight = np.log10(left / (sums["c"] + 1) / np.maximum(1 - sums["mass"], least)) + np.log10(sums["c"] + 1)
        by_block: dict[int, list] = {}
        for kind, block, data in rows:
            if kind == "unseen":
                u = unpack(data)
                place = np.minimum(np.searchsorted(names, u["past"]), max(0, len(names) - 1))
                known = names[place] == u["past"] if len(names) else np.zeros(len(u["past"]), bool)
                weights = np.where(known, weight[place] if len(names) else 0.0, 0.0)
                by_block.setdefault(block, []).append((u["doc"], u["log"] + weights[u["at"]]))
        out = []
        for block, parts in sorted(by_block.items()):
            doc, logs = (np.concatenate(x) for x in zip(*parts))
            docs, at_doc = np.unique(doc, return_inverse=True)
            total = np.rint(np.bincount(at_doc, logs) * SCALE).astype(np.int64)
            out.append(("backoff", q, block, pack({"doc": docs, "logs": total})))
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
        return pa.table(columns, names=["kind", "part", "block", "data"])

    return run


def summer(n: int, v: int, train_docs: int, pair_discounts: list[float], id_type: pa.DataType):
    """A block: sums of all partitions become one row per document."""
    log_d = np.log10(np.array(pair_discounts[1:]))
    base_log = math.log10(n + 0.1 * (v + 1))
    start_log = math.log10(train_docs + 1) if train_docs else 0.0

    def run(table: pa.Table) -> pa.Table:
        ids, held, sizes = None, None, None
        sums: dict[str, np.ndarray] = {}
        rows = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
        ids, held, sizes = pickle.loads(next(data for kind, data in rows if kind == "list"))
        sums = {s: np.zeros(len(ids), np.int64) for s in STATS}
        for kind, data in rows:
            if kind == "stats":
                for name, values in unpack(data).items():
                    sums[name] += values
            elif kind == "backoff":
                part = unpack(data)
                sums["logs"][part["doc"]] += part["logs"]
        counts = np.stack([sums[f"m{i}"] for i in range(1, K + 1)], 1)
        score = sums["logs"] / SCALE + counts @ log_d - start_log
        base = sums["base"] / SCALE - sizes * base_log
        columns = {
            "doc_id": pa.array(ids, id_type), "held_out": pa.array(held), "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(sums["known"]), "train_tokens": pa.array(np.full(len(ids), n)),
            "base_score": pa.array(base), "score": pa.array(score),
        }
        return pa.table(columns)

    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, fold, token counts, ``base_score`` and ``score`` (log10 probability).

    Learns from the documents whose crc32 remainder modulo ``folds`` is not 0; the others are held out. A
    null id counts as empty text there. A null text counts as empty and has one token, its end. Rows are
    told apart by place, so repeated rows are scored, and learnt from, as often as they occur. Without
    training documents every token is unknown. Other columns are ignored; an empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    held = remainder(F.col(doc_id), folds) == 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).cast("string").alias("text"))
    counted = rows.filter(~F.col("held_out")).select("text").mapInArrow(count_words, "word long, n long")
    vocabulary = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "katz-words")
    classes = F.least("n", F.lit(K + 2))
    facts = vocabulary.groupBy(classes.alias("r")).agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()
    n, v = sum(f["n"] for f in facts), sum(f["v"] for f in facts)
    words = Words(n, _by_class({f["r"]: f["v"] for f in facts}))
    end = int(hashes([END]).view(np.int64)[0])
    train_docs = (vocabulary.filter(F.col("word") == end).agg(F.sum("n")).first()[0]) or 0
    partitions = max(PARTITIONS, -(-n // PARTITION_TOKENS))
    frequent = vocabulary.filter(F.col("n") > max(1, n // (4 * partitions))).collect()  # 4 * partitions rows at most
    hot = {f["word"] % (1 << 64): f["n"] for f in frequent}

    packed = rows.mapInArrow(packer(partitions, hot), PACKED)
    evaluated = stored(packed.groupBy("part").applyInArrow(evaluator(words, hot, partitions), PACKED), "katz-partitions")
    pair_classes = [pickle.loads(x["data"]) for x in evaluated.filter("kind = 'counts'").select("data").toLocalIterator()]
    pair_discounts = discounts(np.sum(pair_classes, axis=0).tolist() if pair_classes else [0] * (K + 3))
    dealt = evaluated.filter("kind IN ('past', 'unseen')").groupBy("part")
    unknown = dealt.applyInArrow(backoff(pair_discounts, words.unknown), PACKED)
    sums = evaluated.filter("kind IN ('list', 'stats')").union(unknown)
    schema = f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    id_type = _arrow_type(spark, kind)
    return sums.groupBy("block").applyInArrow(summer(n, v, train_docs, pair_discounts, id_type), schema)


def _by_class(numbers: dict[int, int]) -> list[int]:
    return [numbers.get(r, 0) for r in range(K + 3)]


def _arrow_type(spark, kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
