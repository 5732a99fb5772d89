"""Packing: whole ids, limits, little padding, the dot product's choice, odd rows."""

import llm_cases as cases
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmark.llm import packing
from quillmark.llm.packing import Limits, Packer, WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_sequences(pieces, limits, padded=0):
    """Pieces of each sequence lie gapless from 0 and keep the limits; no more than ``padded`` sequences need padding."""
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    short = 0
    for rows in by_sequence.values():
        at = 0
        for p in sorted(rows, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= limits.tokens and len(rows) <= limits.segments
        assert sum(p["loss_tokens"] for p in rows) <= limits.loss_tokens
        short += at != limits.tokens and at & (at - 1) > 0
    assert short <= padded
    return by_sequence


def joined(pieces):
    """Ids of each example from its pieces, which must add up; repeated examples come as often as they were given."""
    found = {}
    for p in pieces:
        found.setdefault(p["doc_id"], []).append(p)
    out = {}
    for key, rows in found.items():
        rows.sort(key=lambda p: p["start"])
        total = sum(p["length"] for p in rows)
        copies, rest = divmod(total, rows[0]["doc_tokens"])
        assert rest == 0
        ids = [np.frombuffer(p["ids"], "<u4") for p in rows]
        if copies == 1:
            assert all(b["start"] == a["start"] + a["length"] for a, b in zip(rows, rows[1:]))
        out[key] = (copies, np.concatenate(ids).tolist())
    return out


def test_encoder_equals_the_tokenizer():
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(PATH)
    texts = [r[1] for r in cases.ROWS] + ["don't we'll 12 ½ x² y z İSTANBUL ΟΔΟΣ é ́a <|endoftext|> ~~!!", "a\x0bb\x0cc\rd"]
    texts += ["Wort, wort. WORT!! it's 'tis rock'n'roll e=mc² naïve--- ñ, Ñ; K. x_y a_ <|startoftext|> a<|endoftext|>, A|b İ, ſ. don't, s's."]
    encoder = WordEncoder(tokenizer.to_str())
    for _ in range(2):  # the second time from the cache
        ids, offsets = encoder.encode(pa.array(texts, pa.string()), 1)
        for i, text in enumerate(texts):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_documents_come_back_whole_and_full(spark):
    docs = cases.documents(spark)
    pieces = packing.pack_documents(docs, PATH).collect()
    check_sequences(pieces, Limits())
    tokenizer = Tokenizer.from_file(PATH)
    found = joined([p for p in pieces if p["doc_id"] is not None])
    for doc_id, text, *_ in cases.ROWS:
        if doc_id is not None:
            copies, ids = found[doc_id]
            assert copies == sum(r[0] == doc_id for r in cases.ROWS)
            if copies == 1:
                assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    total = sum(p["length"] for p in pieces)
    assert total == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in cases.ROWS)


def test_query_over_the_table_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    from quillmark.llm.queries import QUERIES

    rows = QUERIES["op11_packing"](spark, sf).collect()
    import zlib

    tokenizer, by_doc = Tokenizer.from_file(PATH), {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(by_doc) == len(docs)
    for d in docs:
        ids = np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[d["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)


def run_packer(examples, limits, cut, window=64):
    packer = Packer(limits, cut, window)
    out = []
    for i, (n, loss_from) in enumerate(examples):
        out += packer.add((i, n, loss_from), n, loss_from)
    return [*out, *packer.finish()]


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize("limits", [Limits(64, 5, 40), Limits(100, 3, 100), Limits(64, 64, 16)])
def test_all_limits_hold_and_nothing_is_lost(cut, limits):
    rng = np.random.default_rng(3)
    examples = [(int(n), int(p)) for n, p in zip(rng.integers(1, 150, 700), rng.integers(0, 90, 700))]
    seen = {}
    for sequence in run_packer(examples, limits, cut):
        loss = sum(max(0, s + n - max(s, e[2])) for e, s, n in sequence)
        assert sum(n for _, _, n in sequence) <= limits.tokens and loss <= limits.loss_tokens
        assert 0 < len(sequence) <= limits.segments
        if cut:
            length = sum(n for _, _, n in sequence)
            assert length == limits.tokens or length & (length - 1) == 0
        for e, s, n in sequence:
            seen.setdefault(e[0], []).append((s, n))
    for i, (n, _) in enumerate(examples):
        spans = sorted(seen[i])
        assert spans[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(spans, spans[1:])) and sum(spans[-1]) == n


def test_without_cutting_examples_stay_whole_and_fill_well():
    rng = np.random.default_rng(5)
    examples = [(int(n), int(n * p)) for n, p in zip(rng.integers(20, 900, 4000), rng.random(4000))]
    sequences = run_packer(examples, Limits(2048, 64, 1024), False, window=1024)
    assert all(n == examples[e[0]][0] for s in sequences for e, _, n in s)
    least = max(sum(n for n, _ in examples) / 2048, sum(n - p for n, p in examples) / 1024)
    assert len(sequences) < 1.03 * least


def test_the_dot_product_balances_tokens_and_loss():
    # Half bear all their loss, half none: only mixed sequences use both limits.
    examples = [(512, 0)] * 8 + [(512, 512)] * 8
    sequences = run_packer(examples, Limits(2048, 8, 1024), False)
    assert len(sequences) == 4


def test_many_short_examples_reach_the_segment_limit():
    sequences = run_packer([(3, 0)] * 1000 + [(1, 0)] * 600, Limits(2048, 100, 2048), True)
    for s in sequences:
        length = sum(n for _, _, n in s)
        assert len(s) <= 100 and length & (length - 1) == 0


def test_token_arrays_with_loss_and_empty_tables(spark):
    rows = [(1, [5, 6, 7], 2), (2, None, 0), (3, [], 1), (None, [9], None), (4, list(range(50)), 100)]
    df = spark.createDataFrame(rows, "id long, tokens array<int>, prompt int").withColumn("length", F.lit("mine"))
    pieces = packing.pack(df, Limits(16, 4, 8), key="id", ids="tokens", loss_from="prompt").collect()
    check_sequences(pieces, Limits(16, 4, 8), padded=10)
    found = joined(pieces)
    assert found[1][1] == [5, 6, 7] and found[4][1] == list(range(50)) and found[None][1] == [9] and 2 not in found and 3 not in found
    assert packing.pack(df.limit(0), key="id", ids="tokens").count() == 0
    assert packing.pack_documents(cases.empty(spark), PATH).count() == 0
    assert packing.padding(packing.pack_documents(cases.documents(spark), PATH)).first()["padding"] == 0
