"""SentencePiece: against plain dynamic programming, the library, and exact round trips."""

import llm_cases as cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.llm import sentencepiece as q

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return q.Vocabulary(q.read_pieces(open(PATH, "rb").read()))


def _plain(vocabulary, marked):
    """Best score and path by trying every piece at every place."""
    scores = {p: (s, i) for i, (p, s, kind) in enumerate(vocabulary.pieces) if kind in (q.NORMAL, q.USER)}
    longest = max(map(len, scores))
    best = [(0.0, 0, None)] + [None] * len(marked)
    for end in range(1, len(marked) + 1):
        for begin in range(max(0, end - longest), end):
            found = scores.get(marked[begin:end])
            options = [(best[begin][0] + found[0], begin, found[1])] if found else []
            if begin == end - 1:
                options.append((best[begin][0] + vocabulary.unknown_score, begin, None))
            for option in options:
                if best[end] is None or option[0] > best[end][0]:
                    best[end] = option
    ids, at = [], len(marked)
    while at:
        _, begin, number = best[at]
        ids = ([number] if number is not None else vocabulary.spelled(marked[begin:at])) + ids
        at = begin
    return ids


TEXT = st.text(st.sampled_from(list("abethn the. \né▁\U0001f600")), max_size=30)


@given(TEXT)
@settings(max_examples=150, deadline=None)
def test_viterbi_equals_plain_dynamic_programming(vocabulary, text):
    marked = q.SPACE + text.replace(q.SPACE, "").replace(" ", q.SPACE)
    assert vocabulary.viterbi(marked) == _plain(vocabulary, marked)


@given(st.one_of(TEXT, st.text(max_size=40)))
@settings(max_examples=300, deadline=None)
def test_round_trip_and_words_equal_whole_texts(vocabulary, text):
    ids = vocabulary.encode(text)
    assert vocabulary.decode(ids) == text
    whole = q.Vocabulary(vocabulary.pieces)
    whole.words = None
    assert list(whole.encode(text)) == list(ids)


def test_paths_score_no_less_than_the_library_finds(vocabulary):
    """The library, told that the vocabulary is a unigram model, searches the same paths."""
    import sentencepiece

    model = open(PATH, "rb").read()
    spec = next(v for n, v in q._message(model) if n == 2)
    assert (3, 2) in list(q._message(spec))  # model type: BPE
    unigram = model.replace(spec, spec.replace(b"\x18\x02", b"\x18\x01", 1), 1)
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram)
    score = lambda ids: sum(vocabulary.pieces[i][1] for i in ids)
    texts = [r[1] for r in cases.ROWS[:3]] + ["An example, with 12 numbers\nand lines.", "Étion dans l'été 中文"]
    for text in texts:
        ours, theirs = list(vocabulary.encode(text)), library.encode(text)
        assert score(ours) >= score(theirs) and library.decode(ours) == text
    assert sum(list(vocabulary.encode(t)) == library.encode(t) for t in texts) >= 2


def test_columns(spark):
    pieces = q.SentencePiece(spark, PATH)
    rows = cases.documents(spark).withColumn("made", pieces.encode("text")).withColumn("back", pieces.decode("made"))
    got = rows.select("text", "made", "back", "ids").collect()
    assert len(got) == len(cases.ROWS) and all(r["back"] == r["text"] and r["ids"] == "mine" for r in got)
    assert {r["text"]: r["made"] for r in got}[""] == [] and {r["text"]: r["made"] for r in got}[None] is None
    assert cases.empty(spark).select(pieces.encode(F.col("text"))).collect() == []
    from_store = q.read_bytes(spark, f"file://{PATH}")
    assert from_store == open(PATH, "rb").read()


def test_checked_ids_take_one_worker(spark):
    """The pipeline's last stage: ids and whether they give the text back, in a single Python pass."""
    import corpus_pipeline

    docs = cases.documents(spark)
    pieces = q.SentencePiece(spark, PATH)
    two = docs.withColumn("made", pieces.encode("text")).withColumn("back", pieces.decode("made"))
    wanted = [(r["text"], r["made"], r["back"] == r["text"]) for r in two.select("text", "made", "back").collect()]
    got = docs.select("text", pieces.encode_checked("text").alias("c")).select("text", "c.ids", "c.exact").collect()
    key = lambda r: (r[0] is not None, r[0] or "")
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)
    assert cases.empty(spark).select(pieces.encode_checked("text")).collect() == []
    plan = corpus_pipeline.encode(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
