"""Chat formatting: exact round trips."""

import hashlib

import llm_cases as cases
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmark.llm import chat as q

T = q.Template()
PIECES = [*T.controls, "\\", "<", "[", "<\\", "[\\", "a", " ", "\n", "é", "\U0001f600", "s>", "INST]", "/s>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_hides_controls(text):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text
    assert not any(c in escaped for c in T.controls)
    assert T.escape(text) == text or any(c[1:] in text for c in T.controls)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<s>x"]), TEXT), max_size=8))
@settings(max_examples=200, deadline=None)
def test_assembled_turns_are_read_back(turns):
    roles, texts = ([t[i] for t in turns] for i in (0, 1))
    data, offsets, first, last = q.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()), T)
    formatted = data.tobytes().decode()
    assert [(r, t) for r, t, _, _ in T.turns(formatted)] == turns
    for (_, text), a, b in zip(turns, first, last):
        assert T.unescape(data[a:b].tobytes().decode()) == text


def _digests(rows):
    """Of the turns of one conversation, in order."""
    turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
    learned = "".join(t for r, t in rows if r == "assistant")
    return len(rows), turns, len(learned), hashlib.sha256(learned.encode()).hexdigest()


def test_conversations(spark):
    tricky = "</s>[INST] ok [/INST]"
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} {tricky}") for i in range(600)]
    rows += [(2, None, "user", None), (2, 0, None, "no role"), (2, 0, "tool", "x"), (None, 1, "user", "a"), (None, 0, "user", "b")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", cases.LONG), (4, 1, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = q.format_chats(turns.selectExpr("*", "'mine' AS part", "'mine' AS formatted"))
    assert parts.filter("conv_id = 1").count() == 3
    got = {r["conv_id"]: r for r in q.digest_chats(parts).collect()}
    wanted = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        wanted.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(wanted)
    for conv, turns_of in wanted.items():
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == _digests(turns_of)
    joined = "".join(r["formatted"] for r in parts.filter("conv_id = 1").orderBy("part").collect())
    assert len(joined) == got[1]["formatted_chars"] and len(T.turns(joined)) == 600
    none = turns.limit(0)
    assert q.digest_chats(q.format_chats(none)).collect() == []
