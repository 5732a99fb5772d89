"""License scan on small texts; whole tables are compared with SQL."""

import llm_cases as cases
import pytest

from quillmark.llm import licenses as q

MIT = next(t for t in q.NOTICES if t.label == "mit").text


def _scan(spark, texts):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    digest = q.license_digest(q.scan_licenses(cases.documents(spark, rows)))
    return {r["doc_id"]: r for r in digest.collect()}


def test_base_phrases(spark):
    got = _scan(
        spark,
        [
            "Released under the MIT License. under the mit license",
            "APACHE LICENSE, VERSION 2.0 and cc-by nc CC BY-NC 4.0",
            "under the mit licenses", "cc by", None, "", "under the mİt license", "under the mit licenſe",
            "cc by nc cc by nc", "byK cc by nc",
        ],
    )
    shown = lambda i: (got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["base_labels"])
    assert shown(0) == (2, 1, 5, "mit")
    assert shown(1) == (3, 0, 9, "apache-2,cc-by-nc")
    assert all(shown(i) == (0, None, None, "") for i in (2, 3, 4, 5, 6, 7))
    assert shown(8) == (2, 0, 3, "cc-by-nc") and shown(9) == (1, 1, 1, "cc-by-nc")
    assert got[4]["n_words"] == 0 and got[4]["score"] == 0.0 and got[0]["score"] == 1.0


def test_notice_with_a_lost_and_an_added_word_is_one_span(spark):
    words = MIT.split()
    changed = "intro words " + " ".join(words[:20] + words[21:40] + ["extra"] + words[40:]) + " more"
    scanned = q.scan_licenses(cases.documents(spark, [(1, changed, "en", "s", 0)])).first()
    assert [(s["label"], s["phrase"]) for s in scanned["spans"]] == [("mit", False)]
    span = scanned["spans"][0]
    assert span["first_word"] == 2 and 0.8 <= span["coverage"] < 1


def test_half_a_notice_is_no_license(spark):
    half = " ".join(MIT.split()[:30])
    row = _scan(spark, [half])[0]
    assert row["labels"] == "" and 0 < row["score"] < 0.8


def test_all_rows_come_back(spark):
    got = q.license_digest(q.scan_licenses(cases.documents(spark))).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in cases.ROWS)
    assert q.scan_licenses(cases.empty(spark)).collect() == []
    repeated = cases.documents(spark, [(1, "cc by nc", "en", "s", 0)] * 3 + [(1, "other", "en", "s", 0)])
    assert sorted(r["n_base"] for r in q.license_digest(q.scan_licenses(repeated)).collect()) == [0, 1, 1, 1]


def test_templates_have_a_bound():
    with pytest.raises(ValueError):
        q.template_positions(None, (q.Template("x", "two words"),))
