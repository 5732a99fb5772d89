"""SQL fragments of the oracles, written independently of the Spark expressions.

DuckDB's regular expressions have neither back-references nor look-around, so the rules that use
them are stated another way here: lists of characters, tokens or sentences and a filter.
"""

from __future__ import annotations

from quillmark.functions.stylometry import STYLO_COLUMNS
from quillmark.profiles import ARABIC, LATIN, LanguageProfile

WS = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
ARABIC_LETTERS = r"\x{600}-\x{6ff}\x{750}-\x{77f}\x{8a0}-\x{8ff}\x{fb50}-\x{fdff}\x{fe70}-\x{feff}"

# The profiles in the other dialect: (letters, kept characters, marks, segment marks, sentence marks, passive).
CLASSES = {
    "arabic": (
        ARABIC_LETTERS,
        r"\x{600}-\x{6ff}",
        r"\x{64b}-\x{65f}\x{670}",
        r'.!?\x{61f}\x{61b}:\x{60c}\-\x{2013}()"\[\]',
        r".!?\x{61f}\x{61b}",
        rf"(^|[^{WORD}])\x{{623}}\x{{64f}}[\x{{64b}}-\x{{65f}}]?[\x{{627}}-\x{{64a}}]|(^|[^{WORD}])\x{{627}}\x{{633}}\x{{62a}}\x{{651}}",
    ),
    "latin": (
        r"\p{Latin}",
        r"\p{Latin}\x{300}-\x{36f}",
        r"\x{300}-\x{36f}",
        r'.!?:;,\-\x{2013}()"\[\]',
        r".!?;",
        rf"(^|[^{WORD}])(was|were|is|are|been|being)[{WS}]+\p{{L}}+ed([^{WORD}]|$)",
    ),
}


def replace(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


# ---- cleaning -------------------------------------------------------------------------------


def html(c):
    return replace(c, "<[^>]+>")


def urls(c):
    return replace(c, rf"http[^{WS}]+|www[^{WS}]+|https[^{WS}]+")


def emails(c):
    return replace(c, rf"[^{WS}]+@[^{WS}]+")


def digits(c):
    return replace(c, r"\p{Nd}+")


def punct(c):
    for pattern, mark in ((r"\x{61f}{2,}", "؟"), ("!{2,}", "!"), (r"\.{2,}", "."), (",{2,}", ",")):
        c = replace(c, pattern, mark)
    return c


def space(c):
    return f"trim({replace(c, f'[{WS}]+', ' ')})"


def characters(c):
    return f"regexp_extract_all({c}, '(?s).')"


def elongation(chars):
    """A character goes if it repeats its left neighbour and a third equal one stands beside the two."""
    left, left2, right = f"{chars}[i-1] = x", f"{chars}[i-2] = x", f"{chars}[i+1] = x"
    goes = f"(i > 1 AND {left} AND ({right} OR (i > 2 AND {left2})))"
    return f"array_to_string(list_filter({chars}, lambda x, i: x = chr(10) OR NOT coalesce({goes}, false)), '')"


def clean_ctes(base: str) -> str:
    """CTEs up to ``cleaned``: the columns of ``base`` and ``cleaned_text``."""
    first = punct(digits(emails(urls(html("coalesce(text, '')")))))
    return f"""
        _marks AS (SELECT *, {first} AS _s FROM {base}),
        _chars AS (SELECT *, {characters('_s')} AS _cs FROM _marks),
        cleaned AS (SELECT * EXCLUDE (_s, _cs), {space(elongation('_cs'))} AS cleaned_text FROM _chars)"""


# ---- normalising ----------------------------------------------------------------------------


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def fold(c, p: LanguageProfile):
    return f"translate({c}, '{p.fold_from}', '{p.fold_to}')"


def fold_final(c, p: LanguageProfile):
    return replace(c, f"{p.final_from}([^{WORD}]|$)", p.final_to + r"\1")


def marks(c, p: LanguageProfile):
    return replace(c, f"[{CLASSES[p.name][2]}]+")


def keep(c, p: LanguageProfile):
    return replace(c, f"[^{CLASSES[p.name][1]}{WS}]+")


def tokens(c):
    return f"list_filter(string_split_regex({c}, '[{WS}]+'), lambda t: t <> '')"


def script_tokens(c, p: LanguageProfile, n: int = 1):
    return f"list_filter(regexp_extract_all({c}, '[{CLASSES[p.name][0]}]+'), lambda t: length(t) >= {n})"


def _longest_first(words):
    return sorted(words, key=len, reverse=True)


def stem(t, p: LanguageProfile):
    """Nested CASEs; ``t`` is evaluated often, so it should be a name."""
    cases = " ".join(
        f"WHEN starts_with({t}, '{w}') AND length({t}) >= {len(w) + p.min_stem} THEN substr({t}, {len(w) + 1})"
        for w in _longest_first(p.prefixes)
    )
    return f"CASE {cases} ELSE {t} END"


def stem_end(t, p: LanguageProfile):
    cases = " ".join(
        f"WHEN suffix({t}, '{w}') AND length({t}) >= {len(w) + p.min_stem} THEN left({t}, length({t}) - {len(w)})"
        for w in _longest_first(p.suffixes)
    )
    return f"CASE {cases} ELSE {t} END"


def stem_list(ts, p: LanguageProfile):
    return f"list_transform(list_transform({ts}, lambda t: {stem('t', p)}), lambda u: {stem_end('u', p)})"


def normalized(c, p: LanguageProfile):
    letters = keep(marks(fold_final(fold(c, p), p), p), p)
    kept = f"list_filter({tokens(letters)}, lambda t: length(t) > 1 AND t NOT IN ({quoted(p.stopwords)}))"
    return f"array_to_string({stem_list(kept, p)}, ' ')"


# ---- pairs ----------------------------------------------------------------------------------


def pairs(ts: str, sep: str) -> str:
    """``ts`` must be a column."""
    return f"list_transform(range(1, len({ts})), lambda i: {ts}[i] || '{sep}' || {ts}[i + 1])"


def long_pairs(ts: str, sep: str) -> str:
    """Pairs of neighbours that both have two characters at least."""
    both = f"list_filter(range(1, len({ts})), lambda i: length({ts}[i]) > 1 AND length({ts}[i + 1]) > 1)"
    return f"list_transform({both}, lambda i: {ts}[i] || '{sep}' || {ts}[i + 1])"


# ---- style ----------------------------------------------------------------------------------


def words(c):
    return f"len({tokens(c)})"


def short_words(c):
    return f"len(list_filter({tokens(c)}, lambda t: length(t) <= 3))"


def ratio(a, b):
    return f"CAST(coalesce({a} / nullif({b}, 0), 0) AS FLOAT)"


def lines(c):
    split = rf"string_split_regex({c}, '\r\n|[\n\x0b\f\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    return f"greatest(1, len(list_filter({split}, lambda l: regexp_matches(l, '[^{WS}]'))))"


def sentences(c, p: LanguageProfile):
    split = f"string_split_regex({space(c)}, '[{CLASSES[p.name][3]}]+')"
    return f"greatest(1, len(list_filter({split}, lambda s: length(trim(s)) > 3 AND regexp_matches(s, '[{WORD}]'))))"


def foreign(c, p: LanguageProfile):
    return f"length({replace(c, rf'[^\p{{L}}]|[{CLASSES[p.name][0]}]')})"


def letters(c):
    return f"length({replace(c, r'[^\p{L}]')})"


def active(c, p: LanguageProfile):
    split = f"string_split_regex({c}, '[{CLASSES[p.name][4]}]+')"
    bare = replace("s", f"^[{WS}]+|[{WS}]+$")
    return (
        f"len(list_filter(list_transform({split}, lambda s: {bare}), "
        f"lambda s: length(s) > 3 AND NOT regexp_matches(s, '{CLASSES[p.name][5]}')))"
    )


def redundancy(ps: str) -> str:
    return f"CAST(CASE WHEN len({ps}) > 0 THEN 1 - len(list_distinct({ps})) / len({ps}) ELSE 0 END AS FLOAT)"


def style_ctes(p: LanguageProfile, source: str = "cleaned") -> str:
    """CTEs up to ``styled``, from a relation with ``text`` and ``cleaned_text``."""
    return f"""
        _tokens AS (SELECT *, {tokens('cleaned_text')} AS _ts FROM {source}),
        _pairs AS (SELECT *, {pairs('_ts', ' ')} AS _ps FROM _tokens),
        styled AS (SELECT * EXCLUDE (_ts, _ps),
            {words('cleaned_text')} AS total_words,
            {short_words('cleaned_text')} AS short_words_count,
            {ratio(short_words('cleaned_text'), words('cleaned_text'))} AS short_words_ratio,
            {lines('text')} AS total_physical_lines,
            {sentences('text', p)} AS total_sentences,
            {foreign('text', p)} AS foreign_letters_count,
            {ratio(foreign('text', p), letters('text'))} AS foreign_letters_ratio,
            {active('text', p)} AS active_voice_count,
            {redundancy('_ps')} AS redundancy_score
          FROM _pairs)"""


ALL_MEASURES = ("short_words_count", *STYLO_COLUMNS)
RATIOS = ("short_words_ratio", "foreign_letters_ratio", "redundancy_score")


def rounded(c: str, digits: int = 6) -> str:
    return f"round(CAST({c} AS DOUBLE), {digits}) AS {c}"


def measures() -> str:
    return ", ".join(rounded(c) if c in RATIOS else c for c in ALL_MEASURES)


# ---- corpora (the Spark side is in checks/tables.py) ----------------------------------------

# Letters of the given texts and the Arabic characters that stand in for them.
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyzéèß,?"
ARABIC_STAND_INS = "ابةديفغهأجكلمنوىقرستإحعشزطُّة،؟"

ARABIC_DOCS = f"""
    docs AS (SELECT d.doc_id, d.source AS subset, d.lang, l.quality AS category_encode,
        translate(lower(d.text), '{LATIN_LETTERS}', '{ARABIC_STAND_INS}') AS text
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

LATIN_DOCS = """
    docs AS (SELECT d.doc_id, d.source AS subset, d.lang, l.quality AS category_encode, d.text
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

PROCESSED = f"""{ARABIC_DOCS}, {clean_ctes('docs')},
    processed AS (SELECT *, {normalized('cleaned_text', ARABIC)} AS processed_text FROM cleaned)"""

LATIN_STYLE = f"{LATIN_DOCS}, {clean_ctes('docs')}, {style_ctes(LATIN)}"

WIDE = """
    wide AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS user_text,
        CASE WHEN role = 'assistant' THEN text END AS assistant_text, CASE WHEN role = 'system' THEN text END AS system_text
      FROM conversations)"""

SCORED = """
    scored AS (SELECT doc_id, quality AS category_encode,
        CAST('0x' || substr(md5('score-' || doc_id), 1, 2) AS BIGINT) / 256 AS score
      FROM labels),
    predicted AS (SELECT *, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)"""

RUNS = """
    runs AS (SELECT model, split, l.quality AS category_encode,
        CAST('0x' || substr(md5(model || '-' || split || '-' || l.doc_id), 1, 4) AS BIGINT) / 65536 AS score
      FROM labels l, (VALUES ('m1'), ('m2'), ('m3')) AS m(model), (VALUES ('val'), ('test')) AS s(split)),
    predicted AS (SELECT *, CASE WHEN score >= 0.4 THEN 1.0 ELSE 0.0 END AS prediction FROM runs)"""
