"""The text functions for SQL users, as SQL functions that the optimizer sees through."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quillmark.charclasses import NONBLANK, U, WORD_END
from quillmark.functions.cleaning import (
    BLANKS,
    DIGITS,
    ELONGATION,
    EMAIL,
    EMAIL_OR_DIGITS,
    REPEATED,
    REPEATED_MARK,
    TAG,
    URL,
)
from quillmark.functions.normalizing import suffix_pattern, token_pattern, unwanted_pattern
from quillmark.functions.stylometry import (
    LINES,
    NOT_LETTERS,
    active_pattern,
    not_foreign_pattern,
    segment_pattern,
    short_word_pattern,
)
from quillmark.profiles import ARABIC, LanguageProfile

PREFIX = "qm_"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, {_text(pattern)}, {_text(to)})"


def _count(pattern: str) -> str:
    return f"coalesce(regexp_count(t, {_text(pattern)}), 0)"


def _ratio(part: str, whole: str) -> str:
    return f"CAST(coalesce(try_divide({part}, {whole}), 0.0D) AS FLOAT)"


def _call(name: str) -> str:
    return f"{PREFIX}{name}(t)"


def definitions(profile: LanguageProfile = ARABIC) -> dict[str, tuple[str, str]]:
    """``{name: (type, expression over t)}``, each using only functions before it."""
    p = profile
    tail = "substring_index(t, '>', -1)"
    fold = f"translate(coalesce(t, ''), {_text(p.fold_from)}, {_text(p.fold_to)})"
    wanted = _replace(_replace(fold, p.final_from + WORD_END, p.final_to), unwanted_pattern(p))
    tokens = f"regexp_extract_all(coalesce(t, ''), {_text(U + NONBLANK + '+')}, 0)"
    pairs = f"regexp_extract_all(array_join({tokens}, ' '), {_text('(?<![^ ])(?=([^ ]+ [^ ]+))[^ ]++')}, 1)"
    no_links = f"{PREFIX}strip_urls({PREFIX}strip_html(coalesce(t, '')))"
    space = f"trim({_replace('t', BLANKS, ' ')})"
    stems = _replace(f"concat(' ', trim({_replace(wanted, BLANKS, ' ')}))", token_pattern(p), "$1")
    stems = _replace(f"concat(' ', reverse({stems}))", suffix_pattern(p), " ")
    return {
        "strip_html": ("STRING", f"concat({_replace(f'left(t, length(t) - length({tail}))', TAG)}, {tail})"),
        "strip_urls": ("STRING", _replace("t", URL)),
        "strip_emails": ("STRING", _replace("t", EMAIL)),
        "strip_digits": ("STRING", _replace("t", DIGITS)),
        "squeeze_punct": ("STRING", _replace("t", REPEATED_MARK, "$1")),
        "squeeze_elongation": ("STRING", _replace("t", ELONGATION, "$1")),
        "squeeze_space": ("STRING", space),
        "clean_text": (
            "STRING",
            f"{PREFIX}squeeze_space({_replace(_replace(no_links, EMAIL_OR_DIGITS, '$1'), REPEATED, '$1')})",
        ),
        "normalize_text": ("STRING", f"trim(reverse({stems}))"),
        "total_words": ("INT", f"size({tokens})"),
        "short_words_count": ("INT", _count(short_word_pattern())),
        "short_words_ratio": ("FLOAT", _ratio(_call("short_words_count"), _call("total_words"))),
        "total_physical_lines": ("INT", f"greatest(1, {_count(LINES)})"),
        "total_sentences": ("INT", f"greatest(1, {_count(segment_pattern(p))})"),
        "foreign_letters_count": ("INT", f"coalesce(length({_replace('t', not_foreign_pattern(p))}), 0)"),
        "foreign_letters_ratio": (
            "FLOAT",
            _ratio(_call("foreign_letters_count"), f"length({_replace('t', NOT_LETTERS)})"),
        ),
        "active_voice_count": ("INT", _count(active_pattern(p))),
        "redundancy_score": (
            "FLOAT",
            f"CAST(coalesce(1 - try_divide(size(array_distinct({pairs})), size({pairs})), 0.0D) AS FLOAT)",
        ),
        "unique_tokens": ("INT", f"size(array_distinct({tokens}))"),
        "token_count": ("INT", f"size({tokens})"),
        "doc_ttr": ("FLOAT", _ratio(_call("unique_tokens"), _call("token_count"))),
    }


def table_definitions(profile: LanguageProfile = ARABIC, min_length: int = 2) -> dict[str, tuple[str, str]]:
    """``{name: (columns, generator over t)}``.

    Each is one generator of the argument alone, so a lateral call becomes a ``Generate`` in the caller's
    plan, without a join. A null text gives no rows. In ``terms`` the words of a text are found once: the lambda's ``w``.
    """
    text = "coalesce(t, '')"
    pairs = lambda joined, sep: f"regexp_extract_all({joined}, {_text(f'(?<![^{sep}])(?=([^{sep}]+{sep}[^{sep}]+))[^{sep}]++')}, 1)"
    tokens = f"regexp_extract_all({text}, {_text(U + NONBLANK + '+')}, 0)"
    words = f"regexp_extract_all({text}, {_text(f'[{profile.letter_class}]{{{min_length},}}')}, 0)"
    named = lambda kind, of: f"transform({of}, x -> struct('{kind}' AS kind, x AS term))"
    next_to = "zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, size(w)), (x, y) -> struct('BIGRAM' AS kind, concat(x, '_', y) AS term))"
    both = f"concat({named('WORD', 'w')}, {next_to})"
    return {
        "tokens": ("pos INT, token STRING", f"posexplode({tokens})"),
        "bigrams": ("pos INT, bigram STRING", f"posexplode({pairs(f"array_join({tokens}, ' ')", ' ')})"),
        "terms": ("kind STRING, term STRING", f"inline(flatten(transform(array({words}), w -> {both})))"),
    }


def register_table_functions(spark: SparkSession, profile: LanguageProfile = ARABIC, min_length: int = 2) -> list[str]:
    """Create ``qm_tokens``, ``qm_bigrams`` and ``qm_terms`` for ``LATERAL`` in a session; return their names.

    ``qm_terms`` gives the rows of ``explode_terms`` with filtered adjacency.
    """
    made = table_definitions(profile, min_length)
    for name, (columns, generator) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{name}(t STRING) RETURNS TABLE({columns}) RETURN SELECT * FROM {generator}")
    return [f"{PREFIX}{name}" for name in made]


def register_sql_functions(spark: SparkSession, profile: LanguageProfile = ARABIC) -> list[str]:
    """Create the functions ``qm_...`` in a session; return their names."""
    made = definitions(profile)
    for name, (kind, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{name}(t STRING) RETURNS {kind} RETURN {body}")
    return [f"{PREFIX}{name}" for name in made]
