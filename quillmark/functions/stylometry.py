"""Measures of style, ``Column -> Column``.

Counts are taken by matching, not by splitting: a pattern anchored at the start of a line,
segment or sentence matches exactly those that count. Null and blank texts give 0, 0.0 or, for
lines and sentences, 1. Ratios are 32-bit floats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.charclasses import BLANK, IN_LINE, NONBLANK, TOKEN_END, TOKEN_START, U, WORD, WS, none_of
from quillmark.functions.cleaning import _col
from quillmark.functions.tokens import pairs_of, tokenize_ws
from quillmark.profiles import ARABIC, LanguageProfile

SHORT_WORD = 3
MIN_SEGMENT = 4  # characters a segment or sentence needs to count

# The measures in the order they enter a feature vector.
STYLO_COLUMNS = (
    "short_words_ratio",
    "total_physical_lines",
    "foreign_letters_count",
    "foreign_letters_ratio",
    "active_voice_count",
    "redundancy_score",
    "total_words",
    "total_sentences",
)


def _count(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("float")


# A line counts from its first non-blank character.
LINES = f"{U}{NONBLANK}{IN_LINE}*+"
NOT_LETTERS = r"\P{L}+"


def short_word_pattern(short: int = SHORT_WORD) -> str:
    """A token of at most ``short`` characters."""
    return f"{U}{TOKEN_START}{NONBLANK}{{1,{short}}}{TOKEN_END}"


def segment_pattern(profile: LanguageProfile) -> str:
    """A run without segment marks that has a word character and over 3 characters between blanks.

    A blank run counts as one character: the run starts with a non-blank, goes on for two non-blanks
    or blank runs and then holds another non-blank.
    """
    inside = none_of(profile.segment_marks)
    solid = none_of(profile.segment_marks, WS)
    word_ahead = f"(?={none_of(profile.segment_marks, WORD)}*+[{WORD}])"
    return f"{U}(?<!{inside}){word_ahead}{BLANK}*+{solid}(?:{BLANK}++|{solid}){{{MIN_SEGMENT - 2}}}{BLANK}*+{solid}"


def active_pattern(profile: LanguageProfile) -> str:
    """A run without sentence marks, over 3 characters between blanks, without a passive marker."""
    inside = none_of(profile.sentence_marks)
    outer = none_of(profile.sentence_marks, WS)
    no_passive = f"(?!{inside}*?(?:{profile.passive_pattern}))"
    return f"{U}(?<!{inside}){BLANK}*+{no_passive}{outer}{inside}{{{MIN_SEGMENT - 2},}}{outer}"


def not_foreign_pattern(profile: LanguageProfile) -> str:
    """Everything but letters of other scripts."""
    return rf"[\P{{L}}{profile.letter_class}]+"


def total_words(c) -> Column:
    """White-space tokens."""
    return F.size(tokenize_ws(c))


def short_words_count(c, short: int = SHORT_WORD) -> Column:
    """Tokens of at most ``short`` characters."""
    return _count(_col(c), short_word_pattern(short))


def short_words_ratio(c, short: int = SHORT_WORD) -> Column:
    """Share of short tokens."""
    return _ratio(short_words_count(c, short), total_words(c))


def total_physical_lines(c) -> Column:
    """Lines that are not blank, at least 1."""
    return F.greatest(F.lit(1), _count(_col(c), LINES))


def total_sentences(c, profile: LanguageProfile = ARABIC) -> Column:
    """Segments between punctuation marks with a word character and over 3 characters, at least 1."""
    return F.greatest(F.lit(1), _count(_col(c), segment_pattern(profile)))


def _rest(c: Column, pattern: str) -> Column:
    """Characters left without the matches."""
    return F.coalesce(F.length(F.regexp_replace(c, pattern, "")), F.lit(0))


def foreign_letters_count(c, profile: LanguageProfile = ARABIC) -> Column:
    """Letters of any script but the profile's."""
    return _rest(_col(c), not_foreign_pattern(profile))


def foreign_letters_ratio(c, profile: LanguageProfile = ARABIC) -> Column:
    """Share of foreign letters among all letters."""
    return _ratio(foreign_letters_count(c, profile), _rest(_col(c), NOT_LETTERS))


def active_voice_count(c, profile: LanguageProfile = ARABIC) -> Column:
    """Sentences over 3 characters without a passive marker."""
    return _count(_col(c), active_pattern(profile))


def redundancy_score(c) -> Column:
    """Share of adjacent word pairs that repeat an earlier pair; 0.0 under two words."""
    pairs = pairs_of(F.array_join(tokenize_ws(c), " "), " ")
    repeated = 1 - F.try_divide(F.size(F.array_distinct(pairs)), F.size(pairs))
    return F.coalesce(repeated, F.lit(0.0)).cast("float")


def token_count(c) -> Column:
    """White-space tokens of a processed text."""
    return total_words(c)


def unique_tokens(c) -> Column:
    """Distinct white-space tokens."""
    return F.size(F.array_distinct(tokenize_ws(c)))


def doc_ttr(c) -> Column:
    """Distinct tokens / tokens."""
    return _ratio(unique_tokens(c), token_count(c))


def stylometry(
    df: DataFrame, raw: str = "text", cleaned: str = "cleaned_text", profile: LanguageProfile = ARABIC
) -> DataFrame:
    """Add the nine measures: word measures on the cleaned text, the others on the raw one."""
    return df.withColumns(
        {
            "total_words": total_words(cleaned),
            "short_words_count": short_words_count(cleaned),
            "short_words_ratio": short_words_ratio(cleaned),
            "total_physical_lines": total_physical_lines(raw),
            "total_sentences": total_sentences(raw, profile),
            "foreign_letters_count": foreign_letters_count(raw, profile),
            "foreign_letters_ratio": foreign_letters_ratio(raw, profile),
            "active_voice_count": active_voice_count(raw, profile),
            "redundancy_score": redundancy_score(cleaned),
        }
    )


def ttr_columns(df: DataFrame, processed: str = "processed_text") -> DataFrame:
    """Add ``unique_tokens``, ``token_count`` and ``doc_ttr``."""
    return df.withColumns(
        {
            "unique_tokens": unique_tokens(processed),
            "token_count": token_count(processed),
            "doc_ttr": doc_ttr(processed),
        }
    )
