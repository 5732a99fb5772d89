"""Letter folding, diacritics, script filter and the full normalisation, ``Column -> Column``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.charclasses import NONBLANK, U, WORD_END
from quillmark.functions.cleaning import _col, squeeze_space
from quillmark.functions.tokens import prefix_tree
from quillmark.profiles import ARABIC, LanguageProfile


def fold_letters(c, profile: LanguageProfile = ARABIC) -> Column:
    """Replace letter variants by their base letter."""
    return F.translate(_col(c), profile.fold_from, profile.fold_to)


def fold_final(c, profile: LanguageProfile = ARABIC) -> Column:
    """Replace the word-final letter where no word character follows it."""
    return F.regexp_replace(_col(c), re.escape(profile.final_from) + WORD_END, profile.final_to)


def strip_marks(c, profile: LanguageProfile = ARABIC) -> Column:
    """Remove diacritics."""
    return F.regexp_replace(_col(c), f"[{profile.mark_class}]+", "")


def keep_script(c, profile: LanguageProfile = ARABIC) -> Column:
    """Delete every character that is neither kept by the profile nor white space."""
    return F.regexp_replace(_col(c), rf"{U}[\S&&[^\x1c-\x1f{profile.keep_class}]]+", "")


def unwanted_pattern(profile: LanguageProfile) -> str:
    """Diacritics, and characters that are neither kept by the profile nor white space.

    One class of what is not wanted, so that each character is tried once: a union of classes took six times as long on eight
    cores as on one, timed alone, and two alternatives are tried in turn. The cheap test comes first, so that kept characters
    never reach the one for white space.
    """
    return rf"{U}[[^ [{profile.keep_class}&&[^{profile.mark_class}]]]&&{NONBLANK}]+"


def token_pattern(profile: LanguageProfile) -> str:
    """A blank and what goes behind it: a whole token to drop, or a prefix, whose blank is group 1 and stays.

    For texts whose tokens all have one space in front. The pattern starts with that space, so no other character is tried.
    """
    dropped = f"(?:[^ ]|{prefix_tree(profile.stopwords)})(?![^ ])"
    prefixes = prefix_tree(profile.prefixes)
    prefix = f"{prefixes}(?=[^ ]{{{profile.min_stem}}})(?<=( ){prefixes})"  # caught last: Java keeps groups of failed tries
    return f" (?:{dropped}|{prefix})"


def suffix_pattern(profile: LanguageProfile) -> str:
    """A blank and a suffix in a text written backwards, where a suffix stands in front like a prefix."""
    backwards = tuple(w[::-1] for w in profile.suffixes)
    return f" {prefix_tree(backwards)}(?=[^ ]{{{profile.min_stem}}})"


def normalize_text(c, profile: LanguageProfile = ARABIC) -> Column:
    """Fold, strip marks, keep the script, drop stopwords and one-letter tokens, stem.

    The token rules act on the text itself rather than on a token array: same result as tokenising,
    filtering, stemming each token and joining, in generated code. Suffixes go while the text is turned round:
    looking for one behind every character of a token takes three times as long.
    """
    c = fold_final(fold_letters(F.coalesce(_col(c), F.lit("")), profile), profile)
    c = F.regexp_replace(c, unwanted_pattern(profile), "")
    blank = F.lit(" ")
    c = F.regexp_replace(F.concat(blank, squeeze_space(c)), token_pattern(profile), "$1")
    c = F.regexp_replace(F.concat(blank, F.reverse(c)), suffix_pattern(profile), " ")
    return F.trim(F.reverse(c))
