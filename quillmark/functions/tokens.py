"""Tokens, stopwords, stems and n-grams, ``Column -> Column``."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.charclasses import NONBLANK, U
from quillmark.functions.cleaning import _col
from quillmark.profiles import ARABIC, LanguageProfile


def _extract_all(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def tokenize_ws(c, min_length: int = 1) -> Column:
    """White-space tokens of at least ``min_length``, none empty; null gives an empty array."""
    return _extract_all(F.coalesce(_col(c), F.lit("")), f"{U}{NONBLANK}{{{min_length},}}")


def tokenize_lower(c) -> Column:
    """White-space tokens of the lower-cased text."""
    return tokenize_ws(F.lower(_col(c)))


def tokenize_script(c, profile: LanguageProfile = ARABIC, min_length: int = 1) -> Column:
    """Maximal runs of native-script characters of at least ``min_length``."""
    pattern = f"[{profile.letter_class}]{{{min_length},}}"
    return _extract_all(F.coalesce(_col(c), F.lit("")), pattern)


def drop_stopwords(tokens, profile: LanguageProfile = ARABIC) -> Column:
    """Tokens that are not in the profile's stopword list; repeats are kept."""
    return F.filter(_col(tokens), lambda t: ~t.isin(*profile.stopwords))


def min_token_length(tokens, n: int = 2) -> Column:
    """Tokens of at least ``n`` characters."""
    return F.filter(_col(tokens), lambda t: F.length(t) >= n)


def affixes(words: tuple[str, ...]) -> str:
    """Alternation that tries longer affixes first."""
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


def prefix_tree(words: tuple[str, ...]) -> str:
    """The alternation of :func:`affixes` with common beginnings written once, so that few branches are tried.

    Like there, longer words are tried first. Java tries every branch of an alternation in turn.
    """
    rests: dict[str, list[str]] = {}
    for w in filter(None, words):
        rests.setdefault(w[0], []).append(w[1:])
    branches = [re.escape(first) + prefix_tree(tuple(rest)) for first, rest in rests.items()]
    whole = "|".join(branches)
    if "" in words:
        return f"(?:{whole})?" if branches else ""
    return f"(?:{whole})" if len(branches) > 1 else whole


def light_stem(token, profile: LanguageProfile = ARABIC) -> Column:
    """Strip at most one prefix, then at most one suffix.

    The longest affix that leaves ``profile.min_stem`` letters is taken.
    """
    keep = profile.min_stem
    prefix = rf"(?s)\A(?:{affixes(profile.prefixes)})(?=.{{{keep}}})"
    suffix = rf"(?s)(?<=.{{{keep}}})(?:{affixes(profile.suffixes)})\z"
    return F.regexp_replace(F.regexp_replace(_col(token), prefix, ""), suffix, "")


def pairs_of(joined: Column, sep: str, min_length: int = 1) -> Column:
    """Adjacent pairs of a string of tokens joined by ``sep``, a character no token contains.

    A look-ahead captures ``token sep token`` while the match itself moves on by one token, so
    the pairs overlap and the text is read in place without an intermediate token array.
    """
    s = re.escape(sep)
    word = f"[^{s}]{{{min_length},}}"
    return _extract_all(joined, f"(?<![^{s}])(?=({word}{s}{word}))[^{s}]++", 1)


def ngrams(tokens, n: int = 2, sep: str = " ") -> Column:
    """Runs of ``n`` adjacent tokens joined by ``sep``; fewer than ``n`` tokens give none.

    Shifted copies of the array are zipped, which reads each token ``n`` times at most. Tokens may
    hold any character.
    """
    t = _col(tokens)
    runs = F.greatest(F.size(t) - (n - 1), F.lit(0))
    shifted = (F.slice(t, F.lit(k), runs) for k in range(1, n + 1))
    return reduce(lambda left, right: F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(sep), b)), shifted)


def bigrams(tokens, sep: str = "_") -> Column:
    """Adjacent pairs of a token array as ``a<sep>b``."""
    return ngrams(tokens, 2, sep)


def script_bigrams(
    c, profile: LanguageProfile = ARABIC, sep: str = "_", adjacency: str = "filtered", min_length: int = 2
) -> Column:
    """Pairs of native-script tokens of at least ``min_length`` characters.

    ``adjacency="original"`` pairs tokens that stand next to each other in the text;
    ``"filtered"`` drops the short tokens first, so their neighbours become adjacent.
    ``sep`` must not belong to the script.
    """
    return script_terms(c, profile, sep, adjacency, min_length)[1]


def script_terms(
    c, profile: LanguageProfile = ARABIC, sep: str = "_", adjacency: str = "filtered", min_length: int = 2
) -> tuple[Column, Column]:
    """The words and the bigrams of a text, see :func:`script_bigrams`."""
    words = tokenize_script(c, profile, min_length)
    if adjacency == "filtered":
        return words, pairs_of(F.array_join(words, sep), sep)
    if adjacency == "original":
        every = tokenize_script(c, profile)
        return words, pairs_of(F.array_join(every, sep), sep, min_length)
    raise ValueError(f"adjacency must be 'filtered' or 'original', not {adjacency!r}")
