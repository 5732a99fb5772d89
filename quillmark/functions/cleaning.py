"""Text cleaning rules, ``Column -> Column``.

Each rule is one pass of a regular expression written to run in linear time on any input:
runs are possessive and token rules are anchored at the token start, so a long token without
white space or an unclosed ``<`` never makes the matcher retry from every position.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.charclasses import BLANK, NONBLANK, TOKEN_START, U, WS

TAG = "<[^>]+>"
URL = f"{U}(?:http|www){NONBLANK}+"
# A token with an @ that has a character on both sides; the token goes as a whole.
EMAIL = f"{U}{TOKEN_START}{NONBLANK}[^{WS}@]*+@{NONBLANK}++"
DIGITS = r"\p{Nd}+"
REPEATED_MARK = r"([\u061f!.,])\1++"
ELONGATION = r"([^\n])\1{2,}+"
# A blank run that is not one space already: most are, and need no replacement.
BLANKS = f"{U}{BLANK}(?:(?<! ){BLANK}*+|{BLANK}++)"
# Two neighbouring rules in one pass. That cannot change the result: an e-mail address is matched at
# its first character, before any digit in it, and squeezing marks never brings others together.
# A text without any @ or digit, as most are, is one match and put back as group 1: no place in it is tried on its own.
EMAIL_OR_DIGITS = rf"{U}\A([^@\p{{Nd}}]++)\z|{EMAIL}|{DIGITS}"
# Both squeezing rules look for a second equal character first, which most places lack.
REPEATED = r"([^\n])\1(?:\1++|(?<=[\u061f!.,]))"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_html(c) -> Column:
    """Remove ``<...>`` tags.

    No tag can start after the last ``>``, so that tail is kept aside: the pattern then never
    runs to the end of the text in vain.
    """
    c = _col(c)
    tail = F.substring_index(c, ">", -1)
    head = F.left(c, F.length(c) - F.length(tail))
    return F.concat(F.regexp_replace(head, TAG, ""), tail)


def strip_urls(c) -> Column:
    """Remove everything from ``http`` or ``www`` to the next blank."""
    return F.regexp_replace(_col(c), URL, "")


def strip_emails(c) -> Column:
    """Remove tokens of the form ``something@something``."""
    return F.regexp_replace(_col(c), EMAIL, "")


def strip_digits(c) -> Column:
    """Remove decimal digits of every script."""
    return F.regexp_replace(_col(c), DIGITS, "")


def squeeze_punct(c) -> Column:
    """Two or more of the same ``؟ ! . ,`` become one."""
    return F.regexp_replace(_col(c), REPEATED_MARK, "$1")


def squeeze_elongation(c) -> Column:
    """Three or more of the same character (line feed excepted) become one."""
    return F.regexp_replace(_col(c), ELONGATION, "$1")


def squeeze_space(c) -> Column:
    """White-space runs become one space; none is left at either end."""
    return F.trim(F.regexp_replace(_col(c), BLANKS, " "))


def clean_text(c) -> Column:
    """All cleaning rules in their fixed order; null gives the empty string."""
    c = strip_urls(strip_html(F.coalesce(_col(c), F.lit(""))))
    c = F.regexp_replace(c, EMAIL_OR_DIGITS, "$1")
    return squeeze_space(F.regexp_replace(c, REPEATED, "$1"))
