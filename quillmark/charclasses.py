"""Character classes shared by every text expression.

Fixed values: Java's own ``\\s``, ``\\w`` and ``.`` cover other characters than the Unicode
definitions the text rules are written against, so the sets are spelled out once here. The names
in capitals are bodies of, or whole, Java regex classes; patterns built from them must start with
the flag :data:`U`. Equal sets written as lists of ranges are over ten times slower to match.
"""

# Flag that makes ``\s`` and ``\S`` follow the Unicode property White_Space.
U = "(?U)"

# White space: the Unicode property and the four information separators. Body of a class.
WS = r"\s\x1c-\x1f"

# One blank, one non-blank character. Whole classes.
BLANK = f"[{WS}]"
NONBLANK = f"[^{WS}]"

# A character that does not end a physical line. Whole class.
IN_LINE = r"[[^\n\x0b\f\r\x1c-\x1e\x85]&&[^\u2028\u2029]]"

# Word characters: letters, numbers of any kind, underscore. Body of a class.
WORD = r"\p{L}\p{N}_"

# Nothing but a blank (or an end of text) on this side.
TOKEN_START = f"(?<!{NONBLANK})"
TOKEN_END = f"(?!{NONBLANK})"

# Zero-width word boundaries around a letter.
WORD_START = f"(?<![{WORD}])"
WORD_END = f"(?![{WORD}])"


def none_of(chars: str, *bodies: str) -> str:
    """Whole class of the characters that are neither in ``chars`` nor in the class bodies.

    Written as an intersection of small negated classes: one negated class with members beyond
    Latin-1 takes ten times as long to match.
    """
    plain = "".join(f"\\{c}" for c in chars if ord(c) < 128)
    parts = [plain, *(c for c in chars if ord(c) >= 128), *bodies]
    return "[" + "&&".join(f"[^{part}]" for part in parts if part) + "]"
