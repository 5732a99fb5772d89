"""Column functions: text rules, tokens and style measures built from Spark's own expressions."""

from quillmark.functions.cleaning import (
    clean_text,
    squeeze_elongation,
    squeeze_punct,
    squeeze_space,
    strip_digits,
    strip_emails,
    strip_html,
    strip_urls,
)
from quillmark.functions.normalizing import fold_final, fold_letters, keep_script, normalize_text, strip_marks
from quillmark.functions.sql import register_sql_functions
from quillmark.functions.stylometry import (
    STYLO_COLUMNS,
    active_voice_count,
    doc_ttr,
    foreign_letters_count,
    foreign_letters_ratio,
    redundancy_score,
    short_words_count,
    short_words_ratio,
    stylometry,
    token_count,
    total_physical_lines,
    total_sentences,
    total_words,
    ttr_columns,
    unique_tokens,
)
from quillmark.functions.tokens import (
    bigrams,
    drop_stopwords,
    light_stem,
    min_token_length,
    ngrams,
    script_bigrams,
    script_terms,
    tokenize_lower,
    tokenize_script,
    tokenize_ws,
)

__all__ = [name for name in dir() if not name.startswith("_")]
