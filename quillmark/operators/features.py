"""Feature vectors as Spark ML stages."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, VectorAssembler

from quillmark.functions.stylometry import STYLO_COLUMNS

NUM_FEATURES = 10_000
MIN_DOC_FREQ = 2


def term_frequency(tokens: str = "tokens", out: str = "raw_tf", num_features: int = NUM_FEATURES) -> HashingTF:
    """Hashed term frequencies."""
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=num_features)


def inverse_document_frequency(tf: str = "raw_tf", out: str = "tfidf_features", min_doc_freq: int = MIN_DOC_FREQ) -> IDF:
    """IDF weights, to be fitted on the training split only."""
    return IDF(inputCol=tf, outputCol=out, minDocFreq=min_doc_freq)


def tfidf_stages(
    text: str = "processed_text", num_features: int = NUM_FEATURES, min_doc_freq: int = MIN_DOC_FREQ, ngram: int = 1
) -> list:
    """Lower-casing tokenizer, optional n-grams, hashed term frequencies, IDF."""
    stages = [RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\s+", gaps=True)]
    if ngram > 1:
        stages.append(NGram(n=ngram, inputCol="tokens", outputCol="ngrams"))
    stages.append(term_frequency("ngrams" if ngram > 1 else "tokens", num_features=num_features))
    return [*stages, inverse_document_frequency(min_doc_freq=min_doc_freq)]


def assemblers(columns: tuple[str, ...] = STYLO_COLUMNS, tfidf: str = "tfidf_features") -> list:
    """``features_stylo`` and ``features``; rows with a null or NaN measure are skipped.

    The column list is stored with the stages, so training and serving cannot disagree on it.
    """
    make = lambda cols, out: VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip")
    return [make(columns, "features_stylo"), make([*columns, tfidf], "features")]


def feature_pipeline(
    num_features: int = NUM_FEATURES,
    min_doc_freq: int = MIN_DOC_FREQ,
    ngram: int = 1,
    columns: tuple[str, ...] = STYLO_COLUMNS,
) -> Pipeline:
    """From style measures and ``processed_text`` to ``features``, as one object to fit."""
    return Pipeline(stages=[*tfidf_stages("processed_text", num_features, min_doc_freq, ngram), *assemblers(columns)])
