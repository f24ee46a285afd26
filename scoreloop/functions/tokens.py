"""Word-level tokens with built-in regex functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloop.config import TOKEN_PATTERN, TRAINING

TRIGRAM_PATTERN = "(?s)(?=(.{3}))."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text="text") -> Column:
    """All tokens of the whole text, in order."""
    return F.regexp_extract_all(_c(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_length(text="text") -> Column:
    """Number of tokens plus the start and end marks, before truncation."""
    return F.size(tokens(text)) + 2


def truncated_length(text="text", max_tokens: int = TRAINING.max_tokens) -> Column:
    """Characters of the text kept by truncation to ``max_tokens`` (marks excluded)."""
    return F.length(F.array_join(F.slice(tokens(text), 1, max_tokens - 2), ""))


def char_trigrams(text="text") -> Column:
    """Lower-case character 3-grams of the whole text, one per code point
    position (none below 3 characters).

    One linear regex pass: each match consumes one code point and a
    lookahead captures the 3 code points starting there. (Indexing with
    substring per position would rescan the UTF-8 text each time.)
    """
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TRIGRAM_PATTERN), F.lit(1))
