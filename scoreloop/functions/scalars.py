"""Scalar column expressions (hash, targets, bands, residuals, lengths, ages)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoreloop.config import BANDS, FEEDBACK_TO_SCORE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_hash(text="text") -> Column:
    """SHA-256 of the UTF-8 text as 64 lower-case hex characters."""
    return F.sha2(_c(text), 256)


def target_from_feedback(feedback="user_feedback") -> Column:
    """human 0, human_edited_ai 0.5, ai 1; anything else null."""
    fb = _c(feedback)
    expr = None
    for label, score in FEEDBACK_TO_SCORE.items():
        expr = (F.when(fb == label, F.lit(score)) if expr is None
                else expr.when(fb == label, F.lit(score)))
    return expr.otherwise(F.lit(None).cast("double"))


def backfill_target(target="target_score", feedback="user_feedback") -> Column:
    """Fill the target only where it is null; set values stay."""
    return F.coalesce(_c(target), target_from_feedback(feedback))


def is_missing(x) -> Column:
    """Null or NaN (a float column's missing value)."""
    c = _c(x)
    return c.isNull() | F.isnan(c)


def score_band(score="score", reversed_polarity: bool = False) -> Column:
    """Band a score: below low, low..high (both ends in the middle), above high.

    Service polarity: low score = human. ``reversed_polarity`` gives the
    evaluation's labels (low score = AI).
    """
    s = _c(score)
    lo, mid, hi = BANDS.label_low, BANDS.label_mid, BANDS.label_high
    if reversed_polarity:
        lo, hi = hi, lo
    return (F.when(s.isNull() | F.isnan(s), F.lit(None).cast("string"))
            .when(s < BANDS.low, lo)
            .when(s <= BANDS.high, mid)
            .otherwise(hi))


def band_to_feedback(band="label") -> Column:
    """The page's mapping from a band label to the feedback code."""
    b = _c(band)
    return (F.when(b == BANDS.label_low, "human")
            .when(b == BANDS.label_mid, "human_edited_ai")
            .when(b == BANDS.label_high, "ai"))


def score_display(score="score", places: int = 3) -> Column:
    """Score shown with a fixed number of decimals."""
    return F.format_string(f"%.{places}f", _c(score))


def binarise(pred="y_pred", threshold: float = 0.5) -> Column:
    """1 where pred >= threshold, else 0."""
    return (_c(pred) >= F.lit(threshold)).cast("int")


def residual(y_true="y_true", y_pred="y_pred") -> Column:
    return _c(y_true) - _c(y_pred)


def abs_error(y_true="y_true", y_pred="y_pred") -> Column:
    return F.abs(residual(y_true, y_pred))


def text_length(text="text") -> Column:
    """Length in code points."""
    return F.length(_c(text))


def age_days(ts="event_timestamp", as_of=None) -> Column:
    """Age in days of a timestamp (read as UTC wall clock) relative to ``as_of``.

    Computed on TIMESTAMP_NTZ values, so the result does not depend on the
    session time zone (no daylight-saving shifts)."""
    ref = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else _c(as_of).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", _c(ts).cast("timestamp_ntz"), ref) / F.lit(86400e6)


def label_double(label="label") -> Column:
    return _c(label).cast("double")


def text_or_nan(text="text") -> Column:
    """A missing text shown as the word 'nan' (as a string cast of a float NaN)."""
    return F.coalesce(_c(text), F.lit("nan"))
