"""Thresholds and fixed values in one place.

These are fixed values: they must equal the reference's for results to agree.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    # Fixed values (quality gates and validation limits).
    min_length: int = 5
    max_length: int = 1000
    min_samples: int = 100
    max_duplicate_ratio: float = 0.05
    max_single_class_ratio: float = 0.85
    max_mean_score_drift: float = 0.2
    max_avg_age_days: float = 30.0
    max_feedback_mismatch: float = 0.1
    max_null_ratio: float = 0.01
    # consistency gate: human above / ai below
    consistency_human_max: float = 0.7
    consistency_ai_min: float = 0.3
    # alignment check: human above / ai below
    mismatch_human_above: float = 0.8
    mismatch_ai_below: float = 0.2


@dataclass(frozen=True)
class Bands:
    # Fixed values (score bands and evaluation cuts).
    low: float = 0.35
    high: float = 0.65
    confusion_thresholds: tuple = (0.3, 0.5, 0.7)
    actual_cut: float = 0.5
    # band labels, service polarity (high score = AI)
    label_low: str = "Human-written"
    label_mid: str = "Human-edited AI"
    label_high: str = "AI-generated"


@dataclass(frozen=True)
class Training:
    # Fixed values (training settings).
    max_tokens: int = 512
    batch_size: int = 4
    seed: int = 42
    train_ratio: float = 0.7
    val_ratio: float = 0.15
    test_ratio: float = 0.15
    patience: int = 2
    min_improvement: float = 0.02
    metric_key: str = "test_mae"


# Feedback label -> regression target.
FEEDBACK_TO_SCORE = {"human": 0.0, "human_edited_ai": 0.5, "ai": 1.0}
ALLOWED_FEEDBACK = ("human", "ai", "human_edited_ai")
FEEDBACK_PATTERN = "^(human|ai|human_edited_ai)$"

# Special token ids (start, pad, end, unknown).
TOKEN_BOS, TOKEN_PAD, TOKEN_EOS, TOKEN_UNK = 0, 1, 2, 3

# Word-level token pattern shared by Spark (Java regex) and DuckDB (RE2).
TOKEN_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

LIMITS = Limits()
BANDS = Bands()
TRAINING = Training()


@dataclass(frozen=True)
class Sizing:
    """Row bounds for lookup tables that may be broadcast.

    A derived lookup (language profile, vocabulary, token weights) is
    broadcast only if its counted size is at most this; otherwise the join
    falls back to a shuffle join.
    """

    max_broadcast_rows: int = 2_000_000
    max_broadcast_bytes: int = 128 * 1024 * 1024


SIZING = Sizing()
