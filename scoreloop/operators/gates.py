"""Quality gates, dedup windows and the cleaning funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.config import LIMITS
from scoreloop.functions import scalars as S
from scoreloop.operators.sizing import materialize


# ---------------------------------------------------------------- windows

def _latest_order(ts: str, tiebreak: str) -> list:
    # pandas sorts missing timestamps last and keeps the last row: a null
    # timestamp counts as the latest. Ties are broken by the larger id.
    return [F.col(ts).desc_nulls_first(), F.col(tiebreak).desc()]


def dedup_latest(df: DataFrame, key: str = "text_hash", ts: str = "event_timestamp",
                 tiebreak: str = "id") -> DataFrame:
    """Keep the latest row per key (F1).

    ``row_number() = 1`` lets Spark insert a partial per-key limit before
    the shuffle (WindowGroupLimit), so a hot key ships one row per task.
    """
    w = Window.partitionBy(key).orderBy(*_latest_order(ts, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, key: str = "text_hash", order: list | None = None) -> DataFrame:
    """First write wins (F3): keep the earliest arrival per key."""
    order = order or [F.col("id").asc()]
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_arrival(df: DataFrame, keys: list, ts: str = "event_timestamp", tiebreak: str = "id") -> DataFrame:
    """(keys..., _first_row): the ``_row`` of the earliest row per key (time ascending,
    missing times last, then smallest id, then row) as a grouping with map-side
    partial aggregation -- a hot key costs one row per map task, not one task."""
    order = F.struct(F.col(ts).isNull(), F.col(ts), F.col(tiebreak), F.col("_row"))
    return df.groupBy(*keys).agg(F.min_by(F.col("_row"), order).alias("_first_row"))


def first_rows(df: DataFrame, key: str, ts: str = "event_timestamp", tiebreak: str = "id") -> DataFrame:
    """The earliest row per key with all its columns, in the order of ``first_arrival`` (one aggregate, partial map-side)."""
    order = F.struct(F.col(ts).isNull(), F.col(ts), F.col(tiebreak), F.col("_row"))
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[f"`{c}`" for c in df.columns]), order).alias("_r")).select("_r.*")


def duplicate_flag(df: DataFrame, key: str = "text_hash", ts: str = "event_timestamp",
                   tiebreak: str = "id") -> DataFrame:
    """Second and later copies of a key are flagged (F2), in time order.

    Not a window over all rows of a key: the first arrival per key is an
    aggregate, joined back on the key (AQE splits a skewed key's partition
    of the big side; the per-key side has one row per key)."""
    # every arriving row gets its own number, written once: a redelivered row may
    # repeat key, time and id
    df = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    first = first_arrival(df, [key], ts, tiebreak)
    j = df.join(first, df[key].eqNullSafe(first[key]), "left").drop(first[key])
    return j.withColumn("is_duplicate", F.col("_row") != F.col("_first_row")).drop("_first_row", "_row")


# ---------------------------------------------------------------- predicates

def length_ok(text: str = "text") -> Column:
    """Length in [min, max]; a null text fails."""
    return F.coalesce(S.text_length(text).between(LIMITS.min_length, LIMITS.max_length), F.lit(False))


def language_ok(lang: str = "lang", wanted: str = "en") -> Column:
    """C4: language equals ``wanted``; a failed detection (null) fails.

    A plain comparison (null -> not kept by a filter or count_if), so a
    stored language column is pushed to the parquet scan as EqualTo."""
    return F.col(lang) == F.lit(wanted)


def inconsistent(feedback: str = "user_feedback", score: str = "model_score",
                 human_max: float = LIMITS.consistency_human_max,
                 ai_min: float = LIMITS.consistency_ai_min) -> Column:
    """C6 condition to drop: human with a high score, ai with a low score.

    A null or NaN score never drops a row (Python compares NaN as false).
    """
    s = F.col(score)
    fb = F.col(feedback)
    cond = (((fb == "human") & (s > human_max)) | ((fb == "ai") & (s < ai_min))) & ~F.isnan(s)
    return F.coalesce(cond, F.lit(False))


def consistency_ok(feedback: str = "user_feedback", score: str = "model_score") -> Column:
    return ~inconsistent(feedback, score)


def target_ok(target: str = "target_score") -> Column:
    """Target present (not null, not NaN)."""
    return ~S.is_missing(target)


def gate_language(df: DataFrame, lang: str = "lang", wanted: str = "en") -> DataFrame:
    return df.filter(language_ok(lang, wanted))


def gate_length(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(length_ok(text))


def gate_consistency(df: DataFrame) -> DataFrame:
    return df.filter(consistency_ok())


def gate_target(df: DataFrame) -> DataFrame:
    return df.filter(target_ok())


# ---------------------------------------------------------------- targets

def target_remap(df: DataFrame, target: str = "target_score", feedback: str = "user_feedback") -> DataFrame:
    """If the target column is missing, or any target is missing, overwrite all.

    The any-missing flag is one scalar subquery (a global aggregate),
    not a join.
    """
    mapped = S.target_from_feedback(feedback)
    if target not in df.columns:
        return df.withColumn(target, mapped)
    any_missing = df.select(F.coalesce(F.max(S.is_missing(target).cast("int")), F.lit(0))).scalar()
    return df.withColumn(target, F.when(any_missing == 1, mapped).otherwise(F.col(target)))


def target_backfill(df: DataFrame, target: str = "target_score", feedback: str = "user_feedback") -> DataFrame:
    """Set the target only where it is null."""
    return df.withColumn(target, S.backfill_target(target, feedback))


# ---------------------------------------------------------------- funnel

def clean_feedback(df: DataFrame, variant: str = "strict", lang: str = "lang",
                   wanted: str = "en", text_only_language: bool = False) -> DataFrame:
    """The cleaning funnel (C8): dedup latest, then language, length,
    consistency, and the target gate (``strict``/``basic``) or the remap
    (``remap``).

    Length depends only on the text, and equal hash means equal text, so
    it is applied before the dedup shuffle (fewer, smaller rows to move);
    rows without a hash form one group of different texts, so their gates
    wait until the latest of them is known.
    Language moves too when it is a function of the text (a detector);
    a stored ``lang`` column stays after the dedup. Consistency must stay
    after the dedup: the latest row decides.
    """
    if variant not in ("strict", "basic", "remap"):
        raise ValueError(variant)
    no_hash = F.col("text_hash").isNull()
    pre = df.filter(no_hash | length_ok())
    if text_only_language:
        pre = pre.filter(no_hash | F.coalesce(language_ok(lang, wanted), F.lit(False)))
    out = dedup_latest(pre).filter(length_ok()).filter(language_ok(lang, wanted)).filter(consistency_ok())
    if variant == "remap":
        return target_remap(out)
    return out.filter(target_ok())


def funnel_report(df: DataFrame, lang: str = "lang", wanted: str = "en") -> DataFrame:
    """Rows left after each gate in the reference's order, removed per
    gate, and retention (%). One grouping by hash gives both the group
    sizes and the latest row; partial aggregation runs map-side.
    """
    order_key = F.struct(F.col("event_timestamp").isNull(), F.col("event_timestamp"), F.col("id"))
    # the gates become four booleans before the grouping: no text is sorted or moved
    yes = lambda c: F.coalesce(c, F.lit(False))
    flags = df.select("text_hash", F.struct(
        order_key.alias("o"), yes(language_ok(lang, wanted)).alias("lang"), yes(length_ok()).alias("len"),
        yes(consistency_ok()).alias("cons"), yes(target_ok()).alias("tgt")).alias("r"))
    latest = flags.groupBy("text_hash").agg(F.count("*").alias("n"), F.max("r").alias("r")).select("n", "r.*")
    f_lang = F.col("lang")
    f_len = f_lang & F.col("len")
    f_cons = f_len & F.col("cons")
    f_tgt = f_cons & F.col("tgt")
    agg = latest.agg(
        F.sum("n").alias("initial_rows"),
        F.count("*").alias("after_dedup"),
        F.count_if(f_lang).alias("after_language"),
        F.count_if(f_len).alias("after_length"),
        F.count_if(f_cons).alias("after_consistency"),
        F.count_if(f_tgt).alias("after_target"),
    )
    c = {k: F.coalesce(F.col(k), F.lit(0)).cast("long") for k in
         ("initial_rows", "after_dedup", "after_language", "after_length",
          "after_consistency", "after_target")}
    return agg.select(
        *[v.alias(k) for k, v in c.items()],
        (c["initial_rows"] - c["after_dedup"]).alias("removed_dedup"),
        (c["after_dedup"] - c["after_language"]).alias("removed_language"),
        (c["after_language"] - c["after_length"]).alias("removed_length"),
        (c["after_length"] - c["after_consistency"]).alias("removed_consistency"),
        (c["after_consistency"] - c["after_target"]).alias("removed_target"),
        F.round(F.try_divide(c["after_target"] * 100.0, c["initial_rows"]), 6).alias("retention_pct"),
    )
