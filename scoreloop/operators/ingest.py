"""Feedback ingest as a batch job (C1, C2, C3, D1, F3, B1, B2, I1) and the
scoring path (I3) and rolling monitors (I4) in batch form.

A request gets one reason, the first that applies, in the service's order:
request shape -> allowed label -> language -> duplicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloop.config import ALLOWED_FEEDBACK, FEEDBACK_PATTERN, LIMITS
from scoreloop.functions import scalars as S
from scoreloop.operators import lang as L
from scoreloop.operators.sizing import bounded_lookup, materialize
from scoreloop.operators.validate import mismatch


def shape_reason(text: str = "text", score: str = "model_score", feedback: str = "user_feedback",
                 version: str = "model_version") -> Column:
    """The first request-shape problem, or null."""
    s = F.col(score)
    return (F.when(F.coalesce(F.length(text) < LIMITS.min_length, F.lit(True)), "text_too_short")
            .when(s.isNull() | F.isnan(s) | (s < 0.0) | (s > 1.0), "score_out_of_range")
            .when(~F.coalesce(F.col(feedback).rlike(FEEDBACK_PATTERN), F.lit(False)), "invalid_feedback")
            .when(F.col(version).isNull(), "missing_model_version")
            .when(~F.col(feedback).isin(*ALLOWED_FEEDBACK), "feedback_not_allowed"))


def validate_requests(req: DataFrame) -> DataFrame:
    """Requests with ``reject_reason`` (null = valid shape)."""
    return req.withColumn("reject_reason", shape_reason())


def constraint_report(df: DataFrame) -> DataFrame:
    """Violations of the store's table constraints, one row per rule."""
    dup = (df.filter(F.col("text_hash").isNotNull()).groupBy("text_hash").agg(F.count("*").alias("n"))
           .filter("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
    dup_rows = dup.select("rows").scalar()
    g = df.agg(
        F.count_if(F.col("text").isNull()).alias("text_not_null"),
        F.count_if(F.col("text_hash").isNull()).alias("text_hash_not_null"),
        F.count_if(F.col("model_score").isNull()).alias("model_score_not_null"),
        F.count_if(F.col("user_feedback").isNull()).alias("user_feedback_not_null"),
        F.count_if(~F.col("user_feedback").isin(*ALLOWED_FEEDBACK)).alias("user_feedback_allowed"),
        F.count_if(F.length("text_hash") > 64).alias("text_hash_width"),
        F.count_if(F.length("user_feedback") > 20).alias("user_feedback_width"),
        F.count_if(F.length("model_version") > 100).alias("model_version_width"),
    )
    rules = ["text_not_null", "text_hash_not_null", "model_score_not_null", "user_feedback_not_null",
             "user_feedback_allowed", "text_hash_width", "user_feedback_width", "model_version_width"]
    arr = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).cast("long").alias("violations")) for r in rules],
                  F.struct(F.lit("text_hash_unique").alias("rule"), dup_rows.cast("long").alias("violations")))
    return g.select(F.inline(arr))


def numbered(df: DataFrame) -> DataFrame:
    """Every arriving row with a number of its own; write it before using it twice."""
    return df.withColumn("_row", F.monotonically_increasing_id())


def stamped(requests: DataFrame) -> DataFrame:
    """A request as the service takes it has no id and no time: both are set on arrival
    (columns that are there stay)."""
    if "id" not in requests.columns:
        requests = requests.withColumn("id", F.xxhash64(F.expr("uuid()")))
    if "event_timestamp" not in requests.columns:
        requests = requests.withColumn("event_timestamp", F.current_timestamp().cast("timestamp_ntz"))
    return requests


def flag_duplicates(incoming: DataFrame, store: DataFrame, key: str = "text_hash",
                    eligible: Column | None = None) -> DataFrame:
    """D1 + F3 in one pass: ``is_duplicate`` is true for a row whose key is
    stored, or that is not the first arrival of its key inside the batch.
    ``eligible`` restricts the first-arrival choice to rows that passed the
    earlier checks. The first arrival per key is an aggregate (skew-safe),
    joined back with the stored keys on the key (AQE splits skewed keys)."""
    from scoreloop.operators.gates import first_arrival

    elig = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    if "_row" not in incoming.columns:  # a redelivered request may repeat key, time and id
        incoming = materialize(numbered(incoming))
    x = incoming.withColumn("_elig", elig)
    first = first_arrival(x, [key, "_elig"])
    stored = stored_keys(x, store, key)
    stored = stored.withColumn("_stored", F.lit(True))
    per_key = first.join(stored, key, "left")
    x = x.join(per_key, [x[key].eqNullSafe(per_key[key]), x["_elig"] == per_key["_elig"]], "left") \
        .drop(per_key[key]).drop(per_key["_elig"])
    dup = F.coalesce(F.col("_stored"), F.lit(False)) | (F.col("_row") != F.col("_first_row"))
    return x.withColumn("is_duplicate", dup).drop("_elig", "_first_row", "_stored")


def stored_keys(keys: DataFrame, store, key: str = "text_hash") -> DataFrame:
    """The distinct ``key`` values of ``keys`` that the store (a table or its ``KeyIndex``) holds. The store is probed only for
    these keys: size-checked, broadcast when small, they filter the store's key column map-side, so only matching keys reach
    the shuffle -- not the whole store per batch (a ``KeyIndex`` reads only the folders of these keys)."""
    from scoreloop.sources.keyindex import KeyIndex

    if isinstance(store, KeyIndex):
        return store.seen(keys.select(key))
    batch_keys = bounded_lookup(keys.select(key).filter(F.col(key).isNotNull()).distinct())
    return store.select(key).join(batch_keys, key, "left_semi").distinct()


def split_new_and_duplicates(incoming: DataFrame, store: DataFrame, key: str = "text_hash"):
    """(new, duplicates): first arrival per key not yet stored, and the rest. The first arrivals come whole out
    of one aggregate: not every row travels to its key. Texts are best left behind (``with_texts``)."""
    from scoreloop.operators.gates import first_rows

    if "_row" not in incoming.columns:  # a redelivered request may repeat key, time and id
        incoming = materialize(numbered(incoming))
    first = first_rows(incoming, key)
    new = first.join(stored_keys(first, store, key), key, "left_anti").select(*[f"`{c}`" for c in incoming.columns])
    return new.drop("_row"), incoming.join(new.select("_row"), "_row", "left_anti").select(*[f"`{c}`" for c in incoming.columns if c != "_row"])


def with_texts(new: DataFrame, requests: DataFrame, key: str = "text_hash", text: str = "text") -> DataFrame:
    """``new`` (one row a key, written before) with the text of its key, taken from ``requests``, whose ids must not change
    when they are read again. Only requests with an id of ``new`` give their text: Spark filters them where
    the ids are scanned, so of all copies of a text about one travels."""
    if new.isEmpty():  # nothing new: no text is read
        return new.withColumn(text, F.lit(None).cast("string"))
    wanted = F.col("id").isin(new.select("id"))
    if not new.filter("id is null").isEmpty():
        wanted = wanted | F.col("id").isNull()
    own = requests.filter(wanted).select(key, text)
    return new.join(own.groupBy(key).agg(F.any_value(text).alias(text)), key, "left")


def ingest_batch(incoming: DataFrame, store: DataFrame, profile, langs, key: str = "text_hash",
                 prepared: bool = False) -> DataFrame:
    """I1 batch form: every request with ``status`` ('accepted' or its first
    reason) and, for accepted rows, the target. One pass: shape check,
    one language detection per distinct text, then the duplicate flag."""
    given = "_row" in incoming.columns
    r = incoming if given else numbered(incoming)
    r = r.withColumn("text_hash", S.text_hash("text")).withColumn("reject_reason", shape_reason())
    r = L.with_language(r, profile, langs, key="text_hash", prepared=prepared)
    r = r.withColumn("reject_reason", F.coalesce(F.col("reject_reason"), L.language_reason()))
    # the narrow request rows (no text) are used twice by the duplicate flag:
    # write them once instead of re-running the detection for each use
    r = materialize(r.select("_row", "id", key, "user_feedback", "event_timestamp", "reject_reason"))
    f = flag_duplicates(r, store, key, eligible=F.col("reject_reason").isNull())
    status = F.coalesce(F.col("reject_reason"), F.when(F.col("is_duplicate"), "duplicate"), F.lit("accepted"))
    return f.select(*(["_row"] if given else []), "id", "text_hash", status.alias("status"),
                    F.when(status == "accepted", S.target_from_feedback("user_feedback")).alias("target_score"))


def accepted_rows(incoming: DataFrame, store: DataFrame, profile, langs, stamp: Column | None = None,
                  prepared: bool = False) -> DataFrame:
    """Rows to append to the store (A8 input): accepted requests with hash,
    target (B2, as the insert trigger would set it) and time stamp. Ids must
    not change when ``incoming`` is read again (write ``stamped`` requests first)."""
    r = incoming.withColumn("text_hash", S.text_hash("text")).filter(shape_reason().isNull())
    # judged without texts; the language is a function of the text, so one text a new key is read for it
    new, _ = split_new_and_duplicates(materialize(numbered(r.drop("text"))), store)
    new = with_texts(materialize(new), r)
    new = L.with_language(new, profile, langs, key="text_hash", prepared=prepared, unique_keys=True).filter(L.language_reason().isNull())
    ts = stamp if stamp is not None else F.col("event_timestamp")
    # written once: the append probes their keys before it writes them
    return materialize(new.select("id", "text", "text_hash", "model_score", "user_feedback", "model_version",
                                  ts.alias("event_timestamp"), S.target_from_feedback("user_feedback").alias("target_score")))


def predict_batch(docs: DataFrame, profile, langs, weights, key: str = "id",
                  text: str = "text", prepared: bool = False) -> DataFrame:
    """I3 batch form: language gate, linear score, band; rejected texts get
    a reason and no score. Keys are request ids (unique).

    Detection and scoring each reduce a text to one row per key map-side;
    the two per-key results are joined, so texts are never shuffled. (Every
    text is scored; the gate only decides what is reported.)"""
    from scoreloop.operators.vocab import score_linear

    src = docs.select(key, text)
    det = L.detect(src, profile, langs, key=key, text=text, prepared=prepared)
    sc = score_linear(src, weights, key=key, text=text, prepared=prepared)   # one row per key
    j = sc.join(det, key, "left").withColumn("reason", L.language_reason())
    score = F.when(F.col("reason").isNull(), F.col("score"))
    return j.select(key, "detected_lang", "reason", F.round(score, 6).alias("score"),
                    S.score_band(score).alias("label"))


def monitor(df: DataFrame, duration: str, slide: str | None = None, ts: str = "event_timestamp") -> DataFrame:
    """I4 batch form: per event-time window, rows, mean score, mismatch
    share (E6 rule) and AI-label share."""
    win = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    g = df.groupBy(win.alias("w")).agg(
        F.count("*").cast("long").alias("n"),
        F.round(F.avg(F.when(~F.isnan("model_score"), F.col("model_score"))), 6).alias("mean_score"),
        F.round(F.avg(mismatch().cast("double")), 6).alias("mismatch_ratio"),
        F.round(F.avg((F.col("user_feedback") == "ai").cast("double")), 6).alias("ai_share"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n", "mean_score", "mismatch_ratio", "ai_share")
