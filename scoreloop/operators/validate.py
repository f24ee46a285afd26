"""Dataset validation (E2-E8) and drift state.

Every check runs on any table: one global aggregate, one grouping by hash
and one grouping by label, combined through scalar subqueries (one row
each), then unpivoted to one row per check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop.config import LIMITS
from scoreloop.functions import scalars as S

# Columns the training step needs.
REQUIRED_COLUMNS = ("text", "text_hash", "user_feedback", "model_score", "target_score", "event_timestamp")


def missing_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> list[str]:
    """Required-column difference (schema metadata, no job)."""
    return sorted(set(required) - set(df.columns))


def _missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return S.is_missing(c)
    return F.col(c).isNull()


def null_ratio(df: DataFrame) -> DataFrame:
    """Share of missing values per column (NaN counts as missing)."""
    cols = df.columns
    wide = df.agg(*[F.avg(_missing(df, c).cast("double")).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_ratio)")
    return long.select("column_name", F.round("null_ratio", 6).alias("null_ratio"),
                       F.coalesce(F.col("null_ratio") > LIMITS.max_null_ratio, F.lit(False)).alias("too_many"))


def duplicate_stats(df: DataFrame, key: str = "text_hash") -> DataFrame:
    """Second and later copies per key over all rows (null keys are one group)."""
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    return g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                 F.count("*").cast("long").alias("groups")).select(
        "rows", "groups",
        F.try_divide((F.col("rows") - F.col("groups")).cast("double"), F.col("rows").cast("double"))
        .alias("duplicate_ratio"))


def label_distribution(df: DataFrame, label: str = "target_score") -> DataFrame:
    """E5: share of each label value among the non-missing labels, not rounded (a limit reads it)."""
    present = df.filter(~S.is_missing(label))
    counts = present.groupBy(label).agg(F.count("*").alias("n"))
    total = present.select(F.count("*")).scalar()
    return counts.select(F.col(label).alias("label"), F.col("n").cast("long").alias("n"),
                         F.try_divide(F.col("n").cast("double"), total).alias("share"))


def mismatch(feedback: str = "user_feedback", score: str = "model_score") -> Column:
    """Feedback strongly against the score (human > 0.8, ai < 0.2)."""
    s, fb = F.col(score), F.col(feedback)
    cond = (((fb == "human") & (s > LIMITS.mismatch_human_above)) |
            ((fb == "ai") & (s < LIMITS.mismatch_ai_below))) & ~F.isnan(s)
    return F.coalesce(cond, F.lit(False))


def in_range(target: str = "target_score") -> Column:
    """Target within [0, 1]; a missing target is out of range."""
    return F.coalesce(F.col(target).between(0.0, 1.0) & ~F.isnan(F.col(target)), F.lit(False))


def global_checks(df: DataFrame, as_of: str) -> DataFrame:
    """One pass: rows, max null ratio, mismatch, age, range, mean score."""
    cols = df.columns
    nulls = [F.avg(_missing(df, c).cast("double")) for c in cols]
    return df.agg(
        F.count("*").cast("long").alias("n_rows"),
        (F.greatest(*nulls) if len(nulls) > 1 else nulls[0]).alias("max_null_ratio"),
        F.avg(mismatch().cast("double")).alias("mismatch_ratio"),
        F.avg(S.age_days("event_timestamp", as_of)).alias("avg_age_days"),
        F.min(in_range().cast("int")).alias("target_in_range"),
        F.avg(F.when(~F.isnan("model_score"), F.col("model_score"))).alias("mean_score"),
    )


def latest_baseline(history: DataFrame | None) -> Column:
    """Latest stored mean (``max_by(mean, run_ts)``), or null."""
    if history is None:
        return F.lit(None).cast("double")
    return history.select(F.max_by("mean_score", "run_ts")).scalar()


def _checks() -> Column:
    """The ten verdicts of a row with c2 ... c10 and no_baseline, as an array of structs."""
    rows = [
        (1, "required_columns", F.lit(0.0), 0.0, F.lit("pass")),
        (2, "min_samples", F.col("c2"), float(LIMITS.min_samples),
         F.when(F.col("c2") < LIMITS.min_samples, "fail").otherwise("pass")),
        (3, "null_ratio", F.col("c3"), LIMITS.max_null_ratio,
         F.when(F.col("c3") > LIMITS.max_null_ratio, "fail").otherwise("pass")),
        (4, "duplicate_ratio", F.col("c4"), LIMITS.max_duplicate_ratio,
         F.when(F.col("c4") > LIMITS.max_duplicate_ratio, "fail").otherwise("pass")),
        (5, "max_label_share", F.col("c5"), LIMITS.max_single_class_ratio,
         F.when(F.col("c5") > LIMITS.max_single_class_ratio, "fail").otherwise("pass")),
        (6, "label_classes", F.col("c6"), 2.0,
         F.when(F.col("c6") < 2, "fail").otherwise("pass")),
        (7, "feedback_mismatch", F.col("c7"), LIMITS.max_feedback_mismatch,
         F.when(F.col("c7") > LIMITS.max_feedback_mismatch, "fail").otherwise("pass")),
        (8, "freshness_days", F.col("c8"), LIMITS.max_avg_age_days,
         F.when(F.col("c8") > LIMITS.max_avg_age_days, "warn").otherwise("pass")),
        (9, "target_range", F.col("c9"), 1.0,
         F.when(F.coalesce(F.col("c9"), F.lit(1.0)) < 1, "fail").otherwise("pass")),
        (10, "score_drift", F.col("c10"), LIMITS.max_mean_score_drift,
         F.when(F.col("no_baseline"), "info")
         .when(F.col("c10") > LIMITS.max_mean_score_drift, "warn").otherwise("pass")),
    ]
    return F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(n).alias("check"),
                              v.cast("double").alias("value"), F.lit(float(lim)).alias("limit_value"),
                              s.alias("status")) for o, n, v, lim, s in rows])


def validation_report(df: DataFrame, as_of: str, history: DataFrame | None = None) -> DataFrame:
    """The nine checks in order with value, limit and status.

    status is fail / warn / pass / info; ``outcome`` marks checks after the
    first failure as not_run (the reference stops there).
    """
    missing = missing_columns(df)
    if missing:
        spark = df.sparkSession
        return spark.createDataFrame(
            [(1, "required_columns", float(len(missing)), 0.0, "fail", "fail")],
            "ord int, check string, value double, limit_value double, status string, outcome string")
    g = global_checks(df, as_of)
    dup = duplicate_stats(df)
    labels = label_distribution(df)
    dup_ratio = dup.select("duplicate_ratio").scalar()
    max_share = labels.select(F.max("share")).scalar()
    n_classes = labels.select(F.count("*").cast("double")).scalar()
    baseline = latest_baseline(history)
    wide = g.select(
        F.col("n_rows").cast("double").alias("c2"),
        F.col("max_null_ratio").alias("c3"),
        dup_ratio.alias("c4"),
        max_share.alias("c5"),
        n_classes.alias("c6"),
        F.col("mismatch_ratio").alias("c7"),
        F.col("avg_age_days").alias("c8"),
        F.col("target_in_range").cast("double").alias("c9"),
        F.abs(F.col("mean_score") - baseline).alias("c10"),
        baseline.isNull().alias("no_baseline"),
    )
    long = wide.select(F.inline(_checks()))
    first_fail = F.min(F.when(F.col("status") == "fail", F.col("ord"))).over(Window.partitionBy(F.lit(1)))
    # ten rows in one window partition: bounded by the number of checks
    return long.select("ord", "check", F.round("value", 6).alias("value"), "limit_value", "status",
                       F.when(F.col("ord") > F.coalesce(first_fail, F.lit(99)), "not_run")
                       .otherwise(F.col("status")).alias("outcome"))


def drift_entry(df: DataFrame, run_ts: str) -> DataFrame:
    """The row to append to the drift history for this run."""
    return df.agg(F.avg(F.when(~F.isnan("model_score"), F.col("model_score"))).alias("mean_score")).select(
        F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"), "mean_score")


def should_replace_baseline(report: DataFrame) -> Column:
    """The baseline is replaced only if no hard check failed (drift warnings do not block)."""
    return report.select(F.coalesce(F.max((F.col("status") == "fail").cast("int")), F.lit(0)) == 0).scalar()


def validation_runs(df: DataFrame, as_of: str, run: str = "run", table: str = "table", key: str = "text_hash",
                    label: str = "target_score") -> DataFrame:
    """E8 for many runs of many tables in one plan: every check of every (table, run), with the first
    failure per run (later checks: ``not_run``).

    A run's drift baseline is the mean score of the latest earlier run of its table that had no hard
    failure (A7's rule). All statistics are grouped by (table, run) with partial sums; the window over runs has
    one row per run. Runs are ordered as text."""
    by, cols = [table, run], [c for c in df.columns if c not in (table, run)]
    nulls = [F.avg(_missing(df, c).cast("double")) for c in cols]
    g = df.groupBy(*by).agg(
        F.count("*").cast("double").alias("c2"), (F.greatest(*nulls) if len(nulls) > 1 else nulls[0]).alias("c3"),
        F.avg(mismatch().cast("double")).alias("c7"), F.avg(S.age_days("event_timestamp", as_of)).alias("c8"),
        F.min(in_range(label).cast("double")).alias("c9"), F.avg(F.when(~F.isnan("model_score"), F.col("model_score"))).alias("mean_score"))
    dup = df.groupBy(*by, key).agg(F.count("*").alias("n")).groupBy(*by).agg(
        (F.try_divide((F.sum("n") - F.count("*")).cast("double"), F.sum("n").cast("double"))).alias("c4"))
    lab = df.filter(~S.is_missing(label)).groupBy(*by, label).agg(F.count("*").alias("n")).groupBy(*by).agg(
        (F.max("n").cast("double") / F.sum("n").cast("double")).alias("c5"), F.count("*").cast("double").alias("c6"))
    stats = g.join(dup, by).join(lab, by, "left").withColumn("c6", F.coalesce("c6", F.lit(0.0)))
    hard = F.exists(_checks(), lambda x: x["status"] == "fail")
    earlier = Window.partitionBy(table).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    sound = stats.withColumns({"c10": F.lit(None).cast("double"), "no_baseline": F.lit(True)}).withColumn("sound", F.when(~hard, F.col("mean_score")))
    wide = sound.withColumn("baseline", F.last("sound", ignorenulls=True).over(earlier)).withColumns(
        {"c10": F.abs(F.col("mean_score") - F.col("baseline")), "no_baseline": F.col("baseline").isNull()})
    long = wide.select(*by, F.array_min(F.transform(F.filter(_checks(), lambda x: x["status"] == "fail"), lambda x: x["ord"])).alias("first_fail"),
                       F.inline(_checks()))
    return long.select(*by, "ord", "check", F.round("value", 6).alias("value"), "limit_value", "status",
                       F.when(F.col("ord") > F.coalesce("first_fail", F.lit(99)), "not_run").otherwise(F.col("status")).alias("outcome"))


def run_verdicts(history: DataFrame, run: str = "run", table: str = "table") -> DataFrame:
    """One row per (table, run) of a stored history: its verdict and first failing check."""
    first = F.min_by(F.when(F.col("outcome") == "fail", F.col("check")), F.when(F.col("outcome") == "fail", F.col("ord")))
    return history.groupBy(table, run).agg(
        F.when(F.max((F.col("outcome") == "fail").cast("int")) == 1, "failed")
        .when(F.max((F.col("outcome") == "warn").cast("int")) == 1, "passed with warnings").otherwise("passed").alias("verdict"),
        first.alias("first_failure"), F.count_if(F.col("outcome") == "not_run").alias("checks_not_run"))
