"""I4 from panes: rolling monitors without reading events again.

A pane is one day. Its state is one row per score bin: counts and sums that add up, so panes merge by addition,
late events join as one more addition, and any window of whole days is a sum of panes. The bins are also the
quantile sketch: a score quantile of a window is known to within half a bin (``1 / BINS / 2`` for scores
in [0, 1]; scores outside keep bins of the same width).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.operators.validate import mismatch

BINS = 1000
SUMS = ("n", "score_sum", "mismatches", "ai")


def pane_states(events: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """(pane, bin, n, score_sum, mismatches, ai) of the events; bin is null for missing scores. Events without a time have no pane."""
    score = F.when(~F.isnan("model_score"), F.col("model_score"))
    return (events.filter(F.col(ts).isNotNull())
            .groupBy(F.to_date(ts).alias("pane"), F.floor(score * BINS).alias("bin"))
            .agg(F.count("*").alias("n"), F.sum(score).alias("score_sum"), F.count_if(mismatch()).alias("mismatches"),
                 F.count_if(F.col("user_feedback") == "ai").alias("ai"), F.count("user_feedback").alias("labelled")))


def merge_panes(*states: DataFrame) -> DataFrame:
    """One state per pane and bin from several (of different days, or of late events)."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy("pane", "bin").agg(*[F.sum(c).alias(c) for c in (*SUMS, "labelled")])


def window_report(states: DataFrame, days: int = 3, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Per window of ``days`` days, one starting every day: the columns of ``ingest.monitor`` and score quantiles.

    The rank of quantile q among n scores is ceil(q n); its value is the middle of the bin that holds it."""
    quantiles = {"score_p50": 0.5, "score_p95": 0.95} if quantiles is None else quantiles
    starts = F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_sub("pane", k))
    by_bin = (states.select(F.explode(starts).alias("start"), "bin", *SUMS, "labelled").groupBy("start", "bin")
              .agg(*[F.sum(c).alias(c) for c in (*SUMS, "labelled")]))
    scored = F.when(F.col("bin").isNotNull(), F.col("n"))
    upto = Window.partitionBy("start").orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("start")
    ranked = by_bin.withColumns({"upto": F.sum(scored).over(upto), "scored": F.sum(scored).over(whole)})
    middle = (F.col("bin") + 0.5) / BINS
    g = ranked.groupBy("start").agg(
        F.sum("n").alias("n"), F.round(F.sum("score_sum") / F.max("scored"), 6).alias("mean_score"),
        F.round(F.sum("mismatches") / F.sum("n"), 6).alias("mismatch_ratio"),
        F.round(F.try_divide(F.sum("ai"), F.sum("labelled")), 6).alias("ai_share"),
        *[F.round(F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("scored")), middle)), 6).alias(name) for name, q in quantiles.items()])
    start = F.col("start").cast("timestamp_ntz")
    return g.select(start.alias("window_start"), (start + F.make_dt_interval(F.lit(days))).alias("window_end"),
                    "n", "mean_score", "mismatch_ratio", "ai_share", *quantiles)
