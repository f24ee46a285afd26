"""Training-run analytics and promotion.

Windows run over per-epoch aggregates (one row per run and epoch), never
over raw steps, so a long run does not put its whole step log in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.config import TRAINING

INF = float("inf")


def epoch_loss(log: DataFrame) -> DataFrame:
    """Mean loss per (run, phase, epoch) with step counts and sums."""
    return log.groupBy("run_id", "phase", "epoch").agg(
        F.avg("loss").alias("epoch_loss"),
        F.sum("loss").alias("loss_sum"),
        F.count("loss").cast("long").alias("steps"))


def running_loss(log: DataFrame) -> DataFrame:
    """the reference's "epoch average": the mean of all steps so far
    (its lists are never cleared), read at each epoch's last step.

    Computed as running sums of per-epoch sums and counts: exact, and the
    window holds one row per epoch.
    """
    e = epoch_loss(log)
    w = Window.partitionBy("run_id", "phase").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("run_id", "phase", "epoch",
                    (F.sum("loss_sum").over(w) / F.sum("steps").over(w)).alias("running_loss"))


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(INF))


def one_phase(epochs: DataFrame, phase: str | None) -> DataFrame:
    """The epochs of the monitored phase (``phase`` None or no phase column: all rows)."""
    return epochs.filter(F.col("phase") == phase) if phase is not None and "phase" in epochs.columns else epochs


def early_stop(epochs: DataFrame, metric: str = "epoch_loss", patience: int = TRAINING.patience,
               key: str = "run_id", phase: str | None = "val") -> DataFrame:
    """on the monitored ``phase``, stop when the monitored value has not improved (strictly lower)
    for ``patience`` epochs, or is not finite. Gaps and islands: an island
    starts at each improvement; its rank is the wait count."""
    w = Window.partitionBy(key).orderBy("epoch")
    prev_best = F.min("m").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = one_phase(epochs, phase).select(key, "epoch", F.col(metric).alias("m")).withColumn(
        "improved", F.coalesce(F.col("m") < prev_best, F.lit(True)) & _finite(F.col("m")))
    x = x.withColumn("island", F.sum(F.col("improved").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wi = Window.partitionBy(key, "island").orderBy("epoch")
    x = x.withColumn("wait", F.row_number().over(wi) - 1)
    x = x.withColumn("stops", (F.col("wait") >= patience) | ~_finite(F.col("m")))
    return x.groupBy(key).agg(
        F.min(F.when(F.col("stops"), F.col("epoch"))).alias("stop_epoch"),
        F.count("*").cast("long").alias("epochs_seen"))


def best_checkpoint(epochs: DataFrame, stops: DataFrame | None = None, metric: str = "epoch_loss",
                    key: str = "run_id", phase: str | None = "val") -> DataFrame:
    """lowest monitored value of ``phase``, first epoch on ties, among the epochs
    that ran (up to the stop epoch when early stopping is given); a missing value never wins."""
    e = one_phase(epochs, phase)
    if stops is not None:
        e = e.join(stops.select(key, "stop_epoch"), key, "left").filter(
            F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    e = e.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    return e.groupBy(key).agg(
        F.min_by("epoch", F.struct(F.col(metric), F.col("epoch"))).alias("best_epoch"),
        F.min(metric).alias("best_value"))


def promotion_decision(candidates: DataFrame, best: DataFrame, key: str = "family",
                       min_improvement: float = TRAINING.min_improvement) -> DataFrame:
    """K1: promote if candidate < best and (first deployment or relative
    improvement >= min_improvement).

    ``candidates``: (key, candidate_score); ``best``: (key, best_score) for
    families with a deployed model (null score = metric absent -> infinity).
    """
    b = best.select(key, F.col("best_score"), F.lit(True).alias("_deployed"))
    j = candidates.join(b, key, "left")
    first = F.col("_deployed").isNull()
    best_v = F.when(first, F.lit(INF)).otherwise(F.coalesce(F.col("best_score"), F.lit(INF)))
    c = F.col("candidate_score")
    improvement = F.when(best_v == INF, F.lit(1.0)).otherwise(F.try_divide(best_v - c, best_v))
    promote = F.coalesce((c < best_v) & ~F.isnan(c) & (first | (improvement >= min_improvement)), F.lit(False))
    no_improvement = ~F.isnan(c) & (c >= best_v)
    reason = (F.when(c.isNull(), "missing_metric").when(promote, "promoted")
              .when(no_improvement, "no_improvement").otherwise("insufficient_improvement"))
    return j.select(key, c.alias("candidate_score"), best_v.alias("best_before"),
                    improvement.alias("improvement"),
                    F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(promote).alias("promoted"),
                    reason.alias("reason"),
                    F.when(promote, c).otherwise(best_v).alias("best_after"))


def promotion_history(candidates: DataFrame, key: str = "family", order: str = "day",
                      score: str = "test_mae", min_improvement: float = TRAINING.min_improvement) -> DataFrame:
    """K2: fold K1 over each family's candidates in order; the champion
    changes only on promotion. Families fold in parallel. The list per
    family is one entry per evaluation period (an aggregate, bounded by the
    number of periods, not by raw rows); the fold runs JVM-side."""
    lst = candidates.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(score).alias("s")))).alias("cands"))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("promotions"),
                    F.lit(None).cast(candidates.schema[order].dataType).alias("last_promoted"))

    def step(acc, x):
        s = x["s"]
        first = acc["best"].isNull()
        imp = F.try_divide(acc["best"] - s, acc["best"])
        promote = F.coalesce(
            s.isNotNull() & ~F.isnan(s) &
            F.when(first, s < F.lit(INF)).otherwise((s < acc["best"]) & (imp >= min_improvement)),
            F.lit(False))
        return F.struct(F.when(promote, s).otherwise(acc["best"]).alias("best"),
                        (acc["promotions"] + promote.cast("int")).alias("promotions"),
                        F.when(promote, x["o"]).otherwise(acc["last_promoted"]).alias("last_promoted"))

    out = lst.select(key, F.aggregate("cands", init, step).alias("st"), F.size("cands").alias("n"))
    return out.select(key, F.col("n").cast("long").alias("candidates"), F.col("st.best").alias("final_best"),
                      F.col("st.promotions").cast("long").alias("promotions"),
                      F.col("st.last_promoted").alias("last_promoted"))


def run_records(log: DataFrame, patience: int = TRAINING.patience, phase: str | None = "val") -> DataFrame:
    """K3: long run record (run_id, kind, key, value) from the monitored phase of a loss log."""
    log = one_phase(log, phase)
    e = epoch_loss(log)
    stops = early_stop(e, patience=patience, phase=phase)
    per_run = (log.groupBy("run_id").agg(F.count("*").cast("double").alias("n_steps"),
                                         F.avg("loss").alias("mean_loss"))
               .join(e.groupBy("run_id").agg(F.count("*").cast("double").alias("n_epochs"),
                                            F.min("epoch_loss").alias("best_epoch_loss")), "run_id")
               .join(stops.select("run_id", F.col("stop_epoch").cast("double")), "run_id"))
    arr = F.array(
        F.struct(F.lit("param").alias("kind"), F.lit("patience").alias("key"), F.lit(float(patience)).alias("value")),
        *[F.struct(F.lit("metric").alias("kind"), F.lit(k).alias("key"), F.col(k).alias("value"))
          for k in ("n_steps", "mean_loss", "n_epochs", "best_epoch_loss", "stop_epoch")])
    return per_run.select("run_id", F.inline(arr))


def run_compare(records: DataFrame, keys: list[str]) -> DataFrame:
    """K3: one row per run, one column per key (values listed up front, so
    the pivot needs no extra pass to find them)."""
    return records.groupBy("run_id").pivot("key", keys).agg(F.first("value"))
