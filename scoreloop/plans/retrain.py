"""K5: the retrain job as one chain of Spark plans.

clean (C8) -> validate (E8; stop at the first failure) -> split (G3)
-> train (K4) -> test metrics (E11) -> promotion decision (K1).
Returns a small report DataFrame, one row per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.operators import gates as G
from scoreloop.operators import runs as RN
from scoreloop.operators import splits as SP
from scoreloop.operators import validate as V
from scoreloop.plans.model import score_ml, train_score_model
from scoreloop.schemas import MODEL_METRICS
from scoreloop.sources.files import append_drift, drift_history, load_metrics, save_metrics


def retrain_report(spark: SparkSession, feedback: DataFrame, as_of: str, history: DataFrame | None = None,
                   best: DataFrame | None = None, family: str = "score_model", head: str = "sigmoid",
                   exact_split: bool = True, state_dir: str | None = None) -> DataFrame:
    """One retrain run. With ``state_dir`` it takes the drift history and the best
    metrics from the previous run there, and leaves its own: the clean set, the
    drift entry (only if no hard check failed), the candidate's metrics, and on
    promotion the best metrics. Decisions read unrounded values."""
    rows = []
    if state_dir is not None:
        if history is None:
            history = drift_history(spark, f"{state_dir}/drift")
        stored = load_metrics(spark, f"{state_dir}/best_metrics.json")
        if best is None and stored is not None:
            best = stored.select(F.lit(family).alias("family"), F.col("test_mae").alias("best_score")).checkpoint(eager=True)
    clean = G.clean_feedback(feedback).checkpoint(eager=True)   # reused by every step below
    n_clean = clean.count()
    rows.append(("clean", "ok", float(n_clean), f"{n_clean} rows after the gates"))
    report = V.validation_report(clean, as_of, history).checkpoint(eager=True)
    fails = report.filter(F.col("status") == "fail").orderBy("ord").select("check").limit(1).collect()
    if state_dir is not None:
        clean.write.mode("overwrite").parquet(f"{state_dir}/clean")
        if not fails:
            append_drift(V.drift_entry(clean, as_of), f"{state_dir}/drift")
    if fails:
        rows.append(("validate", "failed", None, f"first failure: {fails[0]['check']}"))
        return spark.createDataFrame(rows, "step string, status string, value double, detail string")
    rows.append(("validate", "ok", None, "all hard checks passed"))
    split = (SP.split_exact(clean, key="id") if exact_split else SP.split_bucket(clean, key="id"))
    split = split.withColumn("label", F.col("target_score"))
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    model = train_score_model(train, head=head)
    rows.append(("train", "ok", float(train.count()), f"{head} head"))
    error = F.col("label") - F.col("score")
    m = score_ml(model, test).agg(F.avg(F.abs(error)).alias("test_mae"), F.sqrt(F.avg(error * error)).alias("test_rmse"),
                                  F.count("*").alias("test_samples")).first()
    rows.append(("evaluate", "ok", m["test_mae"], f"test_mae={m['test_mae']:.6f} rmse={m['test_rmse']:.6f} n={m['test_samples']}"))
    cand = spark.createDataFrame([(family, float(m["test_mae"]))], "family string, candidate_score double")
    if best is None:
        best = spark.createDataFrame([], "family string, best_score double")
    d = RN.promotion_decision(cand, best).first()
    if state_dir is not None:
        metrics = spark.createDataFrame([(m["test_mae"], m["test_rmse"], m["test_samples"], family, as_of)], MODEL_METRICS)
        save_metrics(metrics, f"{state_dir}/candidate_metrics.json")
        if d["promoted"]:
            save_metrics(metrics, f"{state_dir}/best_metrics.json")
    rows.append(("decide", "promoted" if d["promoted"] else "rejected", d["improvement"], d["reason"]))
    return spark.createDataFrame(rows, "step string, status string, value double, detail string")
