"""K5 as a restartable chain: clean -> validate -> split -> train -> evaluate -> decide.

Every finished step leaves its output and a journal entry in ``state_dir``, under a key made of the input's
fingerprint and the settings. A rerun with the same key takes finished steps from the journal and goes on with
the first one that is missing (training itself goes on after its last whole epoch); another input is another run. The
entry is written after the output, so a step that was cut off is done again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.operators import gates as G
from scoreloop.operators import runs as RN
from scoreloop.operators import splits as SP
from scoreloop.operators import validate as V
from scoreloop.operators.audit import table_fingerprint
from scoreloop.plans import training as TR
from scoreloop.schemas import MODEL_METRICS
from scoreloop.sources.files import append_drift, drift_history, load_metrics, path_exists, read_parquet_or_none, save_metrics

JOURNAL = "ord int, step string, status string, n_rows long, value double, detail string, run string"
STEPS = ("clean", "validate", "split", "train", "evaluate", "decide")


class Chain:
    """One run of the chain over ``feedback``."""

    def __init__(self, spark: SparkSession, feedback: DataFrame, as_of: str, state_dir: str, rates: dict[str, float] | None = None,
                 epochs: int = 5, rounds: int = TR.ROUNDS, dim: int = TR.DIM, family: str = "score_model"):
        self.spark, self.feedback, self.as_of, self.state, self.family = spark, feedback, as_of, state_dir.rstrip("/"), family
        self.rates, self.epochs, self.rounds, self.dim = rates or {"score_model": 2.0}, epochs, rounds, dim
        stamp = table_fingerprint(feedback, ["id", "text_hash", "model_score", "user_feedback", "target_score", "event_timestamp"]).first()
        settings = repr((stamp["num_rows"], stamp["fingerprint"], as_of, sorted(self.rates.items()), epochs, rounds, dim, family))
        self.run = hashlib.sha256(settings.encode()).hexdigest()[:16]
        self.out = f"{self.state}/runs/{self.run}"

    def journal(self) -> DataFrame | None:
        """The finished steps of this run."""
        all_runs = read_parquet_or_none(self.spark, f"{self.state}/journal", JOURNAL)
        return None if all_runs is None else all_runs.filter(F.col("run") == self.run)

    def report(self) -> DataFrame:
        """(step, status, n_rows, value, detail) of all steps; what is missing runs now."""
        done = {} if (j := self.journal()) is None else {r["step"].split(".")[0]: r["status"] for r in j.select("step", "status").collect()}
        for k, step in enumerate(STEPS):
            if step not in done:
                rows = getattr(self, step)()
                entry = self.spark.createDataFrame([(k, *r, self.run) for r in rows], JOURNAL)
                entry.coalesce(1).write.mode("append").partitionBy("run").parquet(f"{self.state}/journal")
                done[step] = rows[0][1]
            if done[step] == "failed":
                break
        return self.journal().select("step", "status", "n_rows", "value", "detail")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def clean(self):
        G.clean_feedback(self.feedback).write.mode("overwrite").parquet(f"{self.out}/clean")
        n = self.read("clean").count()
        return [("clean", "ok", n, None, "rows after the gates")]

    def validate(self):
        clean = self.read("clean")
        report = V.validation_report(clean, self.as_of, drift_history(self.spark, f"{self.state}/drift"))
        report.write.mode("overwrite").parquet(f"{self.out}/validate")
        fails = self.read("validate").filter("status = 'fail'").orderBy("ord").select("check").collect()  # ten rows at most
        if not fails:
            append_drift(V.drift_entry(clean, self.as_of), f"{self.state}/drift")  # once a run time
        return [("validate", "failed" if fails else "ok", len(fails), None, f"first failure: {fails[0]['check']}" if fails else "all hard checks passed")]

    def split(self):
        SP.split_exact(self.read("clean").withColumn("label", F.col("target_score")), key="id").select("id", "text", "label", "split") \
            .write.mode("overwrite").parquet(f"{self.out}/split")
        sizes = {r["split"]: r["count"] for r in self.read("split").groupBy("split").count().collect()}
        return [(f"split.{s}", "ok", sizes.get(s, 0), None, None) for s in ("train", "val", "test")]

    def train(self):
        parts = f"{self.out}/parts"
        if not path_exists(self.spark, f"{parts}/_SUCCESS"):  # features of a write that was not cut off are kept
            TR.training_parts(self.read("split"), parts, "id", "label", "text", self.dim, self.rounds, split_col="split")
        log = TR.train_epochs(self.spark, parts, f"{self.out}/training", self.rates, self.epochs, self.rounds, self.dim)
        log.write.mode("overwrite").parquet(f"{self.out}/log")
        n = self.spark.read.schema(TR.PARTS).parquet(parts).filter(~F.col("part").isin("val", "test")).count()
        return [("train", "ok", n, None, f"{self.read('log').count()} epochs logged")]

    def evaluate(self):
        best = TR.test_of_best(self.spark, f"{self.out}/parts", f"{self.out}/training", self.read("log"), self.dim)
        best.write.mode("overwrite").parquet(f"{self.out}/evaluate")
        top = self.read("evaluate").orderBy(F.col("best_value").asc_nulls_last(), "run_id").first()  # one row a learning rate
        if top is None or top["test_mae"] is None:
            return [("evaluate", "failed", 0, None, "no test rows or no finite epoch")]
        return [("evaluate", "ok", top["n_test"], top["test_mae"], f"run {top['run_id']}, epoch {top['best_epoch']}, mean predictor {top['mean_mae']:.6f}")]

    def decide(self):
        mae, n = self.journal().filter("step = 'evaluate'").select("value", "n_rows").first()
        stored = load_metrics(self.spark, f"{self.state}/best_metrics.json")
        best = (self.spark.createDataFrame([], "family string, best_score double") if stored is None
                else stored.select(F.lit(self.family).alias("family"), F.col("test_mae").alias("best_score")).checkpoint(eager=True))
        d = RN.promotion_decision(self.spark.createDataFrame([(self.family, mae)], "family string, candidate_score double"), best).first()
        metrics = self.spark.createDataFrame([(mae, None, n, self.family, self.as_of)], MODEL_METRICS)
        save_metrics(metrics, f"{self.state}/candidate_metrics.json")
        if d["promoted"]:
            save_metrics(metrics, f"{self.state}/best_metrics.json")
        return [("decide", "promoted" if d["promoted"] else "rejected", None, d["improvement"], d["reason"])]


def retrain_chain(spark: SparkSession, feedback: DataFrame, as_of: str, state_dir: str, **settings) -> DataFrame:
    """The report of a run: finished steps from the journal, the others run now."""
    return Chain(spark, feedback, as_of, state_dir, **settings).report()
