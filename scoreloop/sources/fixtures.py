"""Input tables of the feedback loop, derived from the driver's tables.

Every derivation is deterministic (no random numbers) so Spark and an
independent SQL engine see the same rows. The recipes are in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.functions import scalars as S
from scoreloop.sources.tables import table


def _feedback_label(event_type) -> F.Column:
    # Event type -> feedback label.
    return (F.when(event_type == "signup", "human_edited_ai")
            .when(event_type.isin("error", "purchase"), "ai")
            .when(event_type.isin("click", "view"), "human"))


def feedback_events(spark: SparkSession, sf_dir: str, with_lang: bool = True, measures: dict | None = None) -> DataFrame:
    """``feedback_events``: about ten events per document text. The hash, and ``measures`` (name -> column of the
    text), are taken once per document, before the join.

    documents d JOIN events e ON d.doc_id = (e.event_id * 31) % N, with N the
    number of documents taken as a scalar subquery (no cross join). The
    join shuffles both sides on the document key.
    """
    docs = table(spark, sf_dir, "documents")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    n_docs = docs.select(F.count("*")).scalar()
    ev = ev.withColumn("doc_key", (F.col("event_id") * 31) % n_docs)
    measures = measures or {}
    d = docs.select(F.col("doc_id").alias("doc_key"), "text", "lang", S.text_hash("text").alias("text_hash"),
                    *[c.alias(k) for k, c in measures.items()])
    j = ev.join(d, "doc_key")
    fb = _feedback_label(F.col("event_type"))
    u = (F.col("event_id") * 7919) % 1001
    base = F.when(fb == "ai", 600).when(fb == "human_edited_ai", 300).otherwise(0)
    milli = F.when(F.col("event_id") % 4 == 0, u).otherwise(base + F.expr("div(((event_id * 7919) % 1001) * 2, 5)"))
    cols = [
        F.col("event_id").alias("id"),
        F.col("text"),
        F.col("text_hash"),
        (milli.cast("double") / F.lit(1000.0)).alias("model_score"),
        fb.alias("user_feedback"),
        F.concat(F.lit("m"), (F.col("event_id") % 4 + 1).cast("string")).alias("model_version"),
        F.col("ts").alias("event_timestamp"),
        S.target_from_feedback(fb).alias("target_score"),
    ]
    if with_lang:
        cols.append(F.col("lang"))
    return j.select(*cols, *measures)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming requests as a service meets them: the feedback events with some
    fields broken by id, and some requests delivered twice (same id)."""
    fe = feedback_events(spark, sf_dir).drop("text_hash", "target_score")
    broken = lambda k: F.col("id") % k == 0
    r = (fe.withColumn("text", F.when(broken(53), "abc").when(broken(61), "\u4e2d\u6587\u4e2d\u6587\u4e2d\u6587")
                       .when(broken(67), F.lit(None)).otherwise(F.col("text")))
         .withColumn("model_score", F.when(broken(43), 1.5).when(broken(79), F.lit(None)).otherwise(F.col("model_score")))
         .withColumn("user_feedback", F.when(broken(41), "some_unknown_feedback_label").when(broken(71), F.lit(None))
                     .otherwise(F.col("user_feedback")))
         .withColumn("model_version", F.when(broken(47), F.lit(None)).when(broken(73), F.repeat(F.lit("v"), 101))
                     .otherwise(F.col("model_version"))))
    copies = F.when(broken(59), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return r.withColumn("_copy", F.explode(copies)).drop("_copy")


def feedback_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(store, incoming): every fifth event below half the maximum id is stored
    (first row per hash, as a unique key would keep), so some texts are not;
    the requests from there on arrive."""
    from scoreloop.operators.gates import first_per_key

    fe = feedback_events(spark, sf_dir)
    half = fe.select((F.max("id") / 2).alias("h")).scalar()
    store = first_per_key(fe.filter((F.col("id") < half) & (F.col("id") % 5 == 0)))
    return store, requests(spark, sf_dir).filter(F.col("id") >= half)


def feedback_cover(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(store, incoming): the store of ``feedback_split``, and every request whose event is not one
    of those the store was taken from, so that both together cover all events."""
    from scoreloop.operators.gates import first_per_key

    fe = feedback_events(spark, sf_dir)
    half = fe.select((F.max("id") / 2).alias("h")).scalar()
    old = (F.col("id") < half) & (F.col("id") % 5 == 0)
    return first_per_key(fe.filter(old)), requests(spark, sf_dir).filter(~old)


def predictions(spark: SparkSession, sf_dir: str, measures: dict | None = None) -> DataFrame:
    """Predictions: y_true = target, y_pred = model score."""
    fe = feedback_events(spark, sf_dir, with_lang=False, measures=measures)
    return fe.select("id", "model_version", "text", "event_timestamp",
                     F.col("target_score").alias("y_true"),
                     F.col("model_score").alias("y_pred"), *(measures or {}))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; label = target of the latest feedback on its text."""
    from scoreloop.operators.gates import dedup_latest

    fe = feedback_events(spark, sf_dir, with_lang=False)
    latest = dedup_latest(fe.select("id", "text_hash", "event_timestamp", "target_score"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", S.text_hash("text").alias("text_hash"))
    return (docs.join(latest.select("text_hash", F.col("target_score").alias("label")),
                      "text_hash", "left")
            .select("doc_id", "source", "text", "label"))


def loss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss log of seven runs: one validation and one (lower) training step per event."""
    ev = table(spark, sf_dir, "events").select("event_id", "value")
    step = F.expr("div(event_id, 7)")
    return ev.select(
        F.concat(F.lit("r"), (F.col("event_id") % 7).cast("string")).alias("run_id"),
        F.explode(F.array(F.lit("val"), F.lit("train"))).alias("phase"),
        F.expr("div(div(event_id, 7), 50)").alias("epoch"),
        step.alias("step"),
        F.col("value"),
    ).select("run_id", "phase", "epoch", "step",
             F.when(F.col("phase") == "val", F.col("value")).otherwise(F.col("value") / 2 - F.col("epoch")).alias("loss"))


def dataset_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audited dataset runs: one per document source, with checksum and label figures."""
    from scoreloop.operators.audit import dataset_run_stats

    return dataset_run_stats(training_set(spark, sf_dir), by="source")


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model runs: one per nation, pointing at dataset run 'src<key>'.

    Keys 20-24 point at no dataset run; where key % 5 = 0 the declared
    checksum is wrong on purpose.
    """
    nat = table(spark, sf_dir, "nation").select("n_nationkey")
    ds = dataset_runs(spark, sf_dir).select("dataset_run_id", "dataset_checksum")
    runs = nat.select(
        F.concat(F.lit("run"), F.col("n_nationkey").cast("string")).alias("run_id"),
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("dataset_run_id"),
        (F.col("n_nationkey") % 5 == 0).alias("_wrong"))
    j = runs.join(ds, "dataset_run_id", "left")
    declared = F.when(F.col("_wrong") | F.col("dataset_checksum").isNull(),
                      F.md5(F.col("dataset_run_id"))).otherwise(F.col("dataset_checksum"))
    return j.select("run_id", "dataset_run_id", declared.alias("dataset_checksum"))


def daily_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion candidates: MAE per (model version, day), rounded to 6 places."""
    p = predictions(spark, sf_dir)
    return (p.groupBy(F.col("model_version").alias("family"),
                      F.to_date("event_timestamp").alias("day"))
            .agg(F.round(F.avg(S.abs_error()), 6).alias("test_mae")))
