"""Continuous feedback ingest.

readStream -> (optional) dropDuplicatesWithinWatermark on the text hash as
a bounded-state first pass -> foreachBatch running the batch ingest plan:
validation, language gate, first-per-hash inside the batch, anti-join
against the store, append accepted rows (partitioned by date) and rejected
rows (with reason, partitioned by batch id).

Exactly-once effect on retry: accepted rows carry their batch id. The
duplicate probe leaves out rows of the same batch, so a retry judges every
request as the first attempt did; the append leaves out what that attempt
already committed; rejects are written with dynamic partition overwrite of
their batch-id partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.functions import scalars as S
from scoreloop.operators import ingest as IN
from scoreloop.operators import lang as L
from scoreloop.operators.sizing import materialize
from scoreloop.sources.files import append_feedback, read_parquet_or_none
from scoreloop.sources.keyindex import KeyIndex


def make_batch_handler(store_path: str, rejects_path: str, profile: DataFrame, langs: list[str]):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = read_parquet_or_none(spark, store_path)
        if store is None:
            store = spark.createDataFrame([], "text_hash string")
        else:  # rows an earlier attempt of this batch stored are not duplicates
            store = KeyIndex(spark, store_path, skip_batch=batch_id)
        req = materialize(IN.numbered(IN.stamped(batch)).withColumn("text_hash", S.text_hash("text")))
        status = materialize(IN.ingest_batch(req, store, profile, langs, prepared=True))
        # accepted rows with their payload, by the number each got on arrival
        accepted = (req.join(status.filter(F.col("status") == "accepted").select("_row"), "_row", "left_semi")
                    .select("id", "text", "text_hash", "model_score", "user_feedback", "model_version",
                            "event_timestamp", S.target_from_feedback("user_feedback").alias("target_score")))
        append_feedback(accepted, store_path, batch_id=batch_id)
        rejects = (status.filter(F.col("status") != "accepted").drop("_row")
                   .withColumn("batch_id", F.lit(batch_id).cast("long")))
        (rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(rejects_path))
    return handle


def start_ingest(requests: DataFrame, store_path: str, rejects_path: str, checkpoint_path: str,
                 profile: DataFrame, langs: list[str], watermark: str | None = None,
                 trigger: dict | None = None):
    """Start the ingest stream; ``requests`` is a streaming DataFrame with
    the request columns (id, text, model_score, user_feedback, model_version,
    event_timestamp). With ``watermark``, repeats of a text within the
    watermark are dropped in state first (I2); the store anti-join remains
    the exact, unbounded-in-time check. Note: inside one micro-batch the
    state keeps whichever copy it meets first, not the earliest; without
    ``watermark`` the batch plan applies the exact first-arrival rule (F3)."""
    profile = L.prepare_profile(profile)      # once per stream, not per micro-batch
    src = requests
    if watermark:
        src = (src.withColumn("_h", S.text_hash("text"))
               .withColumn("_et", F.col("event_timestamp").cast("timestamp"))   # UTC session
               .withWatermark("_et", watermark)
               .dropDuplicatesWithinWatermark(["_h"]).drop("_h", "_et"))
    w = (src.writeStream.foreachBatch(make_batch_handler(store_path, rejects_path, profile, langs))
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
