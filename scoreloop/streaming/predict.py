"""Continuous scoring. Each micro-batch runs the batch scoring plan
(language gate, linear score, band) against the static profile and token
weights, and is appended to the sink keyed by batch id (idempotent retry)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.operators.ingest import predict_batch


def start_predict(texts: DataFrame, sink_path: str, checkpoint_path: str, profile: DataFrame,
                  langs: list[str], weights: DataFrame, key: str = "id", trigger: dict | None = None):
    from scoreloop.operators.lang import prepare_profile
    from scoreloop.operators.vocab import prepare_weights

    profile = prepare_profile(profile)        # once per stream
    weights = prepare_weights(weights)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = predict_batch(batch, profile, langs, weights, key=key, prepared=True).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_path))
    return (texts.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_path)
            .trigger(**(trigger or {"availableNow": True})).start())
