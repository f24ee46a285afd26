"""I4: rolling monitors over event time (tumbling or sliding windows).

Late rows beyond the watermark are dropped by Spark's watermark rule; each
window is emitted once, when the watermark passes its end (append mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.operators.ingest import monitor


def monitor_stream(feedback: DataFrame, duration: str, slide: str | None = None,
                   watermark: str = "1 day", ts: str = "event_timestamp") -> DataFrame:
    # watermarks need TIMESTAMP; the session runs in UTC, so the cast from
    # TIMESTAMP_NTZ keeps the wall-clock value
    src = feedback.withColumn(ts, F.col(ts).cast("timestamp"))
    return monitor(src.withWatermark(ts, watermark), duration, slide, ts)


def start_monitor(feedback: DataFrame, sink_path: str, checkpoint_path: str, duration: str,
                  slide: str | None = None, watermark: str = "1 day", trigger: dict | None = None):
    out = monitor_stream(feedback, duration, slide, watermark)
    return (out.writeStream.outputMode("append").format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint_path).trigger(**(trigger or {"availableNow": True})).start())
