"""File sources and sinks.

All writes are Spark jobs (one file per task, committed atomically by the
output committer); nothing is gathered on the driver. Appends are made
idempotent by anti-joining against what the target already holds, so a
job retried after a lost executor or a crash does not write rows twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop import schemas


# ---------------------------------------------------------------- helpers

def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def has_files(spark: SparkSession, path: str) -> bool:
    """True if any data file lies under ``path`` (names with _ or . do not count)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    files = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hpath, True)
    while files.hasNext():
        if files.next().getPath().getName()[0] not in "_.":
            return True
    return False


def read_parquet_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    if schema is None and not has_files(spark, path):
        return None
    return r.parquet(path)  # a damaged store raises: taken as empty it would let every duplicate in


# ---------------------------------------------------------------- A2, A3: CSV

def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: header row, no index; quotes inside text doubled (RFC 4180), so
    texts with commas, quotes and newlines survive a round trip."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A2: read a CSV with an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


# ---------------------------------------------------------------- A4: metrics JSON

def save_metrics(df: DataFrame, path: str) -> None:
    """A4: write metrics rows as JSON lines (replaces the previous file set)."""
    df.write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str, schema: T.StructType = schemas.MODEL_METRICS) -> DataFrame | None:
    """A4: read metrics with a schema; a missing file gives None."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(schema).option("multiLine", False).json(path)


def metrics_document(df: DataFrame) -> DataFrame:
    """A4: the reference's file shape -- one JSON array of objects -- as one
    string row. For small metric tables (a few rows per evaluation)."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("json"))


def parse_metrics_document(doc: DataFrame, schema: T.StructType = schemas.BAND_METRICS) -> DataFrame:
    """A4: back from one JSON array string to rows."""
    return doc.select(F.inline(F.from_json("json", T.ArrayType(schema))))


# ---------------------------------------------------------------- A5: dataset registry

def register_dataset(df: DataFrame, cols: list[str], dataset: str, run_id: str, registry_path: str,
                     registered_at: str) -> DataFrame:
    """A5: append (dataset, run_id, fingerprint, rows, registered_at) to a
    registry partitioned by dataset. Registering the same run twice is a no-op."""
    from scoreloop.operators.audit import table_fingerprint

    spark = df.sparkSession
    fp = table_fingerprint(df, cols)
    row = fp.select(F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"),
                    F.col("fingerprint"), F.col("num_rows").alias("rows"),
                    F.lit(registered_at).cast("timestamp_ntz").alias("registered_at"))
    existing = read_parquet_or_none(spark, registry_path)
    if existing is not None:
        row = row.join(existing.select("dataset", "run_id"), ["dataset", "run_id"], "left_anti")
    row.write.mode("append").partitionBy("dataset").parquet(registry_path)
    return spark.read.parquet(registry_path)


# ---------------------------------------------------------------- A7: drift state

def append_drift(entry: DataFrame, history_path: str) -> None:
    """Append this run's mean to the history (a run time is written once)."""
    spark = entry.sparkSession
    existing = read_parquet_or_none(spark, history_path, schemas.DRIFT_STATE)
    if existing is not None:
        entry = entry.join(existing.select("run_ts"), "run_ts", "left_anti")
    entry.write.mode("append").parquet(history_path)


def drift_history(spark: SparkSession, history_path: str) -> DataFrame | None:
    return read_parquet_or_none(spark, history_path, schemas.DRIFT_STATE)


def append_runs(report: DataFrame, history_path: str, table: str = "table", run: str = "run") -> DataFrame:
    """Append check verdicts to the run history (partitioned by table; a run is written once), and read it."""
    spark = report.sparkSession
    existing = read_parquet_or_none(spark, history_path)
    if existing is not None:
        report = report.join(existing.select(table, run).distinct(), [table, run], "left_anti")
    report.write.mode("append").partitionBy(table).parquet(history_path)
    return spark.read.parquet(history_path)


# ---------------------------------------------------------------- A8: feedback store

def append_feedback(rows: DataFrame, store_path: str, key: str = "text_hash", batch_id: int | None = None) -> DataFrame:
    """Append accepted rows, partitioned by event date. Rows whose key is
    already stored are dropped first (unique key), which also makes a retried
    batch idempotent. With ``batch_id`` the rows are known to be new and carry it:
    only what a failed attempt of the same batch has written is dropped. Files per
    date are bounded (rebalanced; AQE splits a hot date). Returns the rows appended (lazily)."""
    from scoreloop.sources.keyindex import KeyIndex

    spark = rows.sparkSession
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if read_parquet_or_none(spark, store_path) is not None:
        # only the stored keys this batch carries matter: the index reads their folders, not the store
        rows = rows.join(KeyIndex(spark, store_path, key).seen(rows.select(key), own_batch=batch_id), key, "left_anti")
    out = rows.withColumn("event_date", F.to_date("event_timestamp")).hint("rebalance", "event_date")
    out.write.mode("append").partitionBy("event_date").parquet(store_path)
    return out


def read_feedback_store(spark: SparkSession, store_path: str) -> DataFrame:
    """A1 over the file store: partition pruning by event_date applies."""
    return spark.read.parquet(store_path)
