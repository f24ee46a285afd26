"""Scan the driver's parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables as Spark scans it; split sizes are a session
    setting (``spark.sql.files.maxPartitionBytes``)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
