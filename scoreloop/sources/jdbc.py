"""A1 from the relational store: a partitioned JDBC scan of feedback_events.

The id range is split into ``num_partitions`` stripes read in parallel;
filters and column choices given to the DataFrame are pushed into each
stripe's SQL by Spark's JDBC source. Needs the database's JDBC driver on
the cluster's classpath; not exercised by the tests (no database here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def id_bounds(spark: SparkSession, url: str, table: str, props: dict) -> tuple[int, int]:
    b = (spark.read.format("jdbc").option("url", url)
         .option("query", f"SELECT min(id) AS lo, max(id) AS hi FROM {table}")
         .options(**props).load().first())
    return int(b["lo"] or 0), int(b["hi"] or 0)


def read_feedback_jdbc(spark: SparkSession, url: str, table: str = "feedback_events",
                       props: dict | None = None, num_partitions: int = 64,
                       fetch_size: int = 10_000) -> DataFrame:
    props = dict(props or {})
    lo, hi = id_bounds(spark, url, table, props)
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", "id").option("lowerBound", lo).option("upperBound", hi + 1)
            .option("numPartitions", num_partitions).option("fetchsize", fetch_size)
            .options(**props).load())
