"""Splits: disjoint, complete, exact sizes, independent of partitioning."""

from pyspark.sql import functions as F

from scoreloop.operators import splits as SP
from scoreloop.operators.sizing import global_rank


def test_global_rank_equals_row_number(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 1013).repartition(7)
    r = {x["id"]: x["rank"] for x in global_rank(df, [F.col("k"), F.col("id")]).collect()}
    want = sorted(range(5000), key=lambda i: ((i * 7919) % 1013, i))
    assert [r[i] for i in want] == list(range(1, 5001))


def test_split_exact_sizes_and_disjoint(spark):
    df = spark.range(0, 1001).repartition(5)
    s = SP.split_exact(df, key="id")
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 700, "val": 150, "test": 151}
    assert s.select("id").distinct().count() == 1001


def test_split_same_with_one_and_many_partitions(spark):
    a = {r["id"]: r["split"] for r in SP.split_exact(spark.range(0, 300).coalesce(1), key="id").collect()}
    b = {r["id"]: r["split"] for r in SP.split_exact(spark.range(0, 300).repartition(8), key="id").collect()}
    assert a == b


def test_batch_plan_sizes(spark):
    s = SP.split_exact(spark.range(0, 1001), key="id")
    p = {r["split"]: r for r in SP.batch_plan(s).collect()}
    assert (p["train"]["n_batches"], p["train"]["last_batch_size"]) == (175, 4)
    assert (p["test"]["n_batches"], p["test"]["last_batch_size"]) == (38, 3)


def test_split_leak_same_file_is_total_overlap(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "text_hash string")
    r = SP.split_leak(df, df).first()
    assert (r["overlap_keys"], r["rows_leaked"], r["rows_clean"]) == (2, 3, 0)
