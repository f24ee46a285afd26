"""One key holding a third of all rows: per-key operators stay exact."""

from pyspark.sql import functions as F

from scoreloop.operators import gates as G
from scoreloop.operators import ingest as IN


def hot_table(spark, n=3000):
    # every third row shares one hot hash; timestamps rise with the id
    df = spark.range(0, n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("text_hash"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("ai").alias("user_feedback"))
    return df.repartition(6)


def test_dedup_hot_key_keeps_latest(spark):
    d = G.dedup_latest(hot_table(spark))
    assert d.count() == 1 + 2000
    assert d.filter("text_hash = 'hot'").first()["id"] == 2997   # largest multiple of 3


def test_duplicate_flag_hot_key(spark):
    f = G.duplicate_flag(hot_table(spark))
    got = {r["text_hash"]: r["n"] for r in f.filter("is_duplicate").groupBy("text_hash").agg(F.count("*").alias("n")).collect()}
    assert got == {"hot": 999}
    assert f.filter("text_hash = 'hot' AND NOT is_duplicate").first()["id"] == 0


def test_ingest_flag_hot_key(spark):
    inc = hot_table(spark)
    store = spark.createDataFrame([("k1",)], "text_hash string")
    f = IN.flag_duplicates(inc, store)
    new = f.filter("NOT is_duplicate")
    assert new.count() == 1 + 1999          # hot once; k1 is stored
    assert new.filter("text_hash = 'hot'").first()["id"] == 0
