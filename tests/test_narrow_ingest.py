"""Requests are judged without their texts; a text travels for the new rows only."""

import datetime as dt

from pyspark.sql import functions as F

from scoreloop.functions import scalars as S
from scoreloop.operators import ingest as IN
from scoreloop.operators.sizing import materialize
from scoreloop.sources import fixtures as FX

SCHEMA = "id long, text string, event_timestamp timestamp_ntz"
AT = dt.datetime(2024, 1, 1)


def arrived(spark):
    rows = [(1, "a", AT), (1, "a", AT), (2, "a", AT - dt.timedelta(days=1)), (3, "b", None), (None, "b", AT), (4, "stored", AT), (5, None, AT), (6, None, None)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("text_hash", S.text_hash("text"))


def test_new_rows_get_their_text_back(spark):
    req = arrived(spark)
    store = spark.createDataFrame([("stored",), (None,)], "text string").select(S.text_hash("text").alias("text_hash"))
    narrow = materialize(IN.numbered(req.drop("text")))
    new, dups = IN.split_new_and_duplicates(narrow, store)
    got = IN.with_texts(materialize(new), req).collect()
    assert sorted(((r.id, r.text) for r in got), key=str) == sorted([(2, "a"), (None, "b"), (5, None)], key=str)
    assert sorted((r.id for r in dups.collect()), key=str) == [1, 1, 3, 4, 6]
    assert IN.with_texts(materialize(new.limit(0)), req).count() == 0


def test_ids_filter_the_events_before_their_texts_join(spark):
    req = FX.requests(spark, "/root/testdata/sf0.001").withColumn("text_hash", S.text_hash("text"))
    new = materialize(req.filter("id % 100 = 7").select("id", "text_hash").distinct())
    plan = IN.with_texts(new, req)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("Join Inner")


def test_not_every_row_travels_to_its_key(spark):
    """First arrivals come out of one aggregate with its partial step; no join brings all rows to their keys."""
    req = arrived(spark)
    store = spark.createDataFrame([], "text_hash string")
    new, _ = IN.split_new_and_duplicates(materialize(IN.numbered(req.drop("text"))), store)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "LeftAnti" in plan and "min_by" in plan


def test_accepted_rows_are_those_the_batch_accepts(spark):
    from scoreloop.operators import lang as L

    words = {"en": "the house is on the hill and the river runs below it ", "de": "das haus steht auf dem berg und der fluss rinnt darunter "}
    docs = spark.createDataFrame([(k, t) for k, t in words.items()], "lang string, text string")
    prof, langs = L.stored(docs)
    rows = [(i, words["en" if i % 3 else "de"] * (1 + i % 4), 0.5, "human" if i % 5 else "odd", "m1", AT + dt.timedelta(hours=-i)) for i in range(40)]
    inc = spark.createDataFrame(rows, "id long, text string, model_score double, user_feedback string, model_version string, event_timestamp timestamp_ntz")
    store = spark.createDataFrame([(words["en"] * 2,)], "text string").select(S.text_hash("text").alias("text_hash"))
    want = IN.ingest_batch(inc, store, prof, langs, prepared=True).filter("status = 'accepted'")
    got = IN.accepted_rows(inc, store, prof, langs, prepared=True)
    assert sorted((r.id, r.text_hash, r.target_score) for r in got.collect()) == sorted((r.id, r.text_hash, r.target_score) for r in want.collect())
    assert got.filter(F.sha2("text", 256) != F.col("text_hash")).isEmpty() and got.count() > 1
