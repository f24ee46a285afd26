"""Ingest: one reason per request, in the service's order; duplicates."""

from pyspark.sql import functions as F

from scoreloop.operators import ingest as IN

REQ = "id long, text string, model_score double, user_feedback string, model_version string, event_timestamp timestamp_ntz"


def reqs(spark, rows):
    import datetime as dt
    return spark.createDataFrame([r + (dt.datetime(2024, 1, 1, 0, 0, r[0]),) for r in rows], REQ)


def test_bad_requests_one_reason_each(spark):
    df = reqs(spark, [(1, "abcd", 0.5, "ai", "v"), (2, "long enough", 1.1, "ai", "v"),
                      (3, "long enough", 0.5, "robot", "v"), (4, "long enough", 0.5, "ai", None),
                      (5, "abcd", 1.1, "robot", None), (6, "long enough", 0.5, "human", "v")])
    got = {r["id"]: r["reject_reason"] for r in IN.validate_requests(df).collect()}
    assert got == {1: "text_too_short", 2: "score_out_of_range", 3: "invalid_feedback",
                   4: "missing_model_version", 5: "text_too_short", 6: None}


def test_first_write_wins_and_store_duplicates(spark):
    df = reqs(spark, [(1, "new text a", 0.5, "ai", "v"), (2, "new text a", 0.5, "ai", "v"),
                      (3, "stored text", 0.5, "ai", "v")]).withColumn("text_hash", F.sha2("text", 256))
    store = spark.createDataFrame([("stored text",)], "text string").select(F.sha2("text", 256).alias("text_hash"))
    new, dups = IN.split_new_and_duplicates(df, store)
    assert sorted(r["id"] for r in new.collect()) == [1]
    assert sorted(r["id"] for r in dups.collect()) == [2, 3]


def test_constraint_report_counts_duplicate_rows(spark):
    df = spark.createDataFrame([("t", "h1", 0.1, "ai", "v"), ("t", "h1", 0.2, "ai", "v"), ("u", "h2", 0.1, "robot", "v")],
                               "text string, text_hash string, model_score double, user_feedback string, model_version string")
    got = {r["rule"]: r["violations"] for r in IN.constraint_report(df).collect()}
    assert got["text_hash_unique"] == 2 and got["user_feedback_allowed"] == 1 and got["text_not_null"] == 0
