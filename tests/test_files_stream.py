"""Sinks (CSV, JSON, registry, drift, store) and stream = batch."""

import os

from pyspark.sql import functions as F

from conftest import feedback
from scoreloop import schemas
from scoreloop.sources import files as FL


def test_csv_round_trip_quotes_commas_newlines(spark, tmp_dir):
    df = feedback(spark, [(1, 'He said "hi", then\nleft', 0.5, "human_edited_ai", "2024-01-01"),
                          (2, "plain", 0.1, "human", None)]).drop("lang")
    p = os.path.join(tmp_dir, "csv")
    FL.write_csv(df, p)
    back = FL.read_csv(spark, p, schemas.FEEDBACK_EVENTS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_metrics_json_missing_is_none_and_round_trip(spark, tmp_dir):
    assert FL.load_metrics(spark, os.path.join(tmp_dir, "nope")) is None
    m = spark.createDataFrame([(0.1, 0.02, 50, "e", "1")], schemas.MODEL_METRICS)
    FL.save_metrics(m, os.path.join(tmp_dir, "m"))
    assert FL.load_metrics(spark, os.path.join(tmp_dir, "m")).first()["test_mae"] == 0.1
    bands = spark.createDataFrame([("0.00-0.35", 0.0, 0.0, 50, 79)], schemas.BAND_METRICS)
    doc = FL.metrics_document(bands)
    assert FL.parse_metrics_document(doc).first()["false_negatives"] == 79


def test_registry_and_drift_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "text string, label double")
    reg = os.path.join(tmp_dir, "reg")
    FL.register_dataset(df, ["text", "label"], "train", "run1", reg, "2024-01-01 00:00:00")
    out = FL.register_dataset(df, ["text", "label"], "train", "run1", reg, "2024-01-01 00:00:00")
    assert out.count() == 1
    hist = os.path.join(tmp_dir, "hist")
    mk = lambda ts, m: spark.createDataFrame([(ts, m)], "run_ts string, mean_score double").select(
        F.col("run_ts").cast("timestamp_ntz"), "mean_score")
    FL.append_drift(mk("2024-01-01 00:00:00", 0.4), hist)
    FL.append_drift(mk("2024-01-02 00:00:00", 0.5), hist)
    FL.append_drift(mk("2024-01-02 00:00:00", 0.5), hist)
    from scoreloop.operators.validate import latest_baseline
    h = FL.drift_history(spark, hist)
    assert h.count() == 2 and spark.range(1).select(latest_baseline(h)).first()[0] == 0.5


def test_append_twice_equals_once(spark, tmp_dir):
    rows = feedback(spark, [(1, "one text", 0.1, "human", "2024-01-01"),
                            (2, "two text", 0.9, "ai", "2024-01-02")]).drop("lang")
    store = os.path.join(tmp_dir, "store")
    FL.append_feedback(rows, store)
    FL.append_feedback(rows, store)
    assert FL.read_feedback_store(spark, store).count() == 2


def test_stream_ingest_equals_batch(spark, tmp_dir):
    from scoreloop.operators import ingest as IN
    from scoreloop.operators import lang as L
    from scoreloop.sources.fixtures import feedback_split
    from scoreloop.streaming.ingest import start_ingest

    sf = "/root/testdata/sf0.001"
    store, inc = feedback_split(spark, sf)
    prof, langs = L.train_profile(spark.read.parquet(f"{sf}/documents.parquet"))
    prof = L.prepare_profile(prof)
    batch = IN.ingest_batch(inc, store, prof, langs)
    want = {r["status"]: r["count"] for r in batch.groupBy("status").count().collect()}

    src = os.path.join(tmp_dir, "requests")
    inc.write.parquet(src)
    store_path = os.path.join(tmp_dir, "store")
    FL.append_feedback(store.drop("lang"), store_path)
    q = start_ingest(spark.readStream.schema(inc.schema).parquet(src), store_path,
                     os.path.join(tmp_dir, "rejects"), os.path.join(tmp_dir, "ckpt"), prof, langs)
    q.awaitTermination()
    rejects = spark.read.parquet(os.path.join(tmp_dir, "rejects"))
    got = {r["status"]: r["count"] for r in rejects.groupBy("status").count().collect()}
    got["accepted"] = FL.read_feedback_store(spark, store_path).count() - store.count()
    assert got == {**{"accepted": 0}, **want}


def test_stream_monitor_equals_batch(spark, tmp_dir):
    from scoreloop.operators.ingest import monitor
    from scoreloop.sources.fixtures import feedback_events
    from scoreloop.streaming.monitor import start_monitor

    fe = feedback_events(spark, "/root/testdata/sf0.001").drop("text")
    src = os.path.join(tmp_dir, "fe")
    fe.write.parquet(src)
    sink = os.path.join(tmp_dir, "mon")
    q = start_monitor(spark.readStream.schema(fe.schema).parquet(src), sink, os.path.join(tmp_dir, "ck"),
                      "1 day", watermark="0 seconds")
    q.awaitTermination()
    # availableNow closes every window whose end the watermark passed; the last day stays open
    got = {r["window_start"]: r["n"] for r in spark.read.parquet(sink).collect()}
    want = {r["window_start"]: r["n"] for r in monitor(fe, "1 day").collect()}
    assert got and all(want[k] == v for k, v in got.items())
    assert len(want) - len(got) <= 1


def test_stream_watermark_dedup_then_store_check(spark, tmp_dir):
    """Repeats of a text inside the watermark are dropped in state; the
    store anti-join still catches the rest."""
    import datetime as dt

    from scoreloop.operators import lang as L
    from scoreloop.streaming.ingest import start_ingest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prof, langs = L.train_profile(docs)
    en = [r["text"] for r in docs.filter("lang = 'en' AND length(text) BETWEEN 50 AND 400").limit(2).collect()]
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, en[0], 0.5, "ai", "v", t0), (2, en[0], 0.5, "ai", "v", t0 + dt.timedelta(minutes=5)),
            (3, en[1], 0.5, "human", "v", t0 + dt.timedelta(minutes=6))]
    schema = "id long, text string, model_score double, user_feedback string, model_version string, event_timestamp timestamp_ntz"
    src = os.path.join(tmp_dir, "req")
    spark.createDataFrame(rows, schema).write.parquet(src)
    store = os.path.join(tmp_dir, "store")
    q = start_ingest(spark.readStream.schema(schema).parquet(src), store, os.path.join(tmp_dir, "rej"),
                     os.path.join(tmp_dir, "ck"), prof, langs, watermark="1 hour")
    q.awaitTermination()
    got = sorted(r["id"] for r in FL.read_feedback_store(spark, store).collect())
    # one copy of the repeated text survives (which one, inside a single
    # micro-batch, is up to the state store), plus the other text
    assert len(got) == 2 and got[1] == 3 and got[0] in (1, 2)


def test_stream_predict_equals_batch(spark, tmp_dir):
    """Micro-batch scoring gives the batch result."""
    from scoreloop.operators import lang as L
    from scoreloop.operators import vocab as VO
    from scoreloop.operators.ingest import predict_batch
    from scoreloop.streaming.predict import start_predict

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    lab = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    prof, langs = L.train_profile(spark.read.parquet(f"{sf}/documents.parquet"))
    w = VO.token_weights(lab)
    want = {r["id"]: (r["reason"], r["score"]) for r in predict_batch(docs, prof, langs, w).collect()}
    src = os.path.join(tmp_dir, "texts")
    docs.write.parquet(src)
    sink = os.path.join(tmp_dir, "scores")
    q = start_predict(spark.readStream.schema(docs.schema).parquet(src), sink, os.path.join(tmp_dir, "ck"),
                      prof, langs, w)
    q.awaitTermination()
    got = {r["id"]: (r["reason"], r["score"]) for r in spark.read.parquet(sink).collect()}
    assert got == want
