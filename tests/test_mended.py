"""Cases that once gave wrong answers: each test fails on the former code."""

import datetime as dt
import os

from pyspark.sql import functions as F

from scoreloop.operators import audit as AU
from scoreloop.operators import evaluate as EV
from scoreloop.operators import gates as G
from scoreloop.operators import ingest as IN
from scoreloop.operators import lang as L
from scoreloop.operators import runs as RN
from scoreloop.operators import splits as SP
from scoreloop.operators import validate as V
from scoreloop.operators import vocab as VO
from scoreloop.sources import files as FL
from scoreloop.streaming.ingest import make_batch_handler
from tests.conftest import feedback

REQ = "id long, text string, model_score double, user_feedback string, model_version string, event_timestamp timestamp_ntz"


def requests(spark, rows):
    return spark.createDataFrame([r + (dt.datetime(2024, 1, 1, 0, 0, r[0]),) for r in rows], REQ)


def english(spark):
    docs = spark.createDataFrame([("the cat and the dog went home", "en"), ("der hund und die katze", "de")], "text string, lang string")
    prof, langs = L.train_profile(docs)
    return L.prepare_profile(prof), langs


def test_retried_batch_rejects_nothing_it_accepted(spark, tmp_dir):
    store, rejects = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "rejects")
    handle = make_batch_handler(store, rejects, *english(spark))
    batch = requests(spark, [(1, "the cat and the dog", 0.5, "ai", "v"), (2, "the dog went home", 0.2, "human", "v"), (3, "the cat", 9.0, "ai", "v")])
    handle(batch, 0)
    handle(batch, 0)  # a crash after the append: the same batch again
    assert sorted(r.id for r in FL.read_feedback_store(spark, store).collect()) == [1, 2]
    assert [(r.id, r.status) for r in spark.read.parquet(rejects).collect()] == [(3, "score_out_of_range")]
    handle(batch, 1)  # a later batch with the same texts
    assert FL.read_feedback_store(spark, store).count() == 2
    assert sorted((r.id, r.status) for r in spark.read.parquet(rejects).filter("batch_id = 1").collect()) == [
        (1, "duplicate"), (2, "duplicate"), (3, "score_out_of_range")]


def test_requests_without_id_and_time_are_stamped(spark, tmp_dir):
    store = os.path.join(tmp_dir, "store")
    batch = requests(spark, [(1, "the cat and the dog", 0.5, "ai", "v")]).drop("id", "event_timestamp")
    make_batch_handler(store, os.path.join(tmp_dir, "rejects"), *english(spark))(batch, 0)
    r = FL.read_feedback_store(spark, store).first()
    assert r.id is not None and r.event_timestamp is not None


def test_redelivered_request_is_stored_once(spark, tmp_dir):
    df = requests(spark, [(1, "the cat and the dog", 0.5, "ai", "v")] * 2)
    assert sorted(r.is_duplicate for r in G.duplicate_flag(df.withColumn("text_hash", F.md5("text"))).collect()) == [False, True]
    new, dups = IN.split_new_and_duplicates(df.withColumn("text_hash", F.md5("text")), spark.createDataFrame([], "text_hash string"))
    assert (new.count(), dups.count()) == (1, 1)
    store, rejects = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "rejects")
    bad_twin = requests(spark, [(1, "the dog went home", 9.0, "ai", "v")])  # a rejected request with an accepted row's id
    make_batch_handler(store, rejects, *english(spark))(df.union(bad_twin), 0)
    assert [r.text for r in FL.read_feedback_store(spark, store).collect()] == ["the cat and the dog"]
    assert sorted(r.status for r in spark.read.parquet(rejects).collect()) == ["duplicate", "score_out_of_range"]


def test_damaged_store_is_not_an_empty_store(spark, tmp_dir):
    import pytest

    path = os.path.join(tmp_dir, "store")
    os.makedirs(path)
    assert FL.read_parquet_or_none(spark, path) is None
    with open(os.path.join(path, "part-0.parquet"), "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):
        FL.read_parquet_or_none(spark, path).count()


def test_null_hashes_are_one_group_of_different_texts(spark):
    df = feedback(spark, [(1, "a fine short text", 0.1, "human", "2024-01-01"), (2, "x" * 2000, 0.1, "human", "2024-01-02")])
    df = df.withColumn("text_hash", F.lit(None).cast("string"))
    assert G.clean_feedback(df).count() == 0 == G.funnel_report(df).first().after_target


def test_label_share_is_compared_unrounded(spark):
    df = spark.range(8_000_000).select((F.col("id") < 6_800_002).cast("double").alias("target_score"))
    assert V.label_distribution(df).select(F.max("share")).first()[0] > 0.85


def test_density_covers_the_whole_grid(spark):
    rows = [(0.0, i * 1e-4) for i in range(50)] + [(0.0, 500 + i * 1e-4) for i in range(2)]
    df = spark.createDataFrame(rows, "y_true double, y_pred double")
    got = EV.residual_density(df).collect()
    assert len(got) == 200 and all(r.density >= 0 for r in got)


def test_missing_metric_never_wins_and_phases_stay_apart(spark):
    log = [("r", "val", e, m) for e, m in ((0, 5.0), (1, 3.0), (2, None))] + [("r", "train", e, 0.1) for e in range(3)]
    epochs = spark.createDataFrame(log, "run_id string, phase string, epoch int, epoch_loss double")
    b = RN.best_checkpoint(epochs).first()
    assert (b.best_epoch, b.best_value) == (1, 3.0)
    assert RN.early_stop(epochs).first().epochs_seen == 3
    steps = spark.createDataFrame([("r", p, e, s, x) for p, x in (("val", 3.0), ("train", 0.8)) for e in range(2) for s in range(2)],
                                  "run_id string, phase string, epoch int, step int, loss double")
    rec = {r.key: r.value for r in RN.run_records(steps).collect()}
    assert rec["n_epochs"] == 2 and rec["best_epoch_loss"] == 3.0 and rec["mean_loss"] == 3.0 and rec["n_steps"] == 4


def test_fingerprint_tells_rows_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("\\N", "c"), (None, "c"), ("", "c"), ("1:", "c")]
    got = [AU.table_fingerprint(spark.createDataFrame([r], "x string, y string"), ["x", "y"]).first().fingerprint for r in rows]
    assert len(set(got)) == len(rows)


def test_language_codes_of_any_form(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en.US"), ("der hund und die katze", "de`x")], "text string, lang string")
    prof, langs = L.train_profile(docs)
    got = L.detect(docs.withColumn("id", F.monotonically_increasing_id()), prof, langs).collect()
    assert {r.detected_lang for r in got} == {"en.US"} or {r.detected_lang for r in got} == {"en.US", "de`x"}


def test_vocabulary_is_whole_by_default(spark):
    df = spark.range(60_000).select(F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    v = VO.vocab_build(df)
    assert v.count() == 60_000 and v.agg(F.max("token_id") - F.min("token_id")).first()[0] == 59_999
    assert VO.vocab_build(df, size=10).count() == 10


def test_two_way_split_rounds_train_down(spark):
    s = SP.split_exact(spark.range(17).select("id"), train_ratio=0.85, two_way=True)
    assert {r["split"]: r["count"] for r in s.groupBy("split").count().collect()} == {"train": 14, "test": 3}


def test_second_retrain_reads_the_first(spark, tmp_dir):
    from scoreloop.plans.retrain import retrain_report
    from scoreloop.sources.fixtures import feedback_events

    fe = feedback_events(spark, "/root/testdata/sf0.01")
    first = {r.step: r for r in retrain_report(spark, fe, "2024-02-01 00:00:00", state_dir=tmp_dir).collect()}
    assert first["validate"].status == "ok" and first["decide"].status == "promoted" and 0 < first["evaluate"].value < 1
    again = {r.step: r for r in retrain_report(spark, fe, "2024-02-02 00:00:00", state_dir=tmp_dir).collect()}
    assert again["decide"].status == "rejected" and "no_improvement" in again["decide"].detail
    assert FL.drift_history(spark, os.path.join(tmp_dir, "drift")).count() == 2
    assert FL.load_metrics(spark, os.path.join(tmp_dir, "best_metrics.json")).first().test_mae == first["evaluate"].value
