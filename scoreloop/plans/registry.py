"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (or tables Spark derives from them)
and runs over all rows. Column names equal those of the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.operators import gates as G
from scoreloop.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FEEDBACK_COLS = ["id", "text", "text_hash", "model_score", "user_feedback", "model_version",
                 "event_timestamp", "target_score", "lang"]


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("clean_feedback")
def q_clean_feedback(spark, sf_dir):
    return G.clean_feedback(FX.feedback_events(spark, sf_dir)).select(*FEEDBACK_COLS)


# ---------------------------------------------------------------- common inputs

AS_OF = "2024-02-01 00:00:00"          # fixed "now" for age checks
PREVIOUS_RUN_CUT = "2024-01-16 00:00:00"  # the previous validation run saw rows before this


def _fe(spark, sf_dir):
    return FX.feedback_events(spark, sf_dir)


def _stale_targets(spark, sf_dir, with_lang=False):
    """Feedback rows as a store may hold them: m1 rows lost their target,
    m2 rows carry an old value."""
    fe = FX.feedback_events(spark, sf_dir, with_lang=with_lang)
    t = (F.when(F.col("model_version") == "m1", F.lit(None).cast("double"))
         .when(F.col("model_version") == "m2", F.lit(0.25))
         .otherwise(F.col("target_score")))
    return fe.withColumn("target_score", t)


# ---------------------------------------------------------------- A, B: scans and scalars

from scoreloop.functions import scalars as S  # noqa: E402
from scoreloop.functions import tokens as TK  # noqa: E402
from scoreloop.sources.tables import table  # noqa: E402


@query("scan_feedback")
def q_scan_feedback(spark, sf_dir):
    return _fe(spark, sf_dir).select(*FEEDBACK_COLS)


@query("text_hash")
def q_text_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.text_hash("text").alias("text_hash"))


@query("target_score")
def q_target_score(spark, sf_dir):
    return _fe(spark, sf_dir).select("id", "user_feedback",
                                     S.target_from_feedback("user_feedback").alias("target_score"))


@query("target_backfill")
def q_target_backfill(spark, sf_dir):
    return G.target_backfill(_stale_targets(spark, sf_dir)).select("id", "target_score")


@query("target_remap")
def q_target_remap(spark, sf_dir):
    return G.target_remap(_stale_targets(spark, sf_dir)).select("id", "target_score")


@query("score_band")
def q_score_band(spark, sf_dir):
    p = FX.predictions(spark, sf_dir)
    return p.select("id", "y_pred", S.score_band("y_pred").alias("band"))


@query("score_band_reversed")
def q_score_band_reversed(spark, sf_dir):
    p = FX.predictions(spark, sf_dir)
    return p.select("id", "y_pred", S.score_band("y_pred", reversed_polarity=True).alias("band"))


@query("band_to_feedback")
def q_band_to_feedback(spark, sf_dir):
    p = FX.predictions(spark, sf_dir).select("id", "y_pred", S.score_band("y_pred").alias("band"))
    return p.select("id", "band", S.band_to_feedback("band").alias("feedback"),
                    S.score_display("y_pred").alias("score_shown"))


@query("residuals")
def q_residuals(spark, sf_dir):
    p = FX.predictions(spark, sf_dir)
    return p.select("id", F.round(S.residual(), 9).alias("residual"),
                    F.round(S.abs_error(), 9).alias("abs_error"))


@query("token_length")
def q_token_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", TK.token_length("text").alias("token_length"))


@query("truncated_length")
def q_truncated_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id",
                                                    TK.truncated_length("text").alias("truncated_length"))


# ---------------------------------------------------------------- C, F: gates and windows

@query("gate_language")
def q_gate_language(spark, sf_dir):
    return G.gate_language(_fe(spark, sf_dir)).select("id", "text_hash")


@query("gate_length")
def q_gate_length(spark, sf_dir):
    return G.gate_length(_fe(spark, sf_dir)).select("id", "text_hash")


@query("gate_consistency")
def q_gate_consistency(spark, sf_dir):
    return G.gate_consistency(_fe(spark, sf_dir)).select("id", "text_hash")


@query("gate_target")
def q_gate_target(spark, sf_dir):
    return G.gate_target(_stale_targets(spark, sf_dir)).select("id", "text_hash")


@query("clean_feedback_remap")
def q_clean_feedback_remap(spark, sf_dir):
    return G.clean_feedback(_stale_targets(spark, sf_dir, with_lang=True), variant="remap").select(*FEEDBACK_COLS)


@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    return G.dedup_latest(_fe(spark, sf_dir)).select("id", "text_hash", "event_timestamp")


@query("duplicate_flag")
def q_duplicate_flag(spark, sf_dir):
    fe = _fe(spark, sf_dir).select("id", "text_hash", "event_timestamp")
    return G.duplicate_flag(fe).select("id", "is_duplicate")


@query("funnel_report")
def q_funnel_report(spark, sf_dir):
    return G.funnel_report(_fe(spark, sf_dir))


# ---------------------------------------------------------------- E: validation

from scoreloop.operators import validate as V  # noqa: E402


def _docs_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


def _previous_history(spark, sf_dir):
    prev = G.clean_feedback(_fe(spark, sf_dir).filter(F.col("event_timestamp") < F.lit(PREVIOUS_RUN_CUT)
                                                       .cast("timestamp_ntz")))
    return V.drift_entry(prev, PREVIOUS_RUN_CUT)


@query("null_ratio")
def q_null_ratio(spark, sf_dir):
    return V.null_ratio(_docs_labels(spark, sf_dir))


@query("duplicate_ratio")
def q_duplicate_ratio(spark, sf_dir):
    d = V.duplicate_stats(_fe(spark, sf_dir))
    return d.select("rows", "groups", F.round("duplicate_ratio", 6).alias("duplicate_ratio"))


@query("label_distribution")
def q_label_distribution(spark, sf_dir):
    return V.label_distribution(_fe(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query("alignment_ratio")
def q_alignment_ratio(spark, sf_dir):
    return _fe(spark, sf_dir).agg(F.round(F.avg(V.mismatch().cast("double")), 6).alias("mismatch_ratio"))


@query("freshness")
def q_freshness(spark, sf_dir):
    return _fe(spark, sf_dir).agg(
        F.round(F.avg(S.age_days("event_timestamp", AS_OF)), 6).alias("avg_age_days"))


@query("target_range")
def q_target_range(spark, sf_dir):
    df = _stale_targets(spark, sf_dir)
    return df.agg(F.coalesce(F.min(V.in_range()), F.lit(True)).alias("target_in_range"),
                  F.count_if(~V.in_range()).cast("long").alias("n_out_of_range"))


@query("score_drift")
def q_score_drift(spark, sf_dir):
    cur = G.clean_feedback(_fe(spark, sf_dir))
    baseline = V.latest_baseline(_previous_history(spark, sf_dir))
    m = cur.agg(F.avg("model_score").alias("current_mean"))
    drift = F.abs(F.col("current_mean") - baseline)
    return m.select(F.round(baseline, 6).alias("previous_mean"), F.round("current_mean", 6).alias("current_mean"),
                    F.round(drift, 6).alias("drift"),
                    F.when(baseline.isNull(), "info").when(drift > 0.2, "warn").otherwise("pass").alias("status"))


@query("validation_report")
def q_validation_report(spark, sf_dir):
    cur = G.clean_feedback(_fe(spark, sf_dir))
    return V.validation_report(cur, AS_OF, _previous_history(spark, sf_dir))


# ---------------------------------------------------------------- E9, E10, A6, D2, D3: audit and lineage

from scoreloop.operators import audit as AU  # noqa: E402
from scoreloop.sources import checksum as CS  # noqa: E402


@query("audit_basic")
def q_audit_basic(spark, sf_dir):
    return AU.audit_basic(FX.training_set(spark, sf_dir))


@query("audit_labels")
def q_audit_labels(spark, sf_dir):
    return AU.audit_labels(FX.training_set(spark, sf_dir))


@query("audit_tokens")
def q_audit_tokens(spark, sf_dir):
    return AU.audit_tokens(FX.training_set(spark, sf_dir))


@query("table_fingerprint")
def q_table_fingerprint(spark, sf_dir):
    return AU.table_fingerprint(FX.training_set(spark, sf_dir), ["text", "label"], by="source")


@query("file_checksum")
def q_file_checksum(spark, sf_dir):
    return CS.file_checksums(spark, f"{sf_dir.rstrip('/')}/*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "size_bytes", "sha256")


@query("file_tree")
def q_file_tree(spark, sf_dir):
    return CS.file_tree(spark, f"{sf_dir.rstrip('/')}/*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "size_bytes", "n_chunks", "root")


@query("text_tree")
def q_text_tree(spark, sf_dir):
    """The tree of ``file_tree`` over the bytes of each text, with small chunks and few children."""
    return CS.text_tree(table(spark, sf_dir, "documents"), "doc_id", "text", chunk=256, fanout=4)


@query("lineage_join")
def q_lineage_join(spark, sf_dir):
    j = AU.lineage_join(FX.model_runs(spark, sf_dir), FX.dataset_runs(spark, sf_dir))
    return j.select("run_id", "dataset_run_id", F.explode_outer("params").alias("param_key", "param_value")) \
        .withColumn("param_value", F.round("param_value", 6))


@query("lineage_check")
def q_lineage_check(spark, sf_dir):
    return AU.lineage_check(FX.model_runs(spark, sf_dir), FX.dataset_runs(spark, sf_dir))


# ---------------------------------------------------------------- E11, E13-E18: evaluation

from scoreloop.operators import evaluate as EV  # noqa: E402


def _pred(spark, sf_dir):
    return FX.predictions(spark, sf_dir)


@query("regression_metrics")
def q_regression_metrics(spark, sf_dir):
    return EV.regression_metrics(_pred(spark, sf_dir))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(_pred(spark, sf_dir))


@query("band_metrics")
def q_band_metrics(spark, sf_dir):
    return EV.band_metrics(_pred(spark, sf_dir))


@query("residual_histogram")
def q_residual_histogram(spark, sf_dir):
    return EV.residual_histogram(_pred(spark, sf_dir))


@query("residual_density")
def q_residual_density(spark, sf_dir):
    return EV.residual_density(_pred(spark, sf_dir))


@query("calibration")
def q_calibration(spark, sf_dir):
    return EV.calibration(_pred(spark, sf_dir))


@query("error_by_length")
def q_error_by_length(spark, sf_dir):
    measured = FX.predictions(spark, sf_dir, {"kept_length": TK.truncated_length("text")})
    return EV.error_by_length(measured, length="kept_length")


# ---------------------------------------------------------------- E12, F4-F6, K1-K3: runs

from scoreloop.operators import runs as RN  # noqa: E402


def _epochs(spark, sf_dir):
    return RN.epoch_loss(FX.loss_log(spark, sf_dir))


@query("epoch_loss")
def q_epoch_loss(spark, sf_dir):
    return _epochs(spark, sf_dir).select("run_id", "phase", "epoch", F.round("epoch_loss", 9).alias("epoch_loss"),
                                         "steps")


@query("running_loss")
def q_running_loss(spark, sf_dir):
    r = RN.running_loss(FX.loss_log(spark, sf_dir))
    return r.withColumn("running_loss", F.round("running_loss", 9))


@query("early_stop")
def q_early_stop(spark, sf_dir):
    return RN.early_stop(_epochs(spark, sf_dir))


@query("early_stop_running")
def q_early_stop_running(spark, sf_dir):
    """F5 on the running validation loss."""
    return RN.early_stop(RN.running_loss(FX.loss_log(spark, sf_dir)), metric="running_loss")


@query("best_checkpoint")
def q_best_checkpoint(spark, sf_dir):
    e = _epochs(spark, sf_dir)
    b = RN.best_checkpoint(e, RN.early_stop(e))
    return b.withColumn("best_value", F.round("best_value", 9))


@query("promotion_history")
def q_promotion_history(spark, sf_dir):
    return RN.promotion_history(FX.daily_candidates(spark, sf_dir))


@query("promotion_decision")
def q_promotion_decision(spark, sf_dir):
    cands = FX.daily_candidates(spark, sf_dir)
    last_day = cands.groupBy("family").agg(F.max("day").alias("last_day"))
    c = cands.join(last_day, "family")
    latest = c.filter(F.col("day") == F.col("last_day")).select("family", F.col("test_mae").alias("candidate_score"))
    earlier = c.filter(F.col("day") < F.col("last_day")).drop("last_day")
    best = RN.promotion_history(earlier).select("family", F.col("final_best").alias("best_score"))
    d = RN.promotion_decision(latest, best)
    return d.withColumn("improvement", F.round("improvement", 9))


RUN_KEYS = ["patience", "n_steps", "mean_loss", "n_epochs", "best_epoch_loss", "stop_epoch"]


@query("run_compare")
def q_run_compare(spark, sf_dir):
    rec = RN.run_records(FX.loss_log(spark, sf_dir)).withColumn("value", F.round("value", 9))
    return RN.run_compare(rec, RUN_KEYS)


# ---------------------------------------------------------------- G, H: order, splits, leaks

from scoreloop.operators import splits as SP  # noqa: E402


def _training_keyed(spark, sf_dir):
    """Key, label and hash of the training rows: texts stay out of the rank's sort and checkpoint."""
    return (FX.training_set(spark, sf_dir).withColumn("text_hash", S.text_hash("text"))
            .select("doc_id", "label", "text_hash"))


@query("sample_head")
def q_sample_head(spark, sf_dir):
    return SP.sample_head(G.clean_feedback(_fe(spark, sf_dir)))


@query("seeded_shuffle")
def q_seeded_shuffle(spark, sf_dir):
    return SP.seeded_shuffle(_fe(spark, sf_dir).select("id")).select("id", "shuffle_key", "shuffle_rank")


@query("split_exact")
def q_split_exact(spark, sf_dir):
    return SP.split_exact(_training_keyed(spark, sf_dir), key="doc_id").select("doc_id", "split", "rank_in_split")


@query("split_two_way")
def q_split_two_way(spark, sf_dir):
    data = _training_keyed(spark, sf_dir).select("doc_id")
    parts = [SP.split_exact(data, key="doc_id", train_ratio=r, two_way=True)
             .select("doc_id", F.lit(r).alias("train_ratio"), "split", "rank_in_split") for r in (0.8, 0.85)]
    return parts[0].union(parts[1])


@query("split_bucket")
def q_split_bucket(spark, sf_dir):
    return SP.split_bucket(_training_keyed(spark, sf_dir), key="doc_id").select("doc_id", "split")


@query("batch_plan")
def q_batch_plan(spark, sf_dir):
    return SP.batch_plan(SP.split_exact(_training_keyed(spark, sf_dir), key="doc_id"))


@query("split_leak")
def q_split_leak(spark, sf_dir):
    s = SP.split_exact(_training_keyed(spark, sf_dir), key="doc_id")
    return SP.split_leak(s.filter(F.col("split") == "train"), s.filter(F.col("split") != "train"))


# ---------------------------------------------------------------- D5, D6, B12, B15a: language, vocabulary, scoring

from scoreloop.operators import ingest as IN  # noqa: E402
from scoreloop.operators import lang as L  # noqa: E402
from scoreloop.operators import vocab as VO  # noqa: E402


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _profile(spark, sf_dir):
    return L.stored(_docs(spark, sf_dir))


def _weights(spark, sf_dir):
    from scoreloop.operators.sizing import bounded_lookup
    # the labels go to the texts
    lab = _docs(spark, sf_dir).select("doc_id", "text").join(bounded_lookup(table(spark, sf_dir, "labels").select("doc_id", "quality")), "doc_id")
    return VO.token_weights(lab)


@query("lang_profile")
def q_lang_profile(spark, sf_dir):
    from scoreloop.operators import langprofile as LP
    from scoreloop.operators.sizing import materialize
    p = L.profile_logp(materialize(LP.gram_counts(_docs(spark, sf_dir))))
    return p.withColumn("logp", F.round("logp", 9))


@query("lang_detect")
def q_lang_detect(spark, sf_dir):
    prof, langs = _profile(spark, sf_dir)
    d = _docs(spark, sf_dir).select("doc_id", "text")
    return L.with_language(d, prof, langs, key="doc_id", prepared=True, unique_keys=True) \
        .select("doc_id", "detected_lang")


@query("vocab_build")
def q_vocab_build(spark, sf_dir):
    return VO.vocab_build(_docs(spark, sf_dir))


@query("encode_fixed")
def q_encode_fixed(spark, sf_dir):
    d = _docs(spark, sf_dir)
    enc = VO.encode_fixed(d, VO.vocab_build(d), key="doc_id")
    return enc.select("doc_id", F.array_join("input_ids", ",").alias("ids_text"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


@query("score_linear")
def q_score_linear(spark, sf_dir):
    s = VO.score_linear(_docs(spark, sf_dir), _weights(spark, sf_dir), key="doc_id")
    return s.select("doc_id", F.round("score", 6).alias("score"))


@query("predict_pipeline")
def q_predict_pipeline(spark, sf_dir):
    prof, langs = _profile(spark, sf_dir)
    return IN.predict_batch(_docs(spark, sf_dir), prof, langs, VO.prepare_weights(_weights(spark, sf_dir)),
                            key="doc_id", prepared=True)


# ---------------------------------------------------------------- C1-C3, D1, I1, I4: ingest and monitors


@query("ingest_validate")
def q_ingest_validate(spark, sf_dir):
    return IN.validate_requests(FX.requests(spark, sf_dir)).select("id", "reject_reason")


@query("constraint_report")
def q_constraint_report(spark, sf_dir):
    return IN.constraint_report(FX.requests(spark, sf_dir).withColumn("text_hash", S.text_hash("text")))


@query("ingest_lang_gate")
def q_ingest_lang_gate(spark, sf_dir):
    prof, langs = _profile(spark, sf_dir)
    r = L.with_language(FX.requests(spark, sf_dir).withColumn("text_hash", S.text_hash("text")), prof, langs, key="text_hash",
                        prepared=True)
    return r.select("id", "detected_lang", L.language_reason().alias("reason"))


@query("ingest_new")
def q_ingest_new(spark, sf_dir):
    store, inc = FX.feedback_split(spark, sf_dir)
    new, _ = IN.split_new_and_duplicates(inc.withColumn("text_hash", S.text_hash("text")).drop("text"), store)
    return new.select("id", "text_hash")


@query("ingest_duplicates")
def q_ingest_duplicates(spark, sf_dir):
    store, inc = FX.feedback_split(spark, sf_dir)
    _, dups = IN.split_new_and_duplicates(inc.withColumn("text_hash", S.text_hash("text")).drop("text"), store)
    return dups.select("id", "text_hash")


@query("ingest_pipeline")
def q_ingest_pipeline(spark, sf_dir):
    prof, langs = _profile(spark, sf_dir)
    store, inc = FX.feedback_split(spark, sf_dir)
    return IN.ingest_batch(inc, store, prof, langs, prepared=True)


@query("monitor_tumbling")
def q_monitor_tumbling(spark, sf_dir):
    return IN.monitor(_fe(spark, sf_dir), "1 day")


@query("monitor_sliding")
def q_monitor_sliding(spark, sf_dir):
    return IN.monitor(_fe(spark, sf_dir), "3 days", "1 day")


# ---------------------------------------------------------------- K4, B15b, J4, K5: models (row-count checks)

from scoreloop.plans import model as MD  # noqa: E402


def _model_data(spark, sf_dir):
    """Training rows: each document text with the target of its latest feedback."""
    return FX.training_set(spark, sf_dir).filter(F.col("label").isNotNull())


@query("train_score_model")
def q_train_score_model(spark, sf_dir):
    data = _model_data(spark, sf_dir)
    split = SP.split_bucket(data, key="doc_id")
    model = MD.train_score_model(split.filter(F.col("split") == "train"))
    test = split.filter(F.col("split") == "test")
    return MD.score_ml(model, test).select("doc_id", F.col("label").alias("y_true"), F.col("score").alias("y_pred"))


@query("score_ml")
def q_score_ml(spark, sf_dir):
    model = MD.train_score_model(_model_data(spark, sf_dir), head="linear")
    return MD.score_ml(model, _docs(spark, sf_dir)).select("doc_id", "score")


@query("score_udf")
def q_score_udf(spark, sf_dir):
    s = MD.score_udf(_docs(spark, sf_dir), MD.length_prior_scorer, key="doc_id")
    return s.select("doc_id", F.round("score", 6).alias("score"))


@query("retrain_report")
def q_retrain_report(spark, sf_dir):
    from scoreloop.plans.retrain import retrain_report
    fe = _fe(spark, sf_dir)
    return retrain_report(spark, fe, AS_OF, _previous_history(spark, sf_dir), state_dir=_fresh(spark, "retrain"))


# ---------------------------------------------------------------- A2, A3: CSV round trip

@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    import uuid

    from pyspark.sql import types as T

    from scoreloop.schemas import FEEDBACK_EVENTS
    from scoreloop.session import scratch_path
    from scoreloop.sources.files import read_csv, write_csv

    clean = G.clean_feedback(_fe(spark, sf_dir)).select(*FEEDBACK_COLS)
    path = scratch_path(spark, f"clean_feedback_csv-{uuid.uuid4().hex}")
    write_csv(clean, path)
    schema = T.StructType(FEEDBACK_EVENTS.fields + [T.StructField("lang", T.StringType(), True)])
    return read_csv(spark, path, schema)


# ---------------------------------------------------------------- A4, A5, A7, A8: stores, written and read back

def _fresh(spark, name):
    import uuid

    from scoreloop.session import scratch_path

    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("metrics_json")
def q_metrics_json(spark, sf_dir):
    from scoreloop.sources.files import load_metrics, save_metrics

    metrics = EV.band_metrics(_pred(spark, sf_dir))
    path = _fresh(spark, "band_metrics")
    save_metrics(metrics, path)
    return load_metrics(spark, path, metrics.schema)


@query("dataset_registry")
def q_dataset_registry(spark, sf_dir):
    from scoreloop.sources.files import register_dataset

    data = FX.training_set(spark, sf_dir)
    path = _fresh(spark, "registry")
    for run in ("r1", "r2", "r1"):  # registering a run again changes nothing
        out = register_dataset(data, ["text", "label"], "training_set", run, path, AS_OF)
    return out.select("dataset", "run_id", "fingerprint", "rows", "registered_at")


@query("drift_state")
def q_drift_state(spark, sf_dir):
    from scoreloop.sources.files import append_drift, drift_history

    path = _fresh(spark, "drift")
    append_drift(_previous_history(spark, sf_dir), path)
    clean = G.clean_feedback(_fe(spark, sf_dir))
    report = V.validation_report(clean, AS_OF, drift_history(spark, path))
    if report.select(V.should_replace_baseline(report)).first()[0]:
        append_drift(V.drift_entry(clean, AS_OF), path)
    return drift_history(spark, path).select("run_ts", F.round("mean_score", 6).alias("mean_score"))


@query("ingest_append")
def q_ingest_append(spark, sf_dir):
    from scoreloop.sources.files import append_feedback, read_feedback_store

    prof, langs = _profile(spark, sf_dir)
    store, inc = FX.feedback_split(spark, sf_dir)
    path = _fresh(spark, "feedback_store")
    append_feedback(store.drop("lang"), path)
    for _ in range(2):  # the second delivery finds everything stored
        append_feedback(IN.accepted_rows(inc, read_feedback_store(spark, path), prof, langs, prepared=True), path)
    return read_feedback_store(spark, path).select("id", "text_hash", "target_score", F.col("event_date").cast("date").alias("event_date"))


@query("clean_feedback_detected")
def q_clean_feedback_detected(spark, sf_dir):
    """The funnel with the language gate by the detector (C4 via D5). The
    detector is a function of the text, so it runs before the dedup shuffle,
    once per distinct text that passes the length gate."""
    prof, langs = _profile(spark, sf_dir)
    fe = _fe(spark, sf_dir).filter(G.length_ok())
    x = L.with_language(fe, prof, langs, key="text_hash", prepared=True)
    out = G.clean_feedback(x, lang="detected_lang", text_only_language=True)
    return out.select(*FEEDBACK_COLS, "detected_lang")


@query("calibration_points")
def q_calibration_points(spark, sf_dir):
    return EV.calibration_points(_pred(spark, sf_dir))


# ---------------------------------------------------------------- K4: the training loop

RATES = {"fast": 8.0, "slow": 1.0}   # runs of the training queries
TRAIN_EPOCHS = 5


def _trained(spark, sf_dir):
    from scoreloop.plans import training as TR

    state = _fresh(spark, "training")
    data = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    TR.training_parts(data, f"{state}/parts", "doc_id", "quality", "text", TR.DIM, TR.ROUNDS)
    return state, TR.train_epochs(spark, f"{state}/parts", state, RATES, TRAIN_EPOCHS)


@query("train_epochs")
def q_train_epochs(spark, sf_dir):
    _, log = _trained(spark, sf_dir)
    return log.select("run_id", "epoch", *[F.round(c, 6).alias(c) for c in ("train_loss", "val_loss", "val_mae", "val_rmse")])


@query("train_best")
def q_train_best(spark, sf_dir):
    from scoreloop.plans import training as TR

    state, log = _trained(spark, sf_dir)
    best = TR.test_of_best(spark, f"{state}/parts", state, log)
    return best.select("run_id", "stop_epoch", "epochs_seen", "best_epoch", F.round("best_value", 6).alias("best_val_mae"),
                       F.round("test_mae", 6).alias("test_mae"), F.round("mean_mae", 6).alias("mean_mae"), "n_test")


# ---------------------------------------------------------------- D5: accuracy on documents the profile has not seen

@query("lang_heldout")
def q_lang_heldout(spark, sf_dir):
    docs = _docs(spark, sf_dir).withColumn("held_out", SP.seeded_key("doc_id") % 3 == 1)
    prof, langs = L.stored(docs.filter(~F.col("held_out")))
    found = L.with_language(docs.filter("held_out and lang is not null").select("doc_id", "text", "lang"), prof, langs, key="doc_id",
                            prepared=True, unique_keys=True)
    right = F.coalesce(F.col("detected_lang") == F.col("lang"), F.lit(False))
    return found.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(right).alias("correct"),
                                     F.round(F.avg(right.cast("double")), 6).alias("accuracy"))


# ---------------------------------------------------------------- I1, D1, A8: probe of the key index, all events

def _indexed(spark, sf_dir):
    from scoreloop.sources.files import append_feedback
    from scoreloop.sources.keyindex import KeyIndex

    store, inc = FX.feedback_cover(spark, sf_dir)
    path = _fresh(spark, "indexed_store")
    append_feedback(store.drop("lang"), path)
    return path, KeyIndex(spark, path), inc.withColumn("text_hash", S.text_hash("text"))


@query("probe_duplicates")
def q_probe_duplicates(spark, sf_dir):
    _, index, inc = _indexed(spark, sf_dir)
    return IN.flag_duplicates(inc.select("id", "text_hash", "event_timestamp"), index).select("id", "text_hash", "is_duplicate")


@query("probe_append")
def q_probe_append(spark, sf_dir):
    """Three deliveries of the same requests: the first adds, the others find everything stored, also in a compacted index."""
    from scoreloop.operators.sizing import materialize
    from scoreloop.sources.files import append_feedback, read_feedback_store

    path, index, inc = _indexed(spark, sf_dir)
    # the requests without their texts, hashed once; the texts of the few new rows (one a hash) join at the write
    arrived = materialize(IN.numbered(inc.filter(F.col("text_hash").isNotNull()).drop("text", "lang")))
    for k in range(3):
        new, _ = IN.split_new_and_duplicates(arrived, index)
        append_feedback(IN.with_texts(materialize(new), inc), path, batch_id=k)
        if k == 1:
            index.compact()
    return read_feedback_store(spark, path).select("id", "text_hash", "batch_id")


# ---------------------------------------------------------------- I2: first arrival in a stream's state

@query("unique_stream")
def q_unique_stream(spark, sf_dir):
    """All requests as a stream of several batches in shuffled order, with the stored keys as the first state."""
    from scoreloop.streaming import unique as U

    store, inc = FX.feedback_cover(spark, sf_dir)
    path = _fresh(spark, "unique")
    rows = inc.select("id", S.text_hash("text").alias("text_hash"), "event_timestamp")
    rows.repartition(4, F.md5(F.col("id").cast("string"))).write.parquet(f"{path}/requests")
    src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/requests")
    q = U.start_unique(src, f"{path}/decisions", f"{path}/checkpoint", store, partitions=8)
    q.awaitTermination()
    return U.settled(spark, f"{path}/decisions").select("text_hash", "id", "copies", "kept")


# ---------------------------------------------------------------- E8: stored verdicts of many runs

def _run_history(spark, sf_dir):
    """Raw, stale-target and cleaned feedback, a run per day of each, judged in one plan and stored."""
    from scoreloop.operators.sizing import materialize
    from scoreloop.sources.files import append_runs

    tables = {"raw": _fe(spark, sf_dir), "stale": _stale_targets(spark, sf_dir, with_lang=True), "clean": G.clean_feedback(_fe(spark, sf_dir))}
    day = F.date_format("event_timestamp", "yyyy-MM-dd")
    # texts stay behind: whether one is missing is all a check asks
    narrow = ["id", F.when(F.col("text").isNotNull(), "").alias("text"), "text_hash", "model_score", "user_feedback", "model_version",
              "event_timestamp", "target_score", "lang"]
    rows = None
    for name, df in tables.items():
        one = df.select(*narrow, F.lit(name).alias("table"), day.alias("run"))
        rows = one if rows is None else rows.unionByName(one)
    rows = materialize(rows)
    path = _fresh(spark, "validation_runs")
    append_runs(V.validation_runs(rows.filter("run < '2024-01-20'"), AS_OF), path)
    return append_runs(V.validation_runs(rows, AS_OF), path)  # known runs stay as they were judged


@query("validation_runs")
def q_validation_runs(spark, sf_dir):
    return _run_history(spark, sf_dir).select("table", "run", "ord", "check", "value", "limit_value", "status", "outcome")


@query("run_verdicts")
def q_run_verdicts(spark, sf_dir):
    return V.run_verdicts(_run_history(spark, sf_dir))


# ---------------------------------------------------------------- I4: monitors from stored panes

@query("monitor_panes")
def q_monitor_panes(spark, sf_dir):
    """Panes of the older and of the newer model versions, stored one after the other, merged into 3-day windows."""
    from scoreloop.operators import panes as PN

    path = _fresh(spark, "panes")
    fe = _fe(spark, sf_dir).select("model_version", "event_timestamp", "model_score", "user_feedback")
    for older in (True, False):
        PN.pane_states(fe.filter((F.col("model_version") <= "m2") == F.lit(older))).write.mode("append").parquet(path)
    return PN.window_report(PN.merge_panes(spark.read.parquet(path)), 3)


# ---------------------------------------------------------------- K5: the restartable chain

@query("retrain_chain")
def q_retrain_chain(spark, sf_dir):
    """The chain, run twice: the second run finds every step in the journal."""
    from scoreloop.plans.chain import retrain_chain

    state = _fresh(spark, "chain")
    for _ in range(2):
        out = retrain_chain(spark, _fe(spark, sf_dir), AS_OF, state, epochs=2)
    return out.select("step", "status", "n_rows")
