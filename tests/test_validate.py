"""Validation checks."""

from pyspark.sql import functions as F

from conftest import feedback
from scoreloop.operators import validate as V

AS_OF = "2024-02-01 00:00:00"


def _rows(n, dup=0, ai_share=0.5):
    rows = []
    for i in range(n):
        text = f"distinct text number {i}" if i >= dup else "duplicated text"
        fb = "ai" if i < n * ai_share else "human"
        score = 0.9 if fb == "ai" else 0.1
        rows.append((i, text, score, fb, "2024-01-20"))
    return rows


def report(spark, rows, history=None):
    return {r["check"]: r for r in V.validation_report(feedback(spark, rows), AS_OF, history).collect()}


def test_exact_limits_pass(spark):
    # 100 rows, exactly 5 % second copies (6 rows share one text -> 5 later copies)
    r = report(spark, _rows(100, dup=6))
    assert r["min_samples"]["status"] == "pass"
    assert abs(r["duplicate_ratio"]["value"] - 0.05) < 1e-12
    assert r["duplicate_ratio"]["status"] == "pass"


def test_too_few_rows_fail_and_later_checks_do_not_run(spark):
    r = report(spark, _rows(99))
    assert r["min_samples"]["status"] == "fail"
    assert r["null_ratio"]["outcome"] == "not_run"


def test_null_target_fails_range(spark):
    rows = _rows(100)
    rows[0] = rows[0] + (None,)
    r = report(spark, rows)
    assert r["target_range"]["status"] == "fail"


def test_drift_first_run_info_then_warn(spark):
    r = report(spark, _rows(100))
    assert r["score_drift"]["status"] == "info"
    hist = spark.createDataFrame([("2024-01-01 00:00:00", 0.1)], "run_ts string, mean_score double") \
        .select(F.col("run_ts").cast("timestamp_ntz"), "mean_score")
    r = report(spark, _rows(100), hist)
    assert r["score_drift"]["status"] == "warn"          # mean 0.5 vs 0.1
    assert V.should_replace_baseline(V.validation_report(feedback(spark, _rows(100)), AS_OF, hist)) is not None


def test_empty_table_ratios_null_no_error(spark):
    df = feedback(spark, _rows(1)).limit(0)
    rows = {r["check"]: r for r in V.validation_report(df, AS_OF).collect()}
    assert rows["min_samples"]["status"] == "fail"
    assert rows["duplicate_ratio"]["value"] is None
    nr = V.null_ratio(df).collect()
    assert all(r["null_ratio"] is None for r in nr)


def test_missing_columns_fail_first(spark):
    df = feedback(spark, _rows(5)).drop("text_hash")
    assert V.missing_columns(df) == ["text_hash"]
    assert V.validation_report(df, AS_OF).first()["status"] == "fail"


def test_freshness_warns_only(spark):
    rows = [r[:4] + ("2023-01-01",) for r in _rows(120)]
    r = report(spark, rows)
    assert r["freshness_days"]["status"] == "warn"
    assert r["freshness_days"]["outcome"] == "warn"
