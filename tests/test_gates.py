"""Funnel pins."""

from pyspark.sql import functions as F

from conftest import feedback
from scoreloop.operators import gates as G


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_null_timestamp_counts_as_latest(spark):
    df = feedback(spark, [(1, "same text here", 0.1, "human", "2024-01-02"),
                          (2, "same text here", 0.1, "human", None)])
    assert ids(G.dedup_latest(df)) == [2]


def test_ties_break_by_larger_id(spark):
    df = feedback(spark, [(1, "tie text", 0.1, "human", "2024-01-02"),
                          (5, "tie text", 0.1, "human", "2024-01-02")])
    assert ids(G.dedup_latest(df)) == [5]


def test_null_hashes_form_one_group(spark):
    df = feedback(spark, [(1, None, 0.1, "human", "2024-01-01"), (2, None, 0.1, "human", "2024-01-02")])
    assert ids(G.dedup_latest(df)) == [2]


def test_latest_inconsistent_loses_the_text(spark):
    df = feedback(spark, [(1, "a consistent text", 0.1, "human", "2024-01-01"),
                          (2, "a consistent text", 0.9, "human", "2024-01-05")])
    assert G.clean_feedback(df).count() == 0


def test_null_and_nan_scores_are_kept(spark):
    df = feedback(spark, [(1, "text one", None, "human", "2024-01-01"),
                          (2, "text two", float("nan"), "human", "2024-01-01"),
                          (3, "text three", float("nan"), "ai", "2024-01-01")])
    assert ids(G.gate_consistency(df)) == [1, 2, 3]


def test_length_limits_inclusive_code_points(spark):
    rows = [(1, "a" * 4, 0.1, "human", "2024-01-01"), (2, "a" * 5, 0.1, "human", "2024-01-01"),
            (3, "b" * 1000, 0.1, "human", "2024-01-01"), (4, "c" * 1001, 0.1, "human", "2024-01-01"),
            (5, "é😀é😀é", 0.1, "human", "2024-01-01"), (6, None, 0.1, "human", "2024-01-01")]
    assert ids(G.gate_length(feedback(spark, rows))) == [2, 3, 5]


def test_score_ends_are_strict(spark):
    df = feedback(spark, [(1, "human text", 0.7, "human", "2024-01-01"),
                          (2, "ai text!", 0.3, "ai", "2024-01-01"),
                          (3, "human hi", 0.7001, "human", "2024-01-01"),
                          (4, "ai low!!", 0.2999, "ai", "2024-01-01")])
    assert ids(G.gate_consistency(df)) == [1, 2]


def test_remap_all_or_nothing_and_backfill_nulls_only(spark):
    df = feedback(spark, [(1, "t1 text", 0.1, "human", "2024-01-01", 0.25),
                          (2, "t2 text", 0.9, "ai", "2024-01-01", None),
                          (3, "t3 text", 0.5, "human_edited_ai", "2024-01-01", 0.5)])
    remap = {r["id"]: r["target_score"] for r in G.target_remap(df).collect()}
    back = {r["id"]: r["target_score"] for r in G.target_backfill(df).collect()}
    assert remap == {1: 0.0, 2: 1.0, 3: 0.5}
    assert back == {1: 0.25, 2: 1.0, 3: 0.5}
    no_nulls = df.filter("id != 2")
    assert {r["id"]: r["target_score"] for r in G.target_remap(no_nulls).collect()} == {1: 0.25, 3: 0.5}


def test_funnel_counts_never_rise(spark):
    from scoreloop.sources.fixtures import feedback_events

    r = G.funnel_report(feedback_events(spark, "/root/testdata/sf0.001")).first()
    seq = [r["initial_rows"], r["after_dedup"], r["after_language"], r["after_length"],
           r["after_consistency"], r["after_target"]]
    assert seq == [1000, 189, 120, 36, 35, 35]
    assert all(a >= b for a, b in zip(seq, seq[1:]))


def test_funnel_report_on_empty_table(spark):
    df = feedback(spark, [(1, "x text", 0.1, "human", "2024-01-01")]).limit(0)
    r = G.funnel_report(df).first()
    assert r["initial_rows"] == 0 and r["retention_pct"] is None


def test_dedup_plan_limits_before_shuffle(spark):
    from scoreloop.sources.fixtures import feedback_events

    plan = G.dedup_latest(feedback_events(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
