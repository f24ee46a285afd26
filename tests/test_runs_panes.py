"""E8 run history and I4 panes."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from scoreloop.operators import ingest as IN
from scoreloop.operators import panes as PN
from scoreloop.operators import validate as V
from scoreloop.sources.files import append_runs
from tests.conftest import feedback

SF = "/root/testdata/sf0.001"


def events(spark, seed, n=400):
    rnd = random.Random(seed)
    return feedback(spark, [(i, f"text {rnd.randint(0, 300)}", rnd.choice([None, float("nan"), 1.5, -0.25] + [rnd.random()] * 9), rnd.choice(["human", "ai", "human_edited_ai", None]),
                             rnd.choice([None] + [f"2024-01-{rnd.randint(1, 9):02d} 0{rnd.randint(0, 9)}:00:00"] * 9)) for i in range(n)])


def test_windows_from_panes_equal_the_events(spark):
    e = events(spark, 1)
    parts = [PN.pane_states(e.filter(F.col("id") % 3 == k)) for k in range(3)]
    got = {r.window_start: r for r in PN.window_report(PN.merge_panes(*parts), 3).collect()}
    want = {r.window_start: r for r in IN.monitor(e.filter("event_timestamp is not null"), "3 days", "1 day").collect()}
    assert got.keys() == want.keys()
    scores = [(r.event_timestamp, r.model_score) for r in e.collect() if r.event_timestamp and r.model_score is not None and not math.isnan(r.model_score)]
    for w, r in want.items():
        g = got[w]
        assert (g.window_end, g.n, g.mean_score, g.mismatch_ratio, g.ai_share) == (r.window_end, r.n, r.mean_score, r.mismatch_ratio, r.ai_share)
        own = sorted(s for t, s in scores if w <= t < w + dt.timedelta(days=3))
        for q, v in ((0.5, g.score_p50), (0.95, g.score_p95)):
            assert abs(v - own[math.ceil(q * len(own)) - 1]) <= 0.5 / PN.BINS + 1e-9
    assert PN.window_report(PN.pane_states(e.limit(0))).count() == 0
    late = PN.pane_states(feedback(spark, [(1, "x", None, None, "2024-03-01")]))
    assert PN.window_report(late, 1).first().score_p50 is None


def test_panes_do_not_read_events_again(spark):
    states = PN.pane_states(events(spark, 2, 5000))
    assert states.groupBy("pane").count().agg(F.max("count")).first()[0] <= PN.BINS + 300


@pytest.fixture(scope="module")
def history(spark):
    from scoreloop.plans.registry import QUERIES

    return QUERIES["validation_runs"](spark, SF).collect()


def test_one_run_equals_the_report(spark):
    e = events(spark, 3).withColumns({"table": F.lit("t"), "run": F.lit("r")})
    runs = V.validation_runs(e, "2024-02-01 00:00:00").orderBy("ord").collect()
    report = V.validation_report(e.drop("table", "run"), "2024-02-01 00:00:00").orderBy("ord").collect()
    assert [tuple(r)[2:] for r in runs] == [tuple(r) for r in report]


def test_outcomes_occur_and_follow_the_first_failure(history):
    assert {"fail", "not_run", "pass"} <= {r.outcome for r in history}
    runs = {}
    for r in sorted(history, key=lambda r: r.ord):
        runs.setdefault((r.table, r.run), []).append(r)
    for checks in runs.values():
        fails = [r.ord for r in checks if r.status == "fail"]
        assert [r.outcome for r in checks] == ["not_run" if fails and r.ord > fails[0] else r.status for r in checks]


def test_baseline_is_the_latest_sound_run(spark):
    rows = []
    for day, score, label in (("01", 0.5, None), ("02", 0.5, "x"), ("03", 0.9, "bad"), ("04", 0.8, "x"), ("05", 0.55, "x")):
        for i in range(120):
            fb = "human" if i % 2 else "ai"
            s = 0.9 if label == "bad" and fb == "human" else (0.1 if label == "bad" else score)  # day 3 contradicts its feedback
            rows.append((1000 * int(day) + i, f"{day} {i}", s, fb, f"2024-01-{day}"))
    df = feedback(spark, rows).withColumns({"table": F.lit("t"), "run": F.date_format("event_timestamp", "dd")})
    got = {r.run: r for r in V.validation_runs(df, "2024-01-10 00:00:00").filter("ord = 10").collect()}
    assert (got["01"].status, got["02"].value, got["02"].status) == ("info", 0.0, "pass")
    assert got["03"].outcome == "not_run"  # a hard failure: no baseline for the next day
    assert (got["04"].value, got["04"].status, got["05"].value, got["05"].status) == (0.3, "warn", 0.25, "warn")


def test_history_keeps_first_verdicts(spark, tmp_dir):
    e = events(spark, 4).withColumns({"table": F.lit("t"), "run": F.lit("r1")})
    first = V.validation_runs(e, "2024-02-01 00:00:00")
    assert append_runs(first, f"{tmp_dir}/h").count() == 10
    again = append_runs(V.validation_runs(e.withColumn("run", F.when(F.col("id") < 200, "r1").otherwise("r2")), "2024-02-01 00:00:00"), f"{tmp_dir}/h")
    assert again.count() == 20
    assert {r.ord: r.value for r in again.filter("run = 'r1'").collect()} == {r.ord: r.value for r in first.collect()}
    verdicts = {r.run: r for r in V.run_verdicts(again).collect()}
    assert set(verdicts) == {"r1", "r2"} and all(v.verdict == "failed" and v.first_failure for v in verdicts.values())
