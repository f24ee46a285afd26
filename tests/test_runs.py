"""Run analytics and promotion."""

from pyspark.sql import functions as F

from scoreloop.operators import runs as RN


def epochs(spark, values, run="r"):
    return spark.createDataFrame([(run, i, float(v)) for i, v in enumerate(values)],
                                 "run_id string, epoch long, epoch_loss double")


def test_early_stop_patience_two(spark):
    r = RN.early_stop(epochs(spark, [3, 2, 2, 2, 1])).first()
    assert r["stop_epoch"] == 3          # the 4th value


def test_early_stop_never(spark):
    assert RN.early_stop(epochs(spark, [5, 4, 3, 2])).first()["stop_epoch"] is None


def test_early_stop_on_nan(spark):
    assert RN.early_stop(epochs(spark, [5, float("nan"), 3])).first()["stop_epoch"] == 1


def test_best_checkpoint_first_on_ties(spark):
    e = epochs(spark, [3, 1, 1, 2])
    assert RN.best_checkpoint(e).first()["best_epoch"] == 1


def test_running_loss_is_mean_of_all_steps(spark):
    log = spark.createDataFrame([("r", "val", 0, 0, 1.0), ("r", "val", 0, 1, 3.0), ("r", "val", 1, 2, 8.0)],
                                "run_id string, phase string, epoch long, step long, loss double")
    got = {r["epoch"]: r["running_loss"] for r in RN.running_loss(log).collect()}
    assert got == {0: 2.0, 1: 4.0}


def _decide(spark, cand, best):
    c = spark.createDataFrame([("f", cand)], "family string, candidate_score double")
    if best == "none":
        b = spark.createDataFrame([], "family string, best_score double")
    else:
        b = spark.createDataFrame([("f", best)], "family string, best_score double")
    return RN.promotion_decision(c, b).first()


def test_promotion_cases(spark):
    assert _decide(spark, 0.1, "none")["promoted"] is True
    assert _decide(spark, 0.098, 0.1)["promoted"] is True
    r = _decide(spark, 0.0985, 0.1)
    assert (r["promoted"], r["reason"]) == (False, "insufficient_improvement")
    r = _decide(spark, 0.1, 0.1)
    assert (r["promoted"], r["reason"]) == (False, "no_improvement")
    r = _decide(spark, float("nan"), 0.1)
    assert (r["promoted"], r["reason"]) == (False, "insufficient_improvement")
    r = _decide(spark, 0.2, None)             # best file without the key -> infinity
    assert (r["promoted"], r["improvement"]) == (True, 1.0)
    assert _decide(spark, None, 0.1)["reason"] == "missing_metric"


def test_promotion_history_fold(spark):
    vals = [0.100, 0.099, 0.0985, 0.097, 0.20]
    c = spark.createDataFrame([("f", i, v) for i, v in enumerate(vals)], "family string, day long, test_mae double")
    r = RN.promotion_history(c, order="day").first()
    # 0.100 first deployment; 0.099, 0.0985 too small; 0.097 is 3 % better
    assert (r["final_best"], r["promotions"], r["last_promoted"]) == (0.097, 2, 3)


def test_promotion_history_goldens(spark):
    from scoreloop.sources.fixtures import daily_candidates

    got = {r["family"]: (r["final_best"], r["promotions"])
           for r in RN.promotion_history(daily_candidates(spark, "/root/testdata/sf0.01")).collect()}
    assert got == {"m1": (0.386793, 3), "m2": (0.153071, 4), "m3": (0.156532, 5), "m4": (0.158286, 2)}


def test_early_stop_goldens(spark):
    from scoreloop.sources.fixtures import loss_log

    e = RN.epoch_loss(loss_log(spark, "/root/testdata/sf0.01"))
    got = {r["run_id"]: r["stop_epoch"] for r in RN.early_stop(e).collect()}
    assert [got[f"r{i}"] for i in range(7)] == [4, 4, 5, 3, 2, 4, 6]
