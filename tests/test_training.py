"""K4 training loop: gradient, convergence, resume, stops, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloop.operators import runs as RN
from scoreloop.plans import training as TR


def rows_of(spark, n=400):
    good, bad = "alpha beta gamma delta", "omega sigma lambda kappa"
    data = [(i, f"{good if i % 2 else bad} w{i % 17} {'alpha ' * (i % 3)}", float(i % 2)) for i in range(n)]
    return spark.createDataFrame(data, "doc_id long, text string, label double")


def trained(spark, path, rates, epochs, data=None, **kw):
    TR.training_parts(rows_of(spark) if data is None else data, f"{path}/parts", "doc_id", "label", "text", 256, 3)
    return TR.train_epochs(spark, f"{path}/parts", path, rates, epochs, 3, 256, **kw)


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(0)
    row = np.repeat(np.arange(20), 5)
    idx, val, y = rng.integers(0, 12, 100), rng.random(100), rng.random(20)
    theta = rng.normal(0, 1, (2, 13))
    sq, ab, g = TR.gradient(theta, row, idx, val, y)
    p = TR.predictions(theta, row, idx, val, 20)
    assert np.allclose(sq, ((p - y) ** 2).sum(axis=1)) and np.allclose(ab, np.abs(p - y).sum(axis=1))
    for r in range(2):
        for j in range(13):
            d = np.zeros((2, 13))
            d[r, j] = 1e-6
            slope = (TR.gradient(theta + d, row, idx, val, y)[0] - TR.gradient(theta - d, row, idx, val, y)[0]) / 2e-6
            assert abs(slope[r] - g[r, j]) < 1e-6 and slope[1 - r] == 0


def test_learns_and_takes_the_best_checkpoint(spark, tmp_dir):
    log = trained(spark, tmp_dir, {"a": 4.0, "b": 0.01}, 4)
    best = {r.run_id: r for r in TR.test_of_best(spark, f"{tmp_dir}/parts", tmp_dir, log, 256).collect()}
    assert best["a"].test_mae < 0.2 * best["a"].mean_mae and best["a"].n_test > 30
    for r in log.collect():
        if r.epoch == best[r.run_id].best_epoch:
            assert r.val_mae == best[r.run_id].best_value
        assert r.val_mae >= best[r.run_id].best_value
    assert abs(best["b"].test_mae - 0.5) < 0.05  # hardly moved
    # the log has the columns of a loss log: epoch means and running means read it
    epochs = RN.running_loss(log.select("run_id", F.lit("train").alias("phase"), "epoch", F.col("train_loss").alias("loss")))
    assert epochs.count() == log.count()


def test_sums_do_not_depend_on_partitions(spark, tmp_dir):
    TR.training_parts(rows_of(spark), f"{tmp_dir}/parts", "doc_id", "label", "text", 256, 3)
    rows = spark.read.parquet(f"{tmp_dir}/parts")
    theta = np.random.default_rng(1).normal(0, 1, (2, 257))
    a, b = (TR.sums(rows.repartition(k), theta, True) for k in (1, 7))
    assert a[0] == b[0] == 400 and all(np.allclose(x, y, atol=1e-12) for x, y in zip(a[1:], b[1:]))


def test_goes_on_after_the_last_whole_epoch(spark, tmp_dir):
    import tempfile

    other = tempfile.mkdtemp(prefix="scoreloop-test-")
    trained(spark, other, {"a": 1.0}, 2).collect()
    # a crash after the weights of epoch 2 and before its log row
    spark.createDataFrame([("a", 2, 5, 99.0, 99.0)], TR.WEIGHTS).write.mode("append").partitionBy("epoch").parquet(f"{other}/weights")
    again = TR.train_epochs(spark, f"{other}/parts", other, {"a": 1.0}, 4, 3, 256)
    whole = trained(spark, tmp_dir, {"a": 1.0}, 4)
    for x, y in zip(again.orderBy("epoch").collect(), whole.orderBy("epoch").collect(), strict=True):
        assert x.epoch == y.epoch and abs(x.val_mae - y.val_mae) < 1e-12 and abs(x.train_loss - y.train_loss) < 1e-12


def test_stops_and_edges(spark, tmp_dir):
    import tempfile

    log = trained(spark, tmp_dir, {"wild": 1e6, "calm": 0.5}, 8).groupBy("run_id").agg(F.max("epoch").alias("last")).collect()
    last = {r.run_id: r["last"] for r in log}
    assert last["wild"] < 7  # saturated: no lower val_mae for two epochs
    empty = tempfile.mkdtemp(prefix="scoreloop-test-")
    assert trained(spark, empty, {"a": 1.0}, 2, rows_of(spark).limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None, 1.0), (2, "", 0.0), (3, "x", None), (4, "y", float("nan")), (5, "a b", 1.0), (None, "c d", 0.0)],
                                "doc_id long, text string, label double").withColumn("idx", F.lit("x"))
    path = tempfile.mkdtemp(prefix="scoreloop-test-")
    TR.training_parts(odd, f"{path}/parts", "doc_id", "label", "text", 16, 2)
    assert spark.read.parquet(f"{path}/parts").count() == 4  # rows without a label are not learned from
    assert all(r.train_loss >= 0 for r in TR.train_epochs(spark, f"{path}/parts", path, {"a": 1.0}, 1, 2, 16).collect())
    with pytest.raises(ValueError):
        TR.train_epochs(spark, f"{path}/parts", path, {"a": 1.0}, 1, 2, 1 << 30)
