"""K4 as a training loop: epochs of distributed gradient rounds, a validation log,
early stop and the best checkpoint.

The score is a sigmoid over hashed word counts (unit length, ``dim`` buckets and a bias), the loss its mean squared
error. The training rows are dealt to ``rounds`` folds by their seeded key; a round reads one fold, so an epoch
reads every row once. Tasks add up partial gradients of their rows; only the sums (one number per run and bucket, a
size that is checked) meet on the driver, where the weights move with momentum. Several learning rates are
trained side by side as runs of their own, at one pass for all of them.

After an epoch the validation rows give val_loss, val_mae and val_rmse. The log and the weights of every
epoch are stored in ``state_dir``; a restarted job goes on after its last whole epoch. A run stops after
``patience`` epochs without a lower val_mae (F5); its best checkpoint is the one of lowest val_mae (F6).
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.config import SIZING, TRAINING
from scoreloop.functions.tokens import tokens
from scoreloop.operators import runs as RN
from scoreloop.operators.splits import seeded_key, split_bucket
from scoreloop.sources.files import read_parquet_or_none

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIM, ROUNDS, MOMENTUM = 1 << 12, 4, 0.9
LOG = "run_id string, epoch int, train_loss double, val_loss double, val_mae double, val_rmse double"
PARTS = "y double, idx array<int>, val array<double>, part string"
WEIGHTS = "run_id string, epoch int, bucket int, weight double, velocity double"


def hashed_features(df: DataFrame, dim: int = DIM, text: str = "text", *keep: str) -> DataFrame:
    """``keep`` columns with ``idx`` and ``val``: buckets of the text's lower-case words and their
    counts, scaled to unit length. Words only (no punctuation); no shuffle. Null and empty texts have no bucket."""
    words = F.filter(F.transform(tokens(F.lower(F.coalesce(F.col(text), F.lit("")))), lambda t: F.ltrim(t)),
                     lambda t: t.rlike(r"^\p{L}+$"))
    bucket = lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long") % dim).cast("int")
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            idx, val = [], []
            for row in b.column(b.num_columns - 1):
                i, n = np.unique(row.values.to_numpy(zero_copy_only=False), return_counts=True)
                idx.append(i.astype(np.int32))
                val.append(n / np.sqrt(float((n * n).sum())) if len(n) else n.astype(float))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(len(keep))], pa.array(idx, pa.list_(pa.int32())),
                                              pa.array(val, pa.list_(pa.float64()))], names=[*keep, "idx", "val"])

    return df.select(*keep, F.transform(words, bucket).alias("_b")).mapInArrow(run, f"{kinds}, idx array<int>, val array<double>")


def predictions(theta, row, idx, val, n: int):
    """Scores (runs x rows) of sparse rows under weights (runs x buckets, the bias last)."""
    s = np.stack([np.bincount(row, t[idx] * val, n) + t[-1] for t in theta])
    return 1 / (1 + np.exp(-s))


def gradient(theta, row, idx, val, y):
    """(sums of squared errors, of absolute errors, gradients of the former) of sparse rows, per run."""
    p = predictions(theta, row, idx, val, len(y))
    e = p - y
    d = 2 * e * p * (1 - p)
    size = theta.shape[1] - 1
    g = np.stack([np.append(np.bincount(idx, k[row] * val, size), k.sum()) for k in d])
    return (e * e).sum(axis=1), np.abs(e).sum(axis=1), g


def flat(batch):
    """(row of each entry, idx, val, y) of a batch (y, idx, val)."""
    lens = np.array([len(x) for x in batch.column(1)], np.int64)
    take = lambda k, kind: batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(kind)
    return np.repeat(np.arange(len(lens)), lens), take(1, np.int64), take(2, float), batch.column(0).to_numpy(zero_copy_only=False)


def sums(rows: DataFrame, theta, with_gradient: bool):
    """(n, squared errors, absolute errors, gradients) over all rows (y, idx, val): partial sums per task, then one number per run and bucket."""
    spark = rows.sparkSession
    runs, width = theta.shape
    shared = spark.sparkContext.broadcast(theta)

    def run(batches):
        import pyarrow as pa

        t = shared.value
        total = np.zeros((runs, width + 3))
        for b in batches:
            if b.num_rows:
                row, idx, val, y = flat(b)
                sq, ab, g = gradient(t, row, idx, val, y)
                total[:, 0] += len(y)
                total[:, 1] += sq
                total[:, 2] += ab
                total[:, 3:] += g
        cells = total if with_gradient else total[:, :3]
        i, j = np.nonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(cells[i, j])], names=["run", "cell", "v"])

    out = np.zeros((runs, width + 3))
    for r in (rows.select("y", "idx", "val").mapInArrow(run, "run long, cell long, v double")
              .groupBy("run", "cell").agg(F.sum("v").alias("v")).collect()):
        out[r["run"], r["cell"]] = r["v"]
    shared.destroy()
    return out[0, 0], out[:, 1], out[:, 2], out[:, 3:]


def training_parts(data: DataFrame, path: str, key: str, label: str, text: str, dim: int, rounds: int, split_col: str | None = None) -> None:
    """Features of all labelled rows under ``path``, by part: ``val``, ``test`` and the folds of the training rows
    (by ``split_col`` if the rows are split already, else by the seeded key)."""
    labelled = data.filter(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double"))).withColumn("y", F.col(label).cast("double"))
    split = split_bucket(labelled, key=key) if split_col is None else labelled.withColumn("split", F.col(split_col))
    part = F.when(F.col("split") == "train", (seeded_key(key) % rounds).cast("string")).otherwise(F.col("split"))
    (hashed_features(split.withColumn("part", part), dim, text, key, "y", "part")
     .write.mode("overwrite").partitionBy("part").parquet(path))


def train_epochs(spark: SparkSession, parts_path: str, state_dir: str, rates: dict[str, float], epochs: int = 5, rounds: int = ROUNDS,
                 dim: int = DIM, patience: int = TRAINING.patience) -> DataFrame:
    """Run (or go on with) the epochs; the log, one row per run and epoch up to the run's stop.

    A run whose loss is not finite stops there. Without training rows the log is empty."""
    if len(rates) * (dim + 1) * 8 > SIZING.max_broadcast_bytes:
        raise ValueError("the weights of all runs exceed the broadcast bound")
    parts = spark.read.schema(PARTS).parquet(parts_path)
    names = sorted(rates)
    rate = np.array([[rates[r]] for r in names])
    theta, velocity = np.zeros((len(names), dim + 1)), np.zeros((len(names), dim + 1))
    log = read_parquet_or_none(spark, f"{state_dir}/log")
    done = -1 if log is None else log.agg(F.max("epoch")).first()[0]
    if log is not None:
        stored = spark.read.parquet(f"{state_dir}/weights").filter(F.col("epoch") == done)
        for r in stored.collect():  # one row per run and bucket
            theta[names.index(r["run_id"]), r["bucket"]] = r["weight"]
            velocity[names.index(r["run_id"]), r["bucket"]] = r["velocity"]
    for epoch in range(done + 1, epochs):
        if log is not None and stopped(log, patience) >= set(names):
            break
        losses = []
        for k in range(rounds):
            n, squares, _, g = sums(parts.filter(F.col("part") == str(k)), theta, True)
            if n:
                losses.append(squares / n)
                velocity = MOMENTUM * velocity + g / n
                theta = theta - rate * velocity
        if not losses:
            return spark.createDataFrame([], LOG)
        n, squares, absolute, _ = sums(parts.filter(F.col("part") == "val"), theta, False)
        n = n or float("nan")
        rows = [(r, epoch, float(np.mean([x[i] for x in losses])), float(squares[i] / n), float(absolute[i] / n), float(np.sqrt(squares[i] / n)))
                for i, r in enumerate(names)]
        i, j = np.nonzero((theta != 0) | (velocity != 0))
        spark.createDataFrame([(names[a], epoch, int(b), float(theta[a, b]), float(velocity[a, b])) for a, b in zip(i, j)], WEIGHTS) \
            .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{state_dir}/weights")
        # the log row comes last: an epoch without one is run again
        (spark.createDataFrame(rows, LOG).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(f"{state_dir}/log"))
        log = spark.read.parquet(f"{state_dir}/log")
    if log is None:
        return spark.createDataFrame([], LOG)
    stops = RN.early_stop(log, "val_mae", patience, phase=None).select("run_id", "stop_epoch")
    ran = log.join(stops, "run_id").filter(F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    return ran.select("run_id", "epoch", "train_loss", "val_loss", "val_mae", "val_rmse")


def stopped(log: DataFrame, patience: int) -> set[str]:
    stops = RN.early_stop(log, "val_mae", patience, phase=None)
    return {r["run_id"] for r in stops.filter("stop_epoch is not null").collect()}


def best_checkpoints(log: DataFrame, patience: int = TRAINING.patience) -> DataFrame:
    """(run_id, stop_epoch, best_epoch, best_value) from a training log (F5, F6 on val_mae)."""
    stops = RN.early_stop(log, "val_mae", patience, phase=None)
    return stops.join(RN.best_checkpoint(log, stops, "val_mae", phase=None), "run_id", "left")


def load_weights(spark: SparkSession, state_dir: str, run_id: str, epoch: int, dim: int = DIM):
    """Weights of one checkpoint as a (1 x buckets) array."""
    theta = np.zeros((1, dim + 1))
    own = spark.read.parquet(f"{state_dir}/weights").filter((F.col("epoch") == epoch) & (F.col("run_id") == run_id))
    for r in own.select("bucket", "weight").collect():
        theta[0, r["bucket"]] = r["weight"]
    return theta


def score_epoch_model(features: DataFrame, theta, *keep: str) -> DataFrame:
    """``keep`` columns and ``score`` of rows with ``idx`` and ``val``."""
    kinds = ", ".join(f"`{c}` {features.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            row, idx, val, _ = flat(b)
            p = predictions(theta, row, idx, val, b.num_rows)[0]
            yield pa.RecordBatch.from_arrays([*[b.column(3 + k) for k in range(len(keep))], pa.array(p)], names=[*keep, "score"])

    return features.select(F.lit(0.0).alias("_y"), "idx", "val", *keep).mapInArrow(run, f"{kinds}, score double")


def test_of_best(spark: SparkSession, parts_path: str, state_dir: str, log: DataFrame, dim: int = DIM,
                 patience: int = TRAINING.patience) -> DataFrame:
    """Per run: stop and best epoch, its val_mae, and on the test rows the MAE of that checkpoint and of the training mean."""
    best = best_checkpoints(log, patience)
    picked = [r for r in best.select("run_id", "best_epoch").collect() if r["best_epoch"] is not None]  # one row a run
    parts = spark.read.schema(PARTS).parquet(parts_path)
    test = parts.filter(F.col("part") == "test")
    mean = parts.filter(~F.col("part").isin("val", "test")).select(F.avg("y")).scalar()
    tested = None
    for r in picked:
        scored = score_epoch_model(test, load_weights(spark, state_dir, r["run_id"], r["best_epoch"], dim), "y")
        one = scored.agg(F.lit(r["run_id"]).alias("run_id"), F.avg(F.abs(F.col("score") - F.col("y"))).alias("test_mae"),
                         F.avg(F.abs(mean - F.col("y"))).alias("mean_mae"), F.count("*").alias("n_test"))
        tested = one if tested is None else tested.union(one)
    if tested is None:
        tested = spark.createDataFrame([], "run_id string, test_mae double, mean_mae double, n_test long")
    return best.join(tested, "run_id", "left")
