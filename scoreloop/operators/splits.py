"""Repeatable order, splits, batches and leak checks.

Order comes from a seeded hash of the key, so it does not depend on
partitioning. ``split_bucket`` needs no sort at all (the scalable default);
``split_exact`` reproduces exact floor() sizes with a distributed rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloop.config import TRAINING
from scoreloop.operators.sizing import global_rank


def seeded_key(key: str = "id", seed: int = TRAINING.seed) -> Column:
    """32-bit order key: first 8 hex digits of md5('<seed>:<key>')."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")


def sample_head(df: DataFrame, cols=("text", "model_score", "user_feedback", "target_score"),
                n: int = 5) -> DataFrame:
    """G1: the first n rows in time order (a top-k, not a full sort)."""
    return df.orderBy(F.col("event_timestamp").asc_nulls_last(), F.col("id").asc()).limit(n).select("id", *cols)


def seeded_shuffle(df: DataFrame, key: str = "id", seed: int = TRAINING.seed) -> DataFrame:
    """Rows with their seeded key and 1-based position in the shuffled order."""
    k = df.withColumn("shuffle_key", seeded_key(key, seed))
    return global_rank(k, [F.col("shuffle_key"), F.col(key)], "shuffle_rank")


def split_exact(df: DataFrame, key: str = "id", seed: int = TRAINING.seed,
                train_ratio: float = TRAINING.train_ratio, two_way: bool = False) -> DataFrame:
    """G3 exact: train = floor(r n), validation = floor(rest / 2), test = the rest,
    by rank in the seeded order; ``two_way``: train and test only (80/20, 85/15 ...)."""
    ranked = seeded_shuffle(df, key, seed)
    n = ranked.select(F.count("*")).scalar()   # reads the checkpointed ranking
    n_train = F.floor(n * F.lit(train_ratio))
    n_val = F.lit(0).cast("long") if two_way else F.floor((n - n_train) / 2)
    split = (F.when(F.col("shuffle_rank") <= n_train, "train")
             .when(F.col("shuffle_rank") <= n_train + n_val, "val").otherwise("test"))
    offset = (F.when(F.col("split") == "train", F.lit(0)).when(F.col("split") == "val", n_train)
              .otherwise(n_train + n_val))
    return ranked.withColumn("split", split).withColumn(
        "rank_in_split", (F.col("shuffle_rank") - offset).cast("long"))


def split_bucket(df: DataFrame, key: str = "id", seed: int = TRAINING.seed,
                 train_ratio: float = TRAINING.train_ratio, val_ratio: float = TRAINING.val_ratio) -> DataFrame:
    """G3 at scale: assign by the seeded key's position in [0, 2^32); no sort, no count."""
    k = seeded_key(key, seed)
    span = float(2 ** 32)
    return df.withColumn("split", F.when(k < F.lit(train_ratio * span), "train")
                         .when(k < F.lit((train_ratio + val_ratio) * span), "val").otherwise("test"))


def batch_plan(split_df: DataFrame, batch_size: int = TRAINING.batch_size) -> DataFrame:
    """Batch number = floor((rank in split - 1) / size); sizes per split."""
    b = split_df.withColumn("batch", F.floor((F.col("rank_in_split") - 1) / batch_size).cast("long"))
    per_batch = b.groupBy("split", "batch").agg(F.count("*").cast("long").alias("size"))
    return per_batch.groupBy("split").agg(
        F.sum("size").cast("long").alias("n_rows"),
        F.count("*").cast("long").alias("n_batches"),
        F.max_by("size", "batch").alias("last_batch_size"))


def split_leak(a: DataFrame, b: DataFrame, key: str = "text_hash") -> DataFrame:
    """H1: how much of set b also occurs in set a, by key: one grouping of both
    sets counts each key's rows in either; rows of b without a key are clean."""
    both = (a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
            .union(b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))))
    k = both.groupBy(key).agg(F.sum("in_a").alias("na"), F.sum("in_b").alias("nb"))
    known = F.col(key).isNotNull()
    in_a, in_b = known & (F.col("na") > 0), known & (F.col("nb") > 0)
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("nb"))), F.lit(0)).cast("long")
    return k.agg(F.count_if(in_a & in_b).cast("long").alias("overlap_keys"), total(in_a).alias("rows_leaked"),
                 total(~in_a).alias("rows_clean"), F.count_if(in_a).cast("long").alias("keys_a"),
                 F.count_if(in_b).cast("long").alias("keys_b"))
