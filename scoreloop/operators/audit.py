"""Dataset audit and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloop.config import TRAINING
from scoreloop.functions import scalars as S
from scoreloop.functions import tokens as TK

# Dataset figures carried into a model run.
LINEAGE_METRICS = ("num_rows", "label_mean", "label_std", "label_min", "label_max")


def row_hash(*cols: str) -> Column:
    """First 60 bits of md5 over the row's values as a number. Every value goes in with
    its length ("3:abc"), a null as "-", so different rows never spell the same text."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in cols]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("long")


def fingerprint_agg(*cols: str) -> Column:
    """Order-free fingerprint: sum of row hashes as decimal(38,0), shown as text."""
    return F.sum(row_hash(*cols).cast("decimal(28,0)")).cast("decimal(38,0)").cast("string")


def table_fingerprint(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """A6 at table scale: a fingerprint that does not depend on row order or
    partitioning (partial sums combine map-side)."""
    aggs = [F.count("*").cast("long").alias("num_rows"), fingerprint_agg(*cols).alias("fingerprint")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def audit_basic(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Rows, missing texts, missing labels."""
    return df.agg(F.count("*").cast("long").alias("num_rows"),
                  F.count_if(F.col(text).isNull()).cast("long").alias("num_null_text"),
                  F.count_if(S.is_missing(F.col(label).cast("double"))).cast("long").alias("num_null_labels"))


def audit_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Label mean, sample std, min, max, median (missing labels skipped). The median is
    selected in passes of bounded state (``operators.quantile``), not sorted in one task."""
    from scoreloop.operators.quantile import exact_median

    x = F.when(~F.isnan(F.col(label).cast("double")), F.col(label).cast("double"))
    return df.agg(F.round(F.avg(x), 6).alias("label_mean"),
                  F.round(F.stddev_samp(x), 6).alias("label_std"),
                  F.round(F.min(x), 6).alias("label_min"),
                  F.round(F.max(x), 6).alias("label_max"),
                  F.round(F.lit(exact_median(df, x)).cast("double"), 6).alias("label_median"))


def audit_tokens(df: DataFrame, text: str = "text", max_tokens: int = TRAINING.max_tokens,
                 exact: bool = True) -> DataFrame:
    """Token-length mean, population std, p95, p99 (exact, linear
    interpolation; token lengths are integers, so the exact percentile
    holds one counter per distinct length), max, share above max_tokens.
    """
    n = TK.token_length(S.text_or_nan(text))
    pct = ((lambda p: F.percentile(F.col("n"), p)) if exact
           else (lambda p: F.percentile_approx(F.col("n"), p, 10000)))
    return df.select(n.alias("n")).agg(
        F.round(F.avg("n"), 6).alias("token_len_mean"),
        F.round(F.stddev_pop("n"), 6).alias("token_len_std"),
        F.round(pct(0.95).cast("double"), 6).alias("token_len_p95"),
        F.round(pct(0.99).cast("double"), 6).alias("token_len_p99"),
        F.max("n").cast("long").alias("token_len_max"),
        F.round(F.avg((F.col("n") > max_tokens).cast("double")), 6).alias("pct_truncated"),
    )


def dataset_run_stats(training: DataFrame, by: str = "source", text: str = "text",
                      label: str = "label") -> DataFrame:
    """Audited dataset runs: id, checksum (order-free fingerprint), label figures."""
    x = F.when(~F.isnan(F.col(label)), F.col(label))
    return training.groupBy(F.col(by).alias("dataset_run_id")).agg(
        fingerprint_agg(text, label).alias("dataset_checksum"),
        F.count("*").cast("double").alias("num_rows"),
        F.avg(x).alias("label_mean"),
        F.stddev_samp(x).alias("label_std"),
        F.min(x).alias("label_min"),
        F.max(x).alias("label_max"),
    )


def lineage_join(model_runs: DataFrame, dataset_runs: DataFrame) -> DataFrame:
    """Attach the dataset run's metrics to each model run as
    ``dataset_<metric>`` params; absent metrics are left out, a missing
    dataset run gives an empty map. Dataset runs are one row per dataset
    (small, but sized by the planner/AQE, not assumed)."""
    ds = dataset_runs.select("dataset_run_id", *LINEAGE_METRICS)
    j = model_runs.join(ds, "dataset_run_id", "left")
    m = F.map_from_arrays(F.array(*[F.lit(f"dataset_{k}") for k in LINEAGE_METRICS]),
                          F.array(*[F.col(k).cast("double") for k in LINEAGE_METRICS]))
    return j.select("run_id", "dataset_run_id",
                    F.map_filter(m, lambda k, v: v.isNotNull()).alias("params"))


def lineage_check(model_runs: DataFrame, dataset_runs: DataFrame) -> DataFrame:
    """D3: declared checksum against the audited one: match / mismatch / missing."""
    ds = dataset_runs.select("dataset_run_id", F.col("dataset_checksum").alias("audited_checksum"))
    j = model_runs.join(ds, "dataset_run_id", "left")
    status = (F.when(F.col("audited_checksum").isNull(), "missing")
              .when(F.col("dataset_checksum").eqNullSafe(F.col("audited_checksum")), "match")
              .otherwise("mismatch"))
    return j.select("run_id", "dataset_run_id", F.col("dataset_checksum").alias("declared_checksum"),
                    "audited_checksum", status.alias("status"))
