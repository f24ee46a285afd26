"""Model evaluation over a predictions table.

Global metrics are single-pass conditional aggregates (map-side partial
aggregation, one tiny final task), not joins against threshold tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloop.config import BANDS
from scoreloop.functions import scalars as S
from scoreloop.functions import tokens as TK


def _actual(y_true: str = "y_true", cut: float = BANDS.actual_cut) -> Column:
    # numpy: NaN >= cut is False
    return F.coalesce((F.col(y_true) >= cut) & ~F.isnan(y_true), F.lit(False))


def _pred_at(t: float, y_pred: str = "y_pred") -> Column:
    return F.coalesce((F.col(y_pred) >= t) & ~F.isnan(y_pred), F.lit(False))


def regression_metrics(pred: DataFrame, by: str | None = "model_version") -> DataFrame:
    """MAE, MSE, the reference's "RMSE" (which is the MSE) and the true RMSE."""
    err = S.residual()
    aggs = [F.count("*").cast("long").alias("n"),
            F.avg(F.abs(err)).alias("mae"),
            F.avg(err * err).alias("mse")]
    g = pred.groupBy(by).agg(*aggs) if by else pred.agg(*aggs)
    keys = [by] if by else []
    return g.select(*keys, "n", F.round("mae", 6).alias("mae"), F.round("mse", 6).alias("mse"),
                    F.round(F.sqrt("mse"), 6).alias("rmse"), F.round("mse", 6).alias("ref_rmse"))


def confusion_matrix(pred: DataFrame, thresholds=BANDS.confusion_thresholds) -> DataFrame:
    """Cells (threshold, actual, predicted, n); actual = y_true >= 0.5,
    predicted = y_pred >= threshold. All 4 cells per threshold, zeros included."""
    cells = [(t, a, p) for t in thresholds for a in (0, 1) for p in (0, 1)]
    act = _actual()
    aggs = []
    for i, (t, a, p) in enumerate(cells):
        ca = act if a else ~act
        cp = _pred_at(t) if p else ~_pred_at(t)
        aggs.append(F.count_if(ca & cp).cast("long").alias(f"c{i}"))
    wide = pred.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(a).alias("actual"),
                             F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n"))
                    for i, (t, a, p) in enumerate(cells)])
    return wide.select(F.inline(arr))


def _band_ranges():
    edges = [0.0, BANDS.low, BANDS.high, 1.0]
    return [(edges[i], edges[i + 1]) for i in range(3)]


def band_metrics(pred: DataFrame) -> DataFrame:
    """Per band (closed at both ends) precision, recall, FP, FN;
    0 where undefined. Positive = y_true >= 0.5."""
    act = _actual()
    aggs = []
    for i, (lo, hi) in enumerate(_band_ranges()):
        inb = F.coalesce(F.col("y_pred").between(lo, hi) & ~F.isnan("y_pred"), F.lit(False))
        aggs += [F.count_if(inb & act).alias(f"tp{i}"), F.count_if(inb & ~act).alias(f"fp{i}"),
                 F.count_if(~inb & act).alias(f"fn{i}")]
    wide = pred.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(f"{lo:.2f}-{hi:.2f}").alias("range"),
                             F.col(f"tp{i}").cast("long").alias("tp"),
                             F.col(f"fp{i}").cast("long").alias("fp"),
                             F.col(f"fn{i}").cast("long").alias("fn"))
                    for i, (lo, hi) in enumerate(_band_ranges())])
    long = wide.select(F.inline(arr))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    return long.select("range", F.round(prec, 9).alias("precision"), F.round(rec, 9).alias("recall"),
                       F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives"),
                       F.col("tp").alias("true_positives"))


def residual_histogram(pred: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max residual; the maximum falls
    in the last bin; all-equal residuals make one bin. Empty bins are kept."""
    r = pred.select(S.residual().alias("r")).filter(F.col("r").isNotNull() & ~F.isnan("r"))
    stats = r.agg(F.min("r").alias("lo"), F.max("r").alias("hi"))
    st = stats.select(F.struct("lo", "hi")).scalar()   # one subquery for both
    lo, hi = st["lo"], st["hi"]
    w = (hi - lo) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("r") - lo) / w), F.lit(bins - 1))).cast("int")
    counts = r.groupBy(b.alias("bin")).agg(F.count("*").cast("long").alias("n"))
    # the bin grid is derived from the data's own extent (empty data: no bins)
    last = F.when(w == 0, F.lit(0)).otherwise(F.lit(bins - 1))
    grid = stats.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", F.round(lo + F.col("bin") * w, 9).alias("bin_lo"),
                    F.round(lo + (F.col("bin") + 1) * w, 9).alias("bin_hi"),
                    F.coalesce("n", F.lit(0).cast("long")).alias("n")))


#: Bins a bandwidth, and terms of the series that carries a bin's residuals to the grid points.
DENSITY_BINS, DENSITY_TERMS = 4, 12


def hermite(k: int) -> list[int]:
    """Coefficients of the k-th Hermite polynomial (He), lowest power first."""
    a, b = [1], [0, 1]
    for n in range(1, k + 1):
        if n == k:
            return b
        a, b = b, [x - n * y for x, y in zip([0, *b], [*a, 0, 0])]
    return a


def residual_density(pred: DataFrame, grid_size: int = 200) -> DataFrame:
    """Gaussian kernel density of the residuals (Scott's bandwidth
    h = sample std * n^(-1/5)) on an even grid from min to max.

    Residuals are summed into bins of h / ``DENSITY_BINS``: a bin keeps the sums of d^k, d the distance from its middle in
    bandwidths (at most 1/8). exp(-(t - d)^2 / 2) = exp(-t^2 / 2) * sum of He_k(t) d^k / k!, so the bins alone give the
    density, with a relative error below 1e-12 near the residuals; no residual becomes a row again.
    A bin only reaches grid points within 40 h: beyond that the kernel is exactly 0.0
    in double precision. Points that no bin reaches have density 0.
    """
    r = pred.select(S.residual().alias("r")).filter(F.col("r").isNotNull() & ~F.isnan("r"))
    stats = r.agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.count("*").alias("n"),
                  F.stddev_samp("r").alias("sd"))
    st = stats.select(F.struct("lo", "hi", "n", "sd")).scalar()   # one subquery for all four
    lo, hi, n, sd = (st[c] for c in ("lo", "hi", "n", "sd"))
    h = sd * F.pow(n.cast("double"), F.lit(-0.2))
    step = (hi - lo) / (grid_size - 1)
    middle = lo + (F.col("bin") + 0.5) * h / DENSITY_BINS
    d = (F.col("r") - middle) / h
    bins = (r.filter((h > 0) & (step > 0)).select("r", F.floor((F.col("r") - lo) / h * DENSITY_BINS).alias("bin")).select("bin", d.alias("d"))
            .groupBy("bin").agg(*[F.sum(F.pow("d", F.lit(float(k))) if k else F.lit(1.0)).alias(f"m{k}") for k in range(DENSITY_TERMS)]))
    reach = F.lit(40.0) * h
    k_lo = F.greatest(F.ceil((F.col("c") - reach - lo) / step), F.lit(0)).cast("int")
    k_hi = F.least(F.floor((F.col("c") + reach - lo) / step), F.lit(grid_size - 1)).cast("int")
    near = bins.withColumn("c", middle).withColumn("k", F.explode(F.sequence(k_lo, k_hi))).withColumn("t", (lo + F.col("k") * step - F.col("c")) / h)
    # one power series in t: the coefficient of t^j adds up over all terms
    by_power = [[(k, hermite(k)[j]) for k in range(DENSITY_TERMS) if j < len(hermite(k)) and hermite(k)[j]] for j in range(DENSITY_TERMS)]
    series = F.lit(0.0)
    for terms in reversed(by_power):
        here = F.lit(0.0)
        for k, c in terms:
            here = here + F.col(f"m{k}") * (c / math.factorial(k))
        series = series * F.col("t") + here
    sums = near.groupBy("k").agg(F.sum(F.exp(-(F.col("t") * F.col("t")) / 2) * series).alias("s"))
    grid = pred.sparkSession.range(grid_size).select(F.col("id").cast("int").alias("k")).filter((h > 0) & (step > 0))
    norm = n.cast("double") * h * F.lit(math.sqrt(2 * math.pi))
    return grid.join(sums, "k", "left").select(
        F.col("k").alias("grid_index"), F.round(lo + F.col("k") * step, 9).alias("x"),
        F.round(F.coalesce("s", F.lit(0.0)) / norm, 6).alias("density"))


def calibration(pred: DataFrame, bins: int = 10) -> DataFrame:
    """Reliability bins: mean prediction vs mean actual per prediction decile."""
    ok = pred.filter(~S.is_missing("y_pred") & ~S.is_missing("y_true"))
    b = F.least(F.floor(F.col("y_pred") * bins), F.lit(bins - 1)).cast("int")
    return ok.groupBy(b.alias("bin")).agg(
        F.count("*").cast("long").alias("n"),
        F.round(F.avg("y_pred"), 6).alias("mean_pred"),
        F.round(F.avg("y_true"), 6).alias("mean_actual"))


def calibration_points(pred: DataFrame) -> DataFrame:
    """The scatter's points (prediction, actual)."""
    return pred.select("id", F.col("y_pred").alias("predicted"), F.col("y_true").alias("actual"))


def error_by_length(pred: DataFrame, bin_width: int = 100, length: str | None = None) -> DataFrame:
    """Absolute error by length of the text kept after truncation (``length``: a column that has it already,
    measured once per document instead of once per prediction)."""
    n = TK.truncated_length("text") if length is None else F.col(length)
    x = pred.select(n.alias("len"), S.abs_error().alias("err"))
    return x.groupBy((F.floor(F.col("len") / bin_width) * bin_width).cast("long").alias("length_bin")).agg(
        F.count("*").cast("long").alias("n"),
        F.round(F.avg("err"), 6).alias("mean_error"),
        F.round(F.max("err"), 6).alias("max_error"))
