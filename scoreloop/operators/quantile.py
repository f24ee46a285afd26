"""Exact order statistics by distributed selection.

A pass counts the values of an interval in ``BINS`` equal parts, with each part's least and largest value;
the part that holds the wanted rank is the next interval. Every pass brings at most ``BINS`` small rows to the
driver, whatever the input; the passes end when a part holds one value (again and again the same
number, or neighbouring floating-point numbers), after a handful of passes for ordinary data.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloop.operators.sizing import materialize

BINS = 1024


def select_rank(values: DataFrame, rank: int, stats=None, bins: int = BINS) -> float:
    """The value of 0-based ``rank`` among the finite doubles of the column ``x``."""
    x = F.col("x")
    lo, hi = stats or values.agg(F.min(x), F.max(x)).first()
    while lo < hi:
        # halves first: the width of the whole range of doubles is no double
        width = (hi / 2 - lo / 2) / bins * 2
        part = F.least(F.floor((x / 2 - F.lit(lo / 2)) / F.lit(width / 2)), F.lit(bins - 1)) if width > 0 else F.when(x == F.lit(lo), 0).otherwise(1)
        inside = values.filter((x >= F.lit(lo)) & (x <= F.lit(hi)))
        counts = inside.groupBy(part.cast("int").alias("part")).agg(F.count("*").alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect()
        for r in sorted(counts, key=lambda r: r["lo"]):
            if rank < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


def exact_median(df: DataFrame, value) -> float | None:
    """Median of a column (nulls and NaN left out; of an even number the mean of the middle two); None without values."""
    c = (F.col(value) if isinstance(value, str) else value).cast("double")
    values = materialize(df.select(c.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x")))
    inf = F.lit(math.inf)
    n, low, high, lo, hi = values.agg(F.count("*"), F.count_if(F.col("x") == -inf), F.count_if(F.col("x") == inf),
                                      F.min(F.when(F.abs("x") != inf, F.col("x"))), F.max(F.when(F.abs("x") != inf, F.col("x")))).first()
    finite = values.filter(F.abs("x") != inf)

    def at(k):
        return -math.inf if k < low else math.inf if k >= n - high else select_rank(finite, k - low, (lo, hi))

    if not n:
        return None
    first = at((n - 1) // 2)
    if n % 2:
        return first
    second = at(n // 2)
    return (first + second) / 2 if abs(first + second) < math.inf else first / 2 + second / 2
