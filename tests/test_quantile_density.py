"""E9 median by selection, E16 density from binned moments."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloop.operators import evaluate as EV
from scoreloop.operators import quantile as Q

CASES = {"odd": [3.0, 1.0, 2.0], "even": [1.0, 2.0, 3.0, 10.0], "one": [5.0], "ties": [0.5] * 50 + [1.0] * 50, "ties odd": [0.0] * 5 + [7.0] * 6,
         "wide": [1e308, -1e308, 1.0, -1.0], "tiny": [5e-324, 0.0, 1e-323, 1e300], "neighbours": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0)],
         "infinite": [math.inf, -math.inf, 3.0, 4.0, math.inf], "mostly infinite": [math.inf] * 4 + [1.0]}


@pytest.mark.parametrize("name", list(CASES))
@pytest.mark.parametrize("bins", [2, 1024])
def test_median(spark, monkeypatch, name, bins):
    monkeypatch.setattr(Q.select_rank, "__defaults__", (None, bins))
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(3)
    assert Q.exact_median(df, "v") == statistics.median(values)


def test_median_of_many(spark):
    rnd = random.Random(1)
    values = [rnd.gauss(0, 1) * 10 ** rnd.randint(-8, 8) for _ in range(5001)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert Q.exact_median(df, "v") == statistics.median(values)
    assert Q.exact_median(df.filter(F.col("v") < values[0]), F.col("v") * 2) == 2 * statistics.median([v for v in values if v < values[0]])
    assert Q.exact_median(df.limit(0), "v") is None


def test_hermite_polynomials():
    for k in range(EV.DENSITY_TERMS):
        assert np.allclose(np.polynomial.hermite_e.herme2poly([0] * k + [1]), EV.hermite(k))


@pytest.mark.parametrize("shape", ["normal", "two values", "outlier", "even"])
def test_density_against_every_residual(spark, shape):
    rng = np.random.default_rng(4)
    r = {"normal": rng.normal(0, 0.3, 3000), "two values": np.repeat([0.0, 1.0], [900, 100]), "outlier": np.append(rng.normal(0, 0.01, 500), 1000.0),
         "even": np.linspace(-1, 1, 777)}[shape]
    df = spark.createDataFrame([(float(v), 0.0) for v in r], "y_true double, y_pred double")
    h = np.std(r, ddof=1) * len(r) ** -0.2
    grid = np.linspace(r.min(), r.max(), 200)
    want = np.exp(-((grid[:, None] - r) / h) ** 2 / 2).sum(axis=1) / (len(r) * h * math.sqrt(2 * math.pi))
    got = {x.grid_index: x.density for x in EV.residual_density(df).collect()}
    assert len(got) == 200 and all(abs(got[k] - want[k]) <= 6e-7 + 1e-9 * want[k] for k in range(200))


def test_density_makes_no_row_per_residual(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("y_true"), F.lit(0.5).alias("y_pred"))
    plan = EV.residual_density(df)._jdf.queryExecution().optimizedPlan().toString()
    generate = plan[plan.index("Generate explode"):]
    assert "Aggregate [bin" in generate  # the explode stands above the bins
