"""Evaluation: stored metric goldens, band ends, histogram, density."""

import math

import numpy as np

from scoreloop.operators import evaluate as EV

SCHEMA = "id long, y_true double, y_pred double"


def bands(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["range"]: r for r in EV.band_metrics(df).collect()}


def test_v4_stored_band_metrics_rebuild(spark):
    # 50 negatives in the low band; 79 positives: 44 mid, 35 high
    rows = [(i, 0.0, 0.1) for i in range(50)] + [(100 + i, 1.0, 0.5) for i in range(44)] + \
           [(200 + i, 1.0, 0.9) for i in range(35)]
    b = bands(spark, rows)
    assert (b["0.00-0.35"]["precision"], b["0.00-0.35"]["recall"]) == (0.0, 0.0)
    assert (b["0.00-0.35"]["false_positives"], b["0.00-0.35"]["false_negatives"]) == (50, 79)
    assert b["0.35-0.65"]["precision"] == 1.0 and abs(b["0.35-0.65"]["recall"] - 0.5569620253) < 1e-9
    assert (b["0.35-0.65"]["false_positives"], b["0.35-0.65"]["false_negatives"]) == (0, 35)
    assert abs(b["0.65-1.00"]["recall"] - 0.4430379747) < 1e-9
    assert b["0.65-1.00"]["false_negatives"] == 44


def test_band_ends_belong_to_two_bands_and_out_of_range_to_none(spark):
    b = bands(spark, [(1, 1.0, 0.35), (2, 1.0, 0.65), (3, 1.0, -0.1), (4, 1.0, 1.2)])
    assert b["0.00-0.35"]["true_positives"] == 1
    assert b["0.35-0.65"]["true_positives"] == 2
    assert b["0.65-1.00"]["true_positives"] == 1


def test_confusion_cells_sum_to_n(spark):
    from scoreloop.sources.fixtures import predictions

    p = predictions(spark, "/root/testdata/sf0.001")
    n = p.count()
    cm = EV.confusion_matrix(p).collect()
    for t in (0.3, 0.5, 0.7):
        assert sum(r["n"] for r in cm if r["threshold"] == t) == n


def test_histogram_max_in_last_bin_and_empty_bins(spark):
    rows = [(i, 1.0, 1.0 - v) for i, v in enumerate([0.0, 0.1, 0.1, 1.0])]
    h = EV.residual_histogram(spark.createDataFrame(rows, SCHEMA)).orderBy("bin").collect()
    assert len(h) == 30 and h[29]["n"] == 1 and h[0]["n"] == 1 and sum(r["n"] for r in h) == 4


def test_density_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    r = np.round(rng.normal(0, 0.3, 400), 3)
    rows = [(i, float(v), 0.0) for i, v in enumerate(r)]
    got = {x["grid_index"]: x["density"] for x in EV.residual_density(spark.createDataFrame(rows, SCHEMA)).collect()}
    h = r.std(ddof=1) * len(r) ** -0.2
    grid = np.linspace(r.min(), r.max(), 200)
    want = np.exp(-((grid[:, None] - r[None, :]) / h) ** 2 / 2).sum(1) / (len(r) * h * math.sqrt(2 * math.pi))
    assert len(got) == 200
    assert max(abs(got[k] - want[k]) for k in range(200)) < 2e-6


def test_regression_metrics_rmse_is_mse(spark):
    df = spark.createDataFrame([(1, 1.0, 0.5), (2, 0.0, 0.5)], SCHEMA)
    r = EV.regression_metrics(df, by=None).first()
    assert (r["mae"], r["mse"], r["ref_rmse"], r["rmse"]) == (0.5, 0.25, 0.25, 0.5)


def test_histogram_all_equal_is_one_bin(spark):
    rows = [(i, 1.0, 0.5) for i in range(5)]
    h = EV.residual_histogram(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["bin"], r["n"]) for r in h] == [(0, 5)]
