import math

import pytest
from pyspark.sql import functions as F

from tidemill.operators import metrics
from tidemill.plans import jobs


def pairs(spark, rows):
    return spark.createDataFrame(rows, "actual DOUBLE, predicted DOUBLE")


def test_known_metrics(spark):
    row = metrics.forecast_metrics(pairs(spark, [(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)])).first()
    assert (row.n, row.mae, row.mse, row.r2) == (3, pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(0.5))
    assert row.rmse == pytest.approx(math.sqrt(1 / 3)) and row.mape == pytest.approx(100 / 9)


def test_missing_pairs_do_not_count(spark):
    row = metrics.forecast_metrics(pairs(spark, [(1.0, 1.0), (None, 2.0), (3.0, None), (float("nan"), 1.0)])).first()
    assert (row.n, row.mae, row.r2) == (1, 0.0, None)
    row = metrics.forecast_metrics(pairs(spark, [(None, 1.0), (2.0, float("nan"))])).first()
    assert tuple(row) == (0, None, None, None, None, None)


def test_constant_truth(spark):
    flat = pairs(spark, [(5.0, 5.0), (5.0, 5.0)])
    assert metrics.forecast_metrics(flat).first().r2 == 1.0
    assert metrics.forecast_metrics(flat, r2_rule="sequence").first().r2 == 0.0
    assert metrics.forecast_metrics(pairs(spark, [(5.0, 5.0), (5.0, 6.0)])).first().r2 == 0.0
    with pytest.raises(ValueError):
        metrics.forecast_metrics(flat, r2_rule="other")


def test_zero_truth(spark):
    assert metrics.forecast_metrics(pairs(spark, [(0.0, 1.0), (1.0, 1.0)])).first().mape == float("inf")
    assert math.isnan(metrics.forecast_metrics(pairs(spark, [(0.0, 0.0), (1.0, 1.0)])).first().mape)
    rows = metrics.point_error(pairs(spark, [(0.0, 1.0), (2.0, 1.0), (2.0, None)])).collect()
    assert [tuple(r)[2:] for r in rows] == [(1.0, float("inf")), (1.0, 50.0), (None, None)]


def test_r2_of_large_offsets(spark):
    base = 1e9
    row = metrics.forecast_metrics(pairs(spark, [(base + i, base + i + (i % 2)) for i in range(1000)])).first()
    assert row.r2 == pytest.approx(1 - 500 / sum((i - 499.5) ** 2 for i in range(1000)), rel=1e-6)


def test_sequence_metrics(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0, 3.0], [1.0, 2.0, 4.0]), (2, [1.0, 2.0, 3.0], [1.0, 3.0]), (3, [1.0], []), (4, [5.0, 5.0], [5.0, 5.0])],
        "i INT, truth ARRAY<DOUBLE>, sequence ARRAY<DOUBLE>",
    )
    out = metrics.sequence_metrics(df)
    rows = [tuple(r)[3:] for r in out.orderBy("i").collect()]
    assert rows[0] == (pytest.approx(1 / 3), pytest.approx(math.sqrt(1 / 3)), pytest.approx(0.5))
    assert rows[1] == (0.5, pytest.approx(math.sqrt(0.5)), pytest.approx(-1.0))
    assert rows[2] == (None, None, None) and rows[3] == (0.0, 0.0, 0.0)
    macro = metrics.macro_average(out).first()
    assert (macro.n_total, macro.n_valid, macro.success_rate) == (4, 3, 0.75)
    assert macro.mae == pytest.approx((1 / 3 + 0.5 + 0.0) / 3)


def test_segments(spark):
    truth = [float(i) for i in range(96)]
    df = spark.createDataFrame([(truth, [t + (1.0 if i >= 64 else 0.0) for i, t in enumerate(truth)])], "truth ARRAY<DOUBLE>, sequence ARRAY<DOUBLE>")
    rows = metrics.segment_metrics(df).orderBy("segment").collect()
    assert [(r.segment, r.n, r.mae) for r in rows] == [(0, 32, 0.0), (1, 32, 0.0), (2, 32, 1.0)]


def test_histogram_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    errors = rng.normal(size=500).round(3)
    df = pairs(spark, [(0.0, float(e)) for e in errors] + [(0.0, None)])
    rows = metrics.error_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(errors, bins=30)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = metrics.error_histogram(pairs(spark, [(1.0, 2.0)] * 4), 3).orderBy("bin").collect()
    assert [(r.low, r.n) for r in flat] == [(0.5, 0), (pytest.approx(0.5 + 1 / 3), 4), (pytest.approx(0.5 + 2 / 3), 0)]
    assert metrics.error_histogram(pairs(spark, [(1.0, None)])).count() == 0


@pytest.mark.parametrize("strategy", ["plain", "ranged"])
def test_box(spark, strategy):
    errors = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 30.0, -20.0]
    row = metrics.box_summary(pairs(spark, [(0.0, e) for e in errors]), strategy=strategy).first()
    assert (row.q1, row.median, row.q3) == (2.25, 4.5, 6.75)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 8.0, 2)


def test_bands(spark):
    df = pairs(spark, [(0.0, e) for e in (0.05, -0.05, 0.1, 0.3, 0.31)])
    assert {r.band: r.n for r in metrics.error_bands(df).collect()} == {"excellent": 2, "good": 1, "poor": 1, "beyond": 1}


def test_unknown_errors_are_in_no_band(spark):
    df = pairs(spark, [(0.0, 0.05), (0.0, 9.0), (1.0, None), (None, 1.0), (None, None), (0.0, float("nan"))])
    assert {r.band: r.n for r in metrics.error_bands(df).collect()} == {"excellent": 1, "beyond": 1}


def test_evaluate_job(spark, tmp_path):
    df = spark.range(300).select(
        F.col("id").alias("index"), F.col("id").cast("double").alias("actual"), (F.col("id") + F.col("id") % 3).cast("double").alias("predicted")
    )
    reports = jobs.evaluate(df)
    assert reports["metrics"].first().mae == 1.0 and reports["sample"].count() == 100
    assert reports["range"].first() == (0.0, 299.0)
    jobs.write_evaluation(reports, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/metrics").first()
    assert float(back.mae) == 1.0
