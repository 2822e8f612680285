"""Queries over forecasts and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import (
    COMPLETIONS, KEYS, ORDER, POSITIONS, PREDICTIONS, SEQUENCES, TEXT_TIME, completions, predictions, r6, rounded, sequences, series, table,
)
from tidemill.functions import parsing as parse
from tidemill.functions.text import fmt4
from tidemill.operators import completions as ops, metrics, windows
from tidemill.plans import jobs
from tidemill.sources import io
from tidemill.streaming import telemetry

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


VALID = f"SELECT *, predicted - actual AS e FROM ({PREDICTIONS}) WHERE predicted IS NOT NULL AND actual IS NOT NULL"


@query(f"""SELECT k, count(*) AS n, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / (count(*) * var_pop(actual)), 6) AS r2, round(avg(abs(e / actual)) * 100, 6) AS mape FROM ({VALID}) GROUP BY k""")
def forecast_metrics(spark, d):
    return rounded(metrics.forecast_metrics(predictions(spark, d), ["k"]), "mae", "mse", "rmse", "r2", "mape")


@query(f"""SELECT count(*) AS n, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / (count(*) * var_pop(actual)), 6) AS r2, round(avg(abs(e / actual)) * 100, 6) AS mape FROM ({VALID})""")
def forecast_metrics_all(spark, d):
    return rounded(metrics.forecast_metrics(predictions(spark, d)), "mae", "mse", "rmse", "r2", "mape")


_ELEMENTS = f"""SELECT sample_idx, label, unnest(range(1, len(parsed) + 1)) AS i, unnest(parsed) AS p,
  unnest(list_slice(parsed_truth, 1, len(parsed))) AS t FROM ({SEQUENCES}) WHERE len(parsed) > 0"""
_PER_SAMPLE = f"""SELECT sample_idx, avg(abs(t - p)) AS mae, sqrt(avg((t - p) * (t - p))) AS rmse,
  CASE WHEN var_pop(t) = 0 THEN 0 ELSE 1 - sum((t - p) * (t - p)) / (count(*) * var_pop(t)) END AS r2 FROM ({_ELEMENTS}) GROUP BY sample_idx"""


def _parsed(spark, d):
    read = lambda c: parse.forecast_sequence(F.col(c), 64, 60, 60, 70)
    rows = ops.parse_completions(sequences(spark, d), "content", 64, 60, 60, 70)
    return rows.withColumn("truth", metrics.truth_or_targets(read("output"), F.col("target_values")))


@query(f"""SELECT s.sample_idx, CAST(64 AS INTEGER) AS input_length, CAST(64 AS INTEGER) AS true_length, CAST(len(s.parsed) AS INTEGER) AS pred_length,
  left(s.content, 500) AS response_preview, round(m.mae, 6) AS mae, round(m.rmse, 6) AS rmse, round(m.r2, 6) AS r2
FROM ({SEQUENCES}) s LEFT JOIN ({_PER_SAMPLE}) m USING (sample_idx)""")
def sequence_metrics(spark, d):
    return rounded(metrics.sample_results(_parsed(spark, d)), "mae", "rmse", "r2")


@query(f"""SELECT count(*) AS n_total, count(m.mae) AS n_valid, round(avg(m.mae), 6) AS mae, round(avg(m.rmse), 6) AS rmse,
  round(avg(m.r2), 6) AS r2, round(count(m.mae) / count(*), 6) AS success_rate
FROM ({SEQUENCES}) s LEFT JOIN ({_PER_SAMPLE}) m USING (sample_idx)""")
def macro_metrics(spark, d):
    macro = metrics.macro_average(metrics.sample_results(_parsed(spark, d)))
    return rounded(macro, "mae", "rmse", "r2", "success_rate")


@query(f"""SELECT label, CAST((i - 1) // 32 AS INTEGER) AS segment, count(*) AS n, round(avg(abs(p - t)), 6) AS mae, round(avg((p - t) * (p - t)), 6) AS mse,
  round(sqrt(avg((p - t) * (p - t))), 6) AS rmse,
  round(CASE WHEN var_pop(t) = 0 THEN 0 ELSE 1 - sum((p - t) * (p - t)) / (count(*) * var_pop(t)) END, 6) AS r2
FROM ({_ELEMENTS}) GROUP BY 1, 2""")
def segment_metrics(spark, d):
    out = metrics.segment_metrics(_parsed(spark, d), 32, ["label"]).drop("mape")
    return rounded(out, "mae", "mse", "rmse", "r2")


@query(f"""SELECT k, index, round(abs(predicted - actual), 6) AS error,
  round(CASE WHEN actual = 0 AND predicted IS NOT NULL THEN CAST('inf' AS DOUBLE) ELSE abs(predicted - actual) / abs(actual) * 100 END, 6) AS rel_error
FROM ({PREDICTIONS})""")
def point_error(spark, d):
    out = metrics.point_error(predictions(spark, d)).select("k", "index", "error", "rel_error")
    return rounded(out, "error", "rel_error")


@query(f"""WITH e AS ({VALID}), b AS (SELECT k, min(e) AS lo, max(e) AS hi FROM e GROUP BY k),
c AS (SELECT e.k, CAST(least(29, floor((e.e - b.lo) / (b.hi - b.lo) * 30)) AS INTEGER) AS bin, count(*) AS n FROM e JOIN b USING (k) GROUP BY 1, 2)
SELECT b.k, CAST(g.bin AS INTEGER) AS bin, round(b.lo + g.bin * ((b.hi - b.lo) / 30), 6) AS low,
  round(b.lo + (g.bin + 1) * ((b.hi - b.lo) / 30), 6) AS high, coalesce(c.n, 0) AS n
FROM b CROSS JOIN (SELECT unnest(range(0, 30)) AS bin) g LEFT JOIN c ON c.k = b.k AND c.bin = g.bin""")
def error_histogram(spark, d):
    return rounded(metrics.error_histogram(predictions(spark, d), keys=["k"]), "low", "high")


@query(f"""WITH e AS ({VALID}), q AS (SELECT k, quantile_cont(e, 0.25) AS q1, quantile_cont(e, 0.5) AS median, quantile_cont(e, 0.75) AS q3 FROM e GROUP BY k)
SELECT k, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(least(q1, min(e) FILTER (WHERE e >= q1 - 1.5 * (q3 - q1))), 6) AS whisker_low,
  round(greatest(q3, max(e) FILTER (WHERE e <= q3 + 1.5 * (q3 - q1))), 6) AS whisker_high,
  count(*) FILTER (WHERE e < q1 - 1.5 * (q3 - q1) OR e > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM e JOIN q USING (k) GROUP BY k, q1, median, q3""")
def box_summary(spark, d):
    out = metrics.box_summary(predictions(spark, d), ["k"])
    return rounded(out, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(SQL["box_summary"])
def box_sorted(spark, d):
    """The box of groups too big for the built-in: quartiles by rank selection, in several rounds."""
    out = metrics.box_summary(predictions(spark, d), ["k"], strategy="ranged")
    return rounded(out, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(f"SELECT k, min(actual) AS actual_min, max(actual) AS actual_max FROM ({PREDICTIONS}) GROUP BY k")
def actual_range(spark, d):
    return metrics.actual_range(predictions(spark, d), ["k"])


@query(f"""SELECT k, CASE WHEN abs(e) <= 5 THEN 'excellent' WHEN abs(e) <= 15 THEN 'good' WHEN abs(e) <= 30 THEN 'poor' ELSE 'beyond' END AS band,
  count(*) AS n FROM ({VALID}) GROUP BY 1, 2""")
def error_bands(spark, d):
    return metrics.error_bands(predictions(spark, d), {"excellent": 5, "good": 15, "poor": 30}, ["k"])


@query(f"""SELECT sample_id, generation_id, kind, text FROM (SELECT sample_id, generation_id, content, lang FROM ({COMPLETIONS}))
UNPIVOT (text FOR kind IN (content AS 'response', lang AS 'language'))""")
def text_artifacts(spark, d):
    return io.text_artifacts(completions(spark, d), ["sample_id", "generation_id"], {"response": "content", "language": "lang"})


def _long(report: str, names: str, place: str = "CAST(NULL AS INTEGER)") -> str:
    columns = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names.split())
    return f"""SELECT k, '{report}' AS report, CAST(bin AS INTEGER) AS bin, name, round(value, 6) AS value
FROM (SELECT k, {place} AS bin, {columns} FROM ({SQL[NAMES_OF[report]]})) UNPIVOT INCLUDE NULLS (value FOR name IN ({', '.join(names.split())}))"""


NAMES_OF = {"metrics": "forecast_metrics", "range": "actual_range", "box": "box_summary", "histogram": "error_histogram"}


@query("\nUNION ALL\n".join([
    _long("metrics", "n mae mse rmse r2 mape"), _long("range", "actual_min actual_max"),
    _long("box", "q1 median q3 whisker_low whisker_high n_outliers"), _long("histogram", "low high n", "bin"),
]))
def evaluate_job(spark, d):
    """All reports of one evaluation as one table."""
    return rounded(jobs.evaluation_table(jobs.evaluate(predictions(spark, d), ["k"]), ["k"]), "value")


FORECASTS = f"""SELECT k, pos AS index, value AS actual,
  CASE WHEN pos % 5 <> 4 AND pos % 3 <> 1 THEN CAST(printf('%.4f', last) AS DOUBLE) END AS predicted
FROM (SELECT *, lag(value) OVER (PARTITION BY k ORDER BY ts, id) AS last FROM ({POSITIONS})) WHERE pos >= 12"""


@query(SQL["evaluate_job"].replace(PREDICTIONS, FORECASTS))
def forecast_report(spark, d):
    """Windows, their completions (some absent, some without a number), parsed values and all reports in one job."""
    rolling = windows.rolling_frame(series(spark, d), 12, ORDER, KEYS)
    last, style = fmt4(F.element_at("input_values", -1)), F.col("index") % 3
    content = (
        F.when(style == 0, F.concat(F.lit("予測値: "), last)).when(style == 1, F.lit("わかりません"))
        .otherwise(F.concat(F.lit("about "), last, F.lit(" or 9")))
    )
    told = rolling.where("index % 5 <> 4").select("k", "index", content.alias("content"))
    return rounded(jobs.evaluation_table(jobs.forecast_report(rolling, told, ["k", "index"], KEYS), KEYS), "value")


# ---- telemetry ------------------------------------------------------------

@query("""SELECT k, count(*) AS n_measurements, max(sec) AS duration, arg_max(sec, (value, -sec)) AS peak_timestamp, max(value) AS peak_used_mb,
  round(max(value) / 500 * 100, 6) AS peak_usage_percent, round(avg(value), 6) AS mean_used_mb
FROM (SELECT event_type AS k, value, epoch_us(ts) / 1e6 AS sec FROM events) GROUP BY k""")
def telemetry_report(spark, d):
    out = telemetry.telemetry_report(_usage(spark, d), ["k"], "at", "value", "total")
    return rounded(out, "peak_usage_percent", "mean_used_mb")


def _usage(spark, d):
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return series(spark, d).select("k", "ts", "value", at.alias("at"), F.lit(500.0).alias("total"))


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS k, count(*) AS n_measurements,
  arg_max(epoch_us(ts) / 1e6, (value, -epoch_us(ts))) AS peak_timestamp, max(value) AS peak_used_mb, round(avg(value), 6) AS mean_used_mb
FROM events GROUP BY date_trunc('hour', ts), event_type""")
def telemetry_windows(spark, d):
    """The windowed report over a table; the same plan runs on a stream."""
    out = telemetry.telemetry_stream(_usage(spark, d), "ts", "1 hour", keys=["k"], used="value", total="total")
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return rounded(out.select(start, "k", "n_measurements", "peak_timestamp", "peak_used_mb", "mean_used_mb"), "mean_used_mb")
