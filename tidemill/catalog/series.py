"""Queries over series: quality, scaling, positions, windows, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import (
    GAPPY, KEYS, ORDER, POSITIONS, SCALED, SERIES, TEXT_TIME, TEXT_VALUE,
    gappy, joined, r6, rounded, series, table, windows_sql,
)
from tidemill.functions.text import time_text
from tidemill.operators import clean, profile, scale, split, windows
from tidemill.operators.index import series_index
from tidemill.plans import jobs

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL twin."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


# ---- quality and profiles -------------------------------------------------

@query(f"""SELECT 'k' AS "column", count(*) FILTER (WHERE k IS NULL) AS n_missing FROM ({GAPPY})
UNION ALL SELECT 'ts', count(*) FILTER (WHERE ts IS NULL) FROM ({GAPPY})
UNION ALL SELECT 'id', count(*) FILTER (WHERE id IS NULL) FROM ({GAPPY})
UNION ALL SELECT 'value', count(*) FILTER (WHERE value IS NULL) FROM ({GAPPY})""")
def null_report(spark, d):
    return profile.null_report(gappy(spark, d))


@query("""SELECT l_returnflag, 'l_quantity' AS "column", min(l_quantity) AS min, max(l_quantity) AS max,
  round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'l_extendedprice', min(l_extendedprice), max(l_extendedprice),
  round(avg(l_extendedprice), 6) FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'l_discount', min(l_discount), max(l_discount), round(avg(l_discount), 6) FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'l_tax', min(l_tax), max(l_tax), round(avg(l_tax), 6) FROM lineitem GROUP BY 1""")
def range_profile(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.range_profile(table(spark, d, "lineitem"), columns, ["l_returnflag"]), "mean")


@query(f"""SELECT k, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
  round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max FROM ({GAPPY}) GROUP BY k""")
def describe_series(spark, d):
    return rounded(profile.describe(gappy(spark, d), "value", KEYS), "mean", "std", "q1", "median", "q3")


@query("""SELECT 'column_count' AS "check", 1 AS ok, 1 AS fatal, '6' AS detail
UNION ALL SELECT 'column_names', 1, 1, 'event_id,ts,user_id,event_type,value,props'
UNION ALL SELECT 'row_count', CAST(count(*) IN (17520, 69680, 70080) AS INTEGER), 0, CAST(count(*) AS VARCHAR) FROM events
UNION ALL SELECT 'time_parses', CAST(count_if(ts IS NOT NULL AND try_cast(CAST(ts AS VARCHAR) AS TIMESTAMP) IS NULL) = 0 AS INTEGER), 1,
  CAST(count_if(ts IS NOT NULL AND try_cast(CAST(ts AS VARCHAR) AS TIMESTAMP) IS NULL) AS VARCHAR) FROM events
UNION ALL SELECT 'target_present', CAST(count_if(value IS NULL) = 0 AS INTEGER), 1, CAST(count_if(value IS NULL) AS VARCHAR) FROM events""")
def validate_layout(spark, d):
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    report = profile.validate_layout(table(spark, d, "events"), columns, "ts", "value")
    return report.withColumns({"ok": F.col("ok").cast("int"), "fatal": F.col("fatal").cast("int")})


@query(f"""SELECT k, id, coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS value
FROM ({GAPPY})""")
def fill_gaps(spark, d):
    return clean.fill_gaps(gappy(spark, d), ORDER, KEYS, ["value"]).select("k", "id", "value")


@query("""SELECT o_orderkey, coalesce(
  last_value(price IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS price
FROM (SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price FROM orders)""")
def fill_long_series(spark, d):
    """One long series with tied times takes the chunked two-level plan."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("price"),
    )
    filled = clean.fill_gaps(orders, ["o_orderdate", "o_orderkey"], columns=["price"], strategy="ranged")
    return filled.select("o_orderkey", "price")


@query("SELECT DISTINCT event_type AS k, strftime(ts, '%Y-%m-%d %H') AS hour, user_id FROM events")
def drop_copies(spark, d):
    return clean.drop_copies(_visits(spark, d))


@query("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_copies FROM (
  SELECT count(*) AS n FROM events GROUP BY event_type, strftime(ts, '%Y-%m-%d %H'), user_id)""")
def copy_report(spark, d):
    return clean.copy_report(_visits(spark, d))


def _visits(spark, d):
    hour = F.date_format("ts", "yyyy-MM-dd HH").alias("hour")
    return table(spark, d, "events").select(F.col("event_type").alias("k"), hour, "user_id")


@query("""SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year FROM events""")
def calendar_features(spark, d):
    out = clean.calendar_features(table(spark, d, "events").select("event_id", "ts"), "ts")
    return out.drop("ts")


@query("""SELECT vec_id, ratio FROM (SELECT vec_id, CASE WHEN label % 3 = 0 THEN CAST('inf' AS DOUBLE)
  WHEN label % 3 = 1 THEN NULL ELSE CAST(embedding[1] AS DOUBLE) END AS ratio FROM embeddings)
WHERE ratio IS NOT NULL AND NOT isinf(ratio) AND NOT isnan(ratio)""")
def drop_non_finite(spark, d):
    kind = F.col("label") % 3
    ratio = F.when(kind == 0, float("inf")).when(kind != 1, F.col("embedding")[0].cast("double"))
    vectors = table(spark, d, "embeddings").select("vec_id", ratio.alias("ratio"))
    return clean.drop_non_finite(vectors, ["ratio"])


_FILLED = f"""SELECT k, ts, id, coalesce(
  last_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS value
FROM ({GAPPY})"""


@query(f"""SELECT k, id, round((value - min(value) OVER (PARTITION BY k)) /
  (max(value) OVER (PARTITION BY k) - min(value) OVER (PARTITION BY k)), 6) AS value,
  CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year
FROM (SELECT DISTINCT * FROM ({_FILLED}))""")
def preprocess(spark, d):
    return rounded(jobs.preprocess(gappy(spark, d), ORDER, KEYS, "ts").drop("ts"), "value")


# ---- scaling --------------------------------------------------------------

def _scaled_sql(center: str, spread: str) -> str:
    return f"""SELECT s.k, s.id, round(CASE WHEN p.scale = 0 THEN NULL ELSE (s.value - p.center) / p.scale END, 6) AS value
FROM ({SERIES}) s JOIN (SELECT k, {center} AS center, {spread} AS scale FROM ({SERIES}) GROUP BY k) p ON s.k = p.k"""


def _scaled(spark, d, method):
    return rounded(scale.scale(series(spark, d), method, ["value"], KEYS).drop("ts"), "value")


@query(_scaled_sql("min(value)", "max(value) - min(value)"))
def norm_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query(_scaled_sql("avg(value)", "stddev_samp(value)"))
def norm_standard(spark, d):
    return _scaled(spark, d, "standard")


@query(_scaled_sql("quantile_cont(value, 0.5)", "quantile_cont(value, 0.75) - quantile_cont(value, 0.25)"))
def norm_robust(spark, d):
    return _scaled(spark, d, "robust")


@query(SQL["norm_robust"])
def robust_sorted(spark, d):
    """Robust scaling of groups too big for the built-in quantiles."""
    return rounded(scale.scale(series(spark, d), "robust", ["value"], KEYS, strategy="ranged").drop("ts"), "value")


@query(_scaled_sql("min(value)", "CASE WHEN max(value) = min(value) THEN 1 ELSE max(value) - min(value) END"))
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax_guarded")


@query(_scaled_sql("avg(value)", "CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END"))
def scale_standard(spark, d):
    return _scaled(spark, d, "standard_guarded")


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("\nUNION ALL\n".join(
    f"""SELECT l_returnflag, l_linestatus, '{c}' AS "column", 'robust' AS method, round(quantile_cont({c}, 0.5), 6) AS center,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS scale FROM lineitem GROUP BY 1, 2"""
    for c in _LINE_COLUMNS
))
def scaler_params(spark, d):
    params = scale.fit_scaler(table(spark, d, "lineitem"), "robust", _LINE_COLUMNS, ["l_returnflag", "l_linestatus"])
    return rounded(params, "center", "scale")


@query("""SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem""")
def sorted_quantiles(spark, d):
    """Quantiles of one undivided column through the cluster-wide sort."""
    from tidemill.operators.quantiles import group_quantiles

    q = group_quantiles(table(spark, d, "lineitem"), "l_extendedprice", (0.25, 0.5, 0.75), [], strategy="ranged")
    return q.select(*[r6(F.col("q")[i]).alias(n) for i, n in enumerate(("q1", "median", "q3"))])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
  round(l_extendedprice, 6) AS l_extendedprice FROM lineitem""")
def inverse_scale(spark, d):
    columns, keys = ["l_quantity", "l_extendedprice"], ["l_returnflag"]
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *keys, *columns)
    params = scale.fit_scaler(lines, "standard", columns, keys)
    there = scale.apply_scaler(lines, params, columns, keys)
    return rounded(scale.apply_scaler(there, params, columns, keys, inverse=True).drop(*keys), *columns)


@query(f"""SELECT p.k, p.id, p.split, round((p.value - f.lo) / (f.hi - f.lo), 6) AS value
FROM (SELECT *, CASE WHEN pos < 730 THEN 'train' WHEN pos < 1460 THEN 'val' ELSE 'test' END AS split FROM ({POSITIONS})) p
JOIN (SELECT k, min(value) AS lo, max(value) AS hi FROM ({POSITIONS}) WHERE pos < 730 GROUP BY k) f ON p.k = f.k""")
def scale_on_train(spark, d):
    scaled, _ = jobs.scale_and_split(series(spark, d), ORDER, KEYS, ["value"], fit_on="train", train_months=1, val_months=1)
    return rounded(scaled.select("k", "id", "split", "value"), "value")


# ---- positions, windows, splits -------------------------------------------

@query(f"SELECT k, id, CAST(pos AS BIGINT) AS pos FROM ({POSITIONS})")
def series_positions(spark, d):
    return series_index(series(spark, d), ORDER, KEYS).select("k", "id", "pos")


@query("""SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS pos FROM orders""")
def long_series_positions(spark, d):
    """Positions of one long series by range partitions."""
    orders = table(spark, d, "orders").select("o_orderdate", "o_orderkey")
    return series_index(orders, ["o_orderdate", "o_orderkey"], strategy="ranged").select("o_orderkey", "pos")


@query(f"""SELECT k, start, array_to_string(x_in, ', ') AS x, v_out[1] AS y
FROM ({windows_sql(8, 1, 1, x=TEXT_VALUE, v='value')})""")
def supervised_pairs(spark, d):
    pairs = windows.supervised_pairs(series(spark, d), 8, ORDER, KEYS)
    return pairs.select("k", "start", joined(F.col("x")).alias("x"), "y")


@query(f"""SELECT k, start, start // 4 AS ordinal, array_to_string(x_in, ', ') AS inputs, array_to_string(x_out, ', ') AS targets,
  t_in[1] AS first_ts, t_out[8] AS last_ts FROM ({windows_sql(24, 8, 4, x=TEXT_VALUE, t=TEXT_TIME)})""")
def strided_windows(spark, d):
    cut = windows.strided_windows(series(spark, d), 24, 8, ORDER, KEYS)
    return cut.select(
        "k", "start", "ordinal",
        joined(F.col("input_value")).alias("inputs"), joined(F.col("target_value")).alias("targets"),
        time_text(F.col("input_ts")[0], False).alias("first_ts"), time_text(F.col("target_ts")[7], False).alias("last_ts"),
    )


_FLAGS = """SELECT l_returnflag AS k, l_shipdate AS ts, l_orderkey * 8 + l_linenumber AS id, l_partkey, l_suppkey, l_quantity AS value FROM lineitem"""


@query(f"""SELECT k, start, v_in[1] AS first_value, v_out[96] AS last_value, list_sum(v_in) AS input_sum, list_sum(v_out) AS target_sum
FROM (SELECT * FROM (SELECT *,
  CAST(row_number() OVER w - 1 AS BIGINT) AS start, count(*) OVER (PARTITION BY k) AS n,
  list(value) OVER (w ROWS BETWEEN CURRENT ROW AND 255 FOLLOWING) AS v_in,
  list(value) OVER (w ROWS BETWEEN 256 FOLLOWING AND 351 FOLLOWING) AS v_out
  FROM ({_FLAGS}) WINDOW w AS (PARTITION BY k ORDER BY ts, id, l_partkey, l_suppkey, value))
  WHERE start % 16 = 0 AND start + 352 <= n)""")
def long_windows(spark, d):
    """256 inputs, 96 targets, stride 16, three big series with crowded days, range-partitioned."""
    lines = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("k"), F.col("l_shipdate").alias("ts"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("value"),
    )
    cut = windows.strided_windows(
        lines, 256, 96, ["ts", "id", "l_partkey", "l_suppkey", "value"], KEYS, 16, ["value"], strategy="ranged"
    )
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return cut.select(
        "k", "start", F.col("input_value")[0].alias("first_value"), F.col("target_value")[95].alias("last_value"),
        total("input_value").alias("input_sum"), total("target_value").alias("target_sum"),
    )


@query(f"""SELECT k, CAST(start + 12 AS BIGINT) AS index, t_out[1] AS timestamp, v_out[1] AS actual, array_to_string(x_in, ', ') AS inputs
FROM ({windows_sql(12, 1, 1, x=TEXT_VALUE, v='value', t=TEXT_TIME)})""")
def rolling_frame(spark, d):
    frame = windows.rolling_frame(series(spark, d), 12, ORDER, KEYS)
    return frame.select(
        "k", "index", time_text(F.col("timestamp"), False).alias("timestamp"), "actual", joined(F.col("input_values")).alias("inputs")
    )


@query(f"""SELECT k, start, context FROM ({windows_sql(6, 2, 2, "SELECT event_type AS k, ts, event_id AS id, value, 'user ' || user_id AS context FROM events", x=TEXT_VALUE)})""")
def window_context(spark, d):
    events = table(spark, d, "events").select(
        F.col("event_type").alias("k"), "ts", F.col("event_id").alias("id"), "value",
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("context"),
    )
    return windows.strided_windows(events, 6, 2, ORDER, KEYS, 2, first=["context"]).select("k", "start", "context")


@query(f"""SELECT k, CASE WHEN pos < 730 THEN 'train' WHEN pos < 1460 THEN 'val' ELSE 'test' END AS split,
  count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM ({POSITIONS}) GROUP BY 1, 2""")
def month_split(spark, d):
    rows = split.month_split(series_index(series(spark, d), ORDER, KEYS), train_months=1, val_months=1)
    return rows.groupBy("k", "split").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


_WINDOWS = windows_sql(10, 2, 1, x=TEXT_VALUE)
_SIZED = f"SELECT k, start, start AS ordinal, count(*) OVER (PARTITION BY k) AS m FROM ({_WINDOWS})"


def _samples(spark, d, head=None, wanted=None):
    cut = windows.strided_windows(series(spark, d), 10, 2, ORDER, KEYS, columns=["value"], head=head, wanted=wanted)
    return cut.select("k", "start", "ordinal")


def _sample_counts(spark, d):
    return windows.window_counts(series(spark, d), 10, 2, keys=KEYS)


@query(f"SELECT k, start, ordinal, CASE WHEN ordinal < floor(m * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM ({_SIZED})")
def ratio_split(spark, d):
    return split.ratio_split(_samples(spark, d), 0.8, keys=KEYS, sizes=_sample_counts(spark, d))


@query(f"""SELECT k, start, ordinal, CASE WHEN ordinal < floor(m * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split FROM ({_SIZED})
WHERE ordinal >= floor(m * CAST(0.8 AS DOUBLE)) OR start + 12 <= floor(m * CAST(0.8 AS DOUBLE))""")
def ratio_split_purged(spark, d):
    return split.ratio_split(_samples(spark, d), 0.8, keys=KEYS, purge=True, window=12, sizes=_sample_counts(spark, d), stride=1)


@query(f"""SELECT k, CAST(length AS INTEGER) AS length, CASE WHEN n >= length + 1 THEN n - length ELSE 0 END AS n_windows
FROM (SELECT k, count(*) AS n FROM ({SERIES}) GROUP BY k), (VALUES (5), (10), (20), (30)) t(length)""")
def window_sweep(spark, d):
    return windows.window_sweep(series(spark, d), [5, 10, 20, 30], keys=KEYS)


@query(f"SELECT k, start, ordinal FROM ({_SIZED}) WHERE ordinal IN (0, m // 2, m - 1)")
def first_middle_last(spark, d):
    return _samples(spark, d, wanted=split.ends_and_middle)


@query(f"SELECT k, start, ordinal FROM ({_SIZED}) WHERE ordinal IN (0, 26, 51)")
def fixed_picks(spark, d):
    return _samples(spark, d, wanted=lambda n: F.array(*[F.lit(o).cast("long") for o in (0, 26, 51)]))


@query(f"SELECT k, start, ordinal FROM ({_SIZED}) WHERE ordinal < 5")
def head_samples(spark, d):
    return split.head(_samples(spark, d, head=5), 5)


@query(f"SELECT k, id, value FROM ({SERIES}) ORDER BY md5(k || '|' || id || '|42'), k, id LIMIT 100")
def report_sample(spark, d):
    return split.report_sample(series(spark, d).drop("ts"), ["k", "id"])
