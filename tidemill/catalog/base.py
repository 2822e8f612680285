"""Tables the registered queries start from, in DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import fmt4
from tidemill.operators.windows import rolling_frame

KEYS, ORDER = ["k"], ["ts", "id"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def joined(values: Column) -> Column:
    """Array of doubles as four-decimal text."""
    return F.array_join(F.transform(values, fmt4), ", ")


def series(spark: SparkSession, folder: str) -> DataFrame:
    """One series per event type."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("k"), "ts", F.col("event_id").alias("id"), "value"
    )


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """The series with low readings missing."""
    return series(spark, folder).withColumn("value", F.when(F.col("value") >= 10, F.col("value")))


SERIES = "SELECT event_type AS k, ts, event_id AS id, value FROM events"
GAPPY = "SELECT event_type AS k, ts, event_id AS id, CASE WHEN value >= 10 THEN value END AS value FROM events"
POSITIONS = f"""SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, id) - 1 AS pos,
  count(*) OVER (PARTITION BY k) AS n FROM ({SERIES})"""
TEXT_TIME = r"regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.000000$', '')"
TEXT_VALUE = "printf('%.4f', value)"
SCALED = f"""SELECT k, ts, id, (value - min(value) OVER (PARTITION BY k))
  / (max(value) OVER (PARTITION BY k) - min(value) OVER (PARTITION BY k)) AS value FROM ({SERIES})"""


def windows_sql(length: int, horizon: int, stride: int, source: str = SERIES, **lists: str) -> str:
    """SQL for windows: per list ``x`` the arrays ``x_in`` and ``x_out`` of an expression."""
    part = "PARTITION BY k ORDER BY ts, id"
    cols = []
    for name, expr in lists.items():
        cols.append(f"list({expr}) OVER ({part} ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING) AS {name}_in")
        if horizon:
            cols.append(
                f"list({expr}) OVER ({part} ROWS BETWEEN {length} FOLLOWING AND {length + horizon - 1} FOLLOWING) AS {name}_out"
            )
    return f"""SELECT * FROM (
  SELECT *, CAST(row_number() OVER ({part}) - 1 AS BIGINT) AS start, count(*) OVER (PARTITION BY k) AS n,
  {', '.join(cols)} FROM ({source}))
WHERE start % {stride} = 0 AND start + {length + horizon} <= n"""


# Completions: four generations per sample, in six styles so that every branch of
# the parsers and rewards is met.
def completions(spark: SparkSession, folder: str) -> DataFrame:
    v = fmt4(F.col("value"))
    far = fmt4(F.col("value") * 3)
    style = F.col("user_id") % 6
    content = (
        F.when(style == 0, F.concat(F.lit("<think>傾向を分析</think>予測値: "), v))
        .when(style == 1, F.concat(F.lit("考え中</think> 予測値："), v, F.lit(" です。")))
        .when(style == 2, F.concat(F.lit("<think>a</think></think> "), far))
        .when(style == 3, F.lit("わかりません"))
        .when(style == 4, F.concat(F.lit("The next value may be "), far, F.lit(" or "), v, F.lit(".")))
        .otherwise(F.concat(F.lit("<think>前回 "), far, F.lit("</think>\n次の値: "), v, F.lit("\n")))
    )
    lang = F.when(style == 4, "en").when(style == 2, "fr").otherwise("ja")
    return table(spark, folder, "events").select(
        F.floor(F.col("event_id") / 4).alias("sample_id"),
        (F.col("event_id") % 4).cast("int").alias("generation_id"),
        content.alias("content"),
        lang.alias("lang"),
    )


COMPLETIONS = """SELECT event_id // 4 AS sample_id, CAST(event_id % 4 AS INTEGER) AS generation_id,
  CASE user_id % 6
    WHEN 0 THEN '<think>傾向を分析</think>予測値: ' || printf('%.4f', value)
    WHEN 1 THEN '考え中</think> 予測値：' || printf('%.4f', value) || ' です。'
    WHEN 2 THEN '<think>a</think></think> ' || printf('%.4f', value * 3)
    WHEN 3 THEN 'わかりません'
    WHEN 4 THEN 'The next value may be ' || printf('%.4f', value * 3) || ' or ' || printf('%.4f', value) || '.'
    ELSE '<think>前回 ' || printf('%.4f', value * 3) || '</think>' || chr(10) || '次の値: ' || printf('%.4f', value) || chr(10)
  END AS content,
  CASE user_id % 6 WHEN 4 THEN 'en' WHEN 2 THEN 'fr' ELSE 'ja' END AS lang
FROM events"""


def truths(spark: SparkSession, folder: str) -> DataFrame:
    """One true value per sample."""
    return (
        table(spark, folder, "events")
        .groupBy(F.floor(F.col("event_id") / 4).alias("sample_id"))
        .agg(F.min_by("value", "event_id").alias("true_value"))
    )


TRUTHS = "SELECT event_id // 4 AS sample_id, arg_min(value, event_id) AS true_value FROM events GROUP BY 1"


# Sequence completions: 64 numbers per vector, in four layouts.
SEQUENCE_LENGTH = 64


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    values = F.transform("embedding", lambda x: x.cast("double"))
    listed = joined(values)
    bare = joined(F.transform(values, F.abs))
    layout = F.col("label") % 4
    content = (
        F.when(layout == 0, F.concat(F.lit("<think>1, 2, 3</think>\n\n予測結果（64点）:\n"), listed))
        .when(layout == 1, F.concat(F.lit("予測結果(64点)\n```\n"), listed, F.lit("\n```")))
        .when(layout == 2, F.concat(F.lit("答え "), bare, F.lit(" 以上")))
        .otherwise(F.concat(F.lit("<think>"), bare, F.lit("</think> 不明")))
    )
    # The truth is the vector at half its size, the expected answer its text.
    truth = F.transform(values, lambda x: x * 0.5)
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("sample_idx"), "label", content.alias("content"),
        truth.alias("target_values"), values.alias("input_values"),
        F.concat(F.lit("予測結果（64点）:\n"), joined(truth)).alias("output"),
    )


SEQUENCES = """SELECT vec_id AS sample_idx, label,
  list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 0.5) AS target_values,
  CASE label % 4
    WHEN 0 THEN '<think>1, 2, 3</think>' || chr(10) || chr(10) || '予測結果（64点）:' || chr(10) || listed
    WHEN 1 THEN '予測結果(64点)' || chr(10) || '```' || chr(10) || listed || chr(10) || '```'
    WHEN 2 THEN '答え ' || bare || ' 以上'
    ELSE '<think>' || bare || '</think> 不明' END AS content,
  CASE label % 4 WHEN 2 THEN list_transform(texts, lambda x: abs(CAST(x AS DOUBLE)))
    WHEN 3 THEN [] ELSE list_transform(texts, lambda x: CAST(x AS DOUBLE)) END AS parsed,
  list_transform(embedding, lambda x: CAST(printf('%.4f', CAST(x AS DOUBLE) * 0.5) AS DOUBLE)) AS parsed_truth
FROM (SELECT *, list_transform(embedding, lambda x: printf('%.4f', CAST(x AS DOUBLE))) AS texts,
  array_to_string(list_transform(embedding, lambda x: printf('%.4f', CAST(x AS DOUBLE))), ', ') AS listed,
  array_to_string(list_transform(embedding, lambda x: printf('%.4f', abs(CAST(x AS DOUBLE)))), ', ') AS bare
  FROM embeddings)"""


# Predictions: each value forecast by the one before it, unknown if that was low.
def predictions(spark: SparkSession, folder: str) -> DataFrame:
    rolling = rolling_frame(series(spark, folder), 1, ORDER, KEYS)
    last = F.col("input_values")[0]
    return rolling.select("k", "index", "actual", F.when(last >= 10, last).alias("predicted"))


PREDICTIONS = f"""SELECT k, pos AS index, value AS actual, CASE WHEN last >= 10 THEN last END AS predicted
FROM (SELECT *, lag(value) OVER (PARTITION BY k ORDER BY ts, id) AS last FROM ({POSITIONS})) WHERE pos > 0"""
