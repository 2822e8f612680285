"""Positions, fills, scaling, windows and splits: chunked plans equal the plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import clean, profile, render, scale, split, windows
from tidemill.operators.index import series_index
from tidemill.operators.quantiles import group_quantiles
from tidemill.plans import jobs


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def hourly(spark):
    """97 hourly rows, as many as the sample series has."""
    return spark.range(97).select(
        F.timestamp_seconds(1704067200 + F.col("id") * 3600).cast("timestamp_ntz").alias("timestamp"),
        (10.5 + (F.col("id") * 37 % 149) / 10).alias("value"),
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """One long series with a crowded time and long gaps, some short ones, a NULL key."""
    rnd = random.Random(11)
    rows = []
    for k, n in (("a", 3000), ("b", 40), ("c", 1), (None, 25)):
        for i in range(n):
            ts = 500 if k == "a" and 1000 <= i < 2200 else i
            known = rnd.random() < 0.6 and not (k == "a" and (i < 150 or 2500 < i < 2800 or i > 2950))
            rows.append((k, ts, i, rnd.randint(0, 50) / 2 if known else None, None if rnd.random() < 0.5 else f"s{i}", None))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k STRING, t LONG, id LONG, v DOUBLE, s STRING, never DOUBLE").repartition(5)


@pytest.mark.parametrize("keys", [["k"], []])
def test_ranged_index_equals_window(skewed, keys):
    order = ["t", "id"] if keys else ["t", "id", "k"]
    plain = series_index(skewed, order, keys, strategy="plain")
    assert same(plain, series_index(skewed, order, keys, strategy="ranged", partitions=7))
    assert same(plain, series_index(skewed, order, keys, plain_limit=10))


@pytest.mark.parametrize("chunk", [1, 7, 100, 100000])
def test_chunked_fill_equals_window(skewed, chunk):
    plain = clean.fill_gaps(skewed, ["t", "id"], ["k"], strategy="plain")
    ranged = clean.fill_gaps(skewed, ["t", "id"], ["k"], strategy="ranged", chunk_rows=chunk, partitions=5)
    assert same(plain, ranged)
    assert plain.where("k = 'a' AND v IS NULL").isEmpty()
    assert plain.where("never IS NOT NULL").isEmpty()


def test_fill_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 4.0), (3, float("nan"))], "t INT, v DOUBLE")
    assert [r.v for r in clean.fill_gaps(df, ["t"]).orderBy("t").collect()] == [4.0, 4.0, 4.0]


def test_copies_after_filling(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 2.0), (2, 3.0)], "t INT, v DOUBLE")
    assert clean.clean(df, ["t"]).count() in (2, 3)
    filled = spark.createDataFrame([(1, 2.0), (1, 2.0), (None, None), (None, None)], "t INT, v DOUBLE")
    assert clean.copy_report(filled).first() == (4, 2)
    assert clean.drop_copies(filled).count() == 2


def test_calendar(spark, hourly):
    row = clean.calendar_features(hourly, "timestamp").orderBy("timestamp").first()
    assert (row.hour, row.day_of_week, row.day_of_month, row.month, row.year) == (0, 0, 1, 1, 2024)
    assert clean.calendar_features(hourly, "date", strict=False).columns == hourly.columns
    with pytest.raises(ValueError):
        clean.calendar_features(hourly, "date")


@pytest.mark.parametrize("keys", [["k"], []])
def test_sorted_quantiles_equal_percentile(skewed, keys):
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    plain = {r[:-1]: r.q for r in group_quantiles(skewed, "v", probs, keys, "plain").collect()}
    ranged = {r[:-1]: r.q for r in group_quantiles(skewed, "v", probs, keys, "ranged", partitions=6).collect()}
    assert plain.keys() == ranged.keys()
    for k in plain:
        assert ranged[k] == plain[k]


def test_describe_and_reports(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "v DOUBLE")
    row = profile.describe(df, "v").first()
    assert (row["count"], row["min"], row["q1"], row["median"], row["q3"], row["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert profile.null_report(df).collect() == [("v", 2)]


def test_layout_checks(spark):
    from tidemill.functions.wording import ETT_COLUMNS

    good = spark.range(3).select(
        F.lit("2016-07-01 00:00:00").alias("date"), *[F.lit(1.0).alias(c) for c in ETT_COLUMNS[1:]]
    )
    report = profile.validate_layout(good)
    assert profile.layout_is_valid(report)
    assert report.where("not ok").select("check").collect() == [("row_count",)]
    for bad in (
        good.withColumn("OT", F.lit(None).cast("double")), good.withColumn("date", F.lit("no date")), good.drop("OT"),
    ):
        assert not profile.layout_is_valid(profile.validate_layout(bad))


@pytest.mark.parametrize("method", scale.METHODS)
def test_scale_and_inverse(skewed, method):
    df = skewed.select("k", "t", "id", "v").where("k IN ('a', 'b')")
    params = scale.fit_scaler(df, method, ["v"], ["k"])
    there = scale.apply_scaler(df, params, ["v"], ["k"])
    back = scale.apply_scaler(there, params, ["v"], ["k"], inverse=True)
    rounded = lambda d: d.withColumn("v", F.round("v", 9))
    assert same(rounded(df), rounded(back))


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,)] * 10, "v DOUBLE")
    for method, value in (("minmax", None), ("standard", None), ("robust", None), ("minmax_guarded", 0.0), ("standard_guarded", 0.0)):
        assert scale.scale(df, method, ["v"]).distinct().collect() == [(value,)]


def test_scaler_columns(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v DOUBLE")
    with pytest.raises(ValueError):
        scale.scale(df, "log", ["v"])
    assert scale.scale(df, "minmax", ["absent", "v"]).orderBy("v").collect() == [(0.0,), (1.0,)]
    assert scale.scale(df, "minmax", ["absent"]).columns == ["v"]
    with pytest.raises(ValueError):
        jobs.preprocess(df, ["v"], method="robust")


def brute_windows(values, length, horizon, stride):
    span = length + horizon
    return [
        (s, values[s : s + length], values[s + length : s + span])
        for s in range(0, len(values) - span + 1, stride)
    ]


@pytest.mark.parametrize(
    "n, length, horizon, stride, chunk",
    [(97, 10, 1, 1, 88), (97, 10, 1, 1, 11), (351, 256, 96, 1, 3000), (352, 256, 96, 1, 3000), (1000, 7, 3, 5, 64),
     (1000, 7, 3, 13, 10), (50, 4, 0, 3, 8), (2920, 256, 96, 48, 3000)],
)
@pytest.mark.parametrize("strategy", ["plain", "ranged"])
def test_windows_equal_brute_force(spark, n, length, horizon, stride, chunk, strategy):
    df = spark.range(2 * n).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).alias("t"), F.col("id").cast("double").alias("v"))
    cut = windows.strided_windows(df, length, horizon, ["t"], ["k"], stride, ["v"], strategy=strategy, chunk_rows=chunk)
    got = {k: [] for k in (0, 1)}
    for r in cut.orderBy("k", "start").collect():
        assert r.ordinal == r.start // stride
        got[r.k].append((r.start, r.input_v, r.target_v))
    for k in (0, 1):
        assert got[k] == brute_windows([float(2 * i + k) for i in range(n)], length, horizon, stride)


def test_window_counts(spark, hourly):
    sweep = windows.window_sweep(hourly, [5, 10, 20, 30, 200])
    assert [tuple(r) for r in sweep.collect()] == [(5, 92), (10, 87), (20, 77), (30, 67), (200, 0)]
    assert [windows.default_stride(h) for h in (1, 2, 4, 96)] == [1, 1, 2, 48]
    for rows, stride, count in ((8760, 16, 526), (2920, 16, 161), (5840, 16, 344)):
        df = spark.range(rows)
        assert windows.window_counts(df, 256, 96, stride).first().n == count
    with pytest.raises(ValueError):
        windows.strided_windows(hourly, 10, 1, ["timestamp"], columns=["value"], chunk_rows=5)


def test_dataset_golden_counts(hourly):
    built = jobs.build_dataset(hourly, 10, 1, ["timestamp"], timestamp="timestamp")
    counts = {r.split: r["count"] for r in built.groupBy("split").count().collect()}
    assert counts == {"train": 69, "val": 18}
    one = built.where("ordinal = 0").first()
    assert one.instruction.startswith("以下の時系列データの次の値を予測してください。\n\n過去のデータ:\n時刻: 2024-01-01 00:00:00, 値: 10.5000\n")
    assert one.instruction.endswith("\n\n次の1ステップの予測値を教えてください。")
    assert one.output.startswith("時刻: 2024-01-01 10:00:00, 予測値: ")


def test_month_split_counts(spark):
    df = split.month_split(spark.range(17520).withColumnRenamed("id", "pos"))
    counts = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 8760, "val": 2920, "test": 5840}
    assert split.month_split(spark.range(10).withColumnRenamed("id", "pos")).select("split").distinct().count() == 1


def test_text_times_and_missing_values(spark):
    df = spark.createDataFrame([("1月", 1.0), ("2月", None), ("3月", 3.0)], "ts STRING, value DOUBLE")
    row = render.build_samples(df, 2, 1, ["ts"]).first()
    assert "時刻: 1月, 値: 1.0000\n時刻: 2月, 値: nan\n" in row.instruction
    assert row.output == "時刻: 3月, 予測値: 3.0000"


def test_absent_or_empty_context_is_ignored(spark):
    df = spark.createDataFrame([(1, 1.0, ""), (2, 2.0, "b"), (3, 3.0, "c")], "ts INT, value DOUBLE, c STRING")
    df = df.withColumn("ts", F.timestamp_seconds("ts").cast("timestamp_ntz"))
    for template in ("default", "conversational", "reasoning"):
        with_empty, with_text = render.build_samples(df, 1, 1, ["ts"], template=template, context="c").orderBy("start").collect()
        assert "\nb\n" not in with_empty.instruction and "b\n" in with_text.instruction
        absent = render.build_samples(df, 1, 1, ["ts"], template=template, context="no").orderBy("start").first()
        assert absent.instruction == with_empty.instruction
    with pytest.raises(ValueError):
        render.build_samples(df, 1, 1, ["ts"], template="other")


def test_render_then_parse_gives_targets(spark):
    from tidemill.functions.parsing import forecast_sequence

    df = spark.range(400).select(F.col("id").alias("t"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), (F.sin("id") + 1).alias("value"))
    samples = render.build_samples(df, 256, 96, ["t"], stride=16, template="numeric_only")
    back = samples.select(forecast_sequence(F.col("output")).alias("got"), F.transform("target_values", lambda x: F.round(x, 4)).alias("want"))
    assert back.count() == 4 and back.where("got != want").isEmpty()


def test_results_do_not_depend_on_partitioning(skewed):
    cut = lambda df: windows.strided_windows(df, 5, 2, ["t", "id"], ["k"], columns=["v"], chunk_rows=50)
    assert same(cut(skewed), cut(skewed.repartition(13, "s")))


def test_long_prompts(spark):
    df = spark.range(1, 12).select(F.repeat(F.lit("x"), F.col("id").cast("int")).alias("prompt"), "id")
    assert render.drop_long_prompts(df).count() == 10
    assert render.drop_long_prompts(df, length="id").count() == 10
    assert render.drop_long_prompts(df, quantile=0.55).count() == 6


def test_head_cuts_the_first_windows_only(spark):
    rows = [(k, i, float(i)) for k, n in (("a", 60), ("b", 13), ("c", 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "k STRING, ts INT, value DOUBLE")
    cut = lambda **more: {tuple(r) for r in windows.strided_windows(df, 6, 4, ["ts"], ["k"], 3, ["value"], **more).selectExpr("k", "start", "ordinal", "cast(input_value as string)", "cast(target_value as string)").collect()}
    whole = cut()
    for n in (0, 1, 2, 5, 99):
        assert cut(head=n) == {r for r in whole if r[2] < n}


def test_purge_by_stride_equals_purge_by_search(spark):
    rows = [(k, i, float(i)) for k, n in (("a", 60), ("b", 13), ("c", 10)) for i in range(n)]
    df = spark.createDataFrame(rows, "k STRING, ts INT, value DOUBLE")
    cut = windows.strided_windows(df, 6, 4, ["ts"], ["k"], 3, ["value"]).select("k", "start", "ordinal")
    for ratio in (0.0, 0.5, 0.8, 1.0):
        one, two = ({tuple(r) for r in split.ratio_split(cut, ratio, keys=["k"], purge=True, window=10, stride=s).collect()} for s in (None, 3))
        assert one == two
