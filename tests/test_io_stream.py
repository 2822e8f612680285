import json

import pytest
from pyspark.sql import functions as F

from tidemill.functions.parsing import first_value
from tidemill.operators import render, scale, windows
from tidemill.plans import jobs
from tidemill.sources import io
from tidemill.streaming import telemetry


@pytest.fixture
def series_csv(tmp_path):
    path = tmp_path / "series.csv"
    lines = [f"2024-01-0{1 + i // 24} {i % 24:02d}:00:00,{'' if i == 5 else 10 + i}" for i in range(60)]
    path.write_text("timestamp,value\n" + "\n".join(lines + lines[-1:]) + "\n")
    return str(path)


def test_preprocess_csv(spark, series_csv, tmp_path):
    out = jobs.preprocess_csv(spark, series_csv, str(tmp_path / "out"))
    rows = out.orderBy("timestamp").collect()
    assert len(rows) == 60 and rows[0].value == 0.0 and rows[-1].value == 1.0
    assert rows[5].value == rows[4].value and rows[30].hour == 6 and rows[30].day_of_week == 1


def test_raw_text_times_are_kept(spark, series_csv):
    df = io.read_series_csv(spark, series_csv, "timestamp STRING, value DOUBLE")
    row = render.build_samples(df, 3, 1, ["timestamp"], timestamp="timestamp").orderBy("start").first()
    assert "時刻: 2024-01-01 00:00:00, 値: 10.0000\n" in row.instruction


def test_multivariate_target_must_be_complete(spark, tmp_path):
    path = tmp_path / "ett.csv"
    head = "date,HUFL,HULL,MUFL,MULL,LUFL,LULL,OT\n"
    path.write_text(head + "2016-07-01 00:00:00,1,2,3,4,5,6,30.5\n")
    assert io.read_multivariate_csv(spark, str(path)).first().OT == 30.5
    path.write_text(head + "2016-07-01 00:00:00,1,2,3,4,5,6,\n")
    with pytest.raises(Exception, match="missing values"):
        io.read_multivariate_csv(spark, str(path)).collect()


@pytest.mark.parametrize("text", ["value,timestamp\n1.0,2024-01-01 00:00:00\n", "timestamp,value\nnot a time,1.0\n", "timestamp,value\n2024-01-01 00:00:00,abc\n"])
def test_wrong_csv_fails_loudly(spark, tmp_path, text):
    path = tmp_path / "series.csv"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|header"):
        io.read_series_csv(spark, str(path)).collect()


def test_scale_split_and_parameters(spark, tmp_path):
    df = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("date"), F.col("id").cast("double").alias("OT"))
    scaled, params = jobs.scale_and_split(df, ["date"], train_months=1, val_months=1)
    jobs.write_scaled_split(scaled, params, str(tmp_path), "ETTH1")
    back = spark.read.option("header", True).csv(f"{tmp_path}/ETTH1")
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 730, "val": 730, "test": 540}
    stored = io.read_scaler(spark, f"{tmp_path}/ETTH1_scaler")
    assert tuple(stored.first()) == ("OT", "minmax", 0.0, 1999.0)
    restored = scale.apply_scaler(scaled, stored, ["OT"], inverse=True)
    assert restored.agg(F.max(F.abs(F.col("OT") - F.col("pos")))).first()[0] < 1e-9
    train_only, params = jobs.scale_and_split(df, ["date"], fit_on="train", train_months=1, val_months=1)
    assert params.first().scale == 729.0


@pytest.mark.parametrize("format", ["json", "columnar"])
def test_samples_round_trip(spark, tmp_path, format):
    df = spark.range(30).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), (F.col("id") / 3).alias("value"))
    built = jobs.build_dataset(df, 5, 2, ["ts"]).drop("start", "ordinal")
    io.write_samples(built, str(tmp_path / "s"), format, ["split"])
    back = io.read_samples(spark, str(tmp_path / "s"), format, io.SAMPLE_SCHEMA + ", split STRING")
    assert back.select(*built.columns).exceptAll(built).isEmpty() and back.count() == built.count()
    assert (tmp_path / "s" / "split=train").is_dir()
    with pytest.raises(ValueError):
        io.write_samples(built, str(tmp_path / "t"), "other")
    with pytest.raises(ValueError):
        io.read_samples(spark, str(tmp_path / "s"), "other")


def test_array_json(spark, tmp_path):
    path = tmp_path / "train.json"
    path.write_text(json.dumps([{"instruction": "あ", "output": "x", "input_values": [1.0], "target_values": [2.0, 3.0]}] * 3, indent=2))
    samples = io.read_samples(spark, str(path), array=True)
    records = jobs.training_set(samples)
    assert records.count() == 3
    row = records.first()
    assert row.true_value == 2.0 and [m.role for m in row.messages] == ["system", "user"] and row.messages[1].content == "あ"


def test_text_artifacts(spark, tmp_path):
    df = spark.createDataFrame([(1, "p", "r")], "id INT, prompt STRING, response STRING")
    io.write_text_artifacts(df, str(tmp_path / "a"), ["id"], {"prompt": "prompt", "response": "response"})
    back = spark.read.json(str(tmp_path / "a"))
    assert {(r.kind, r.text) for r in back.collect()} == {("prompt", "p"), ("response", "r")}


def test_predictions_with_line_breaks(spark, tmp_path):
    rolling = windows.rolling_frame(
        spark.range(6).select(F.col("id").alias("t"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("value")),
        2, ["t"],
    )
    told = rolling.select("index", F.concat(F.lit('x, "y"\n予測値: '), F.col("index").cast("string")).alias("content")).where("index < 5")
    frame = jobs.forecast_frame(rolling, told, ["index"])
    kept = frame.select("index", F.col("timestamp").cast("string").alias("timestamp"), "actual", "predicted", "response")
    io.write_csv(kept, str(tmp_path / "p"))
    back = io.read_predictions_csv(spark, str(tmp_path / "p")).orderBy("index").collect()
    assert [(r["index"], r.actual, r.predicted) for r in back] == [(2, 2.0, 2.0), (3, 3.0, 3.0), (4, 4.0, 4.0), (5, 5.0, None)]
    assert back[0].response == 'x, "y"\n予測値: 2' and back[3].response is None


def test_report_takes_the_first_peak(spark):
    df = spark.createDataFrame([(0.0, 5.0, 10.0), (1.0, 8.0, 10.0), (2.0, 8.0, 10.0)], "timestamp DOUBLE, used_mb DOUBLE, total_mb DOUBLE")
    row = telemetry.telemetry_report(df).first()
    assert tuple(row) == (3, 2.0, 1.0, 8.0, 80.0, 7.0)


def test_stream_equals_batch(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet")
    usage = lambda df: df.select("ts", F.col("event_type").alias("k"), F.col("value").alias("used_mb"), F.lit(500.0).alias("total_mb"))
    source = tmp_path / "in"
    events.write.parquet(str(source))
    stream = spark.readStream.schema(events.schema).parquet(str(source))
    # Complete mode keeps every window; append would hold back the open ones.
    query = (
        telemetry.telemetry_stream(usage(stream), "ts", keys=["k"])
        .writeStream.outputMode("complete").format("memory").queryName("usage")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = telemetry.telemetry_stream(usage(events), "ts", keys=["k"])
    got = spark.table("usage")
    assert batch.count() > 0 and got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_a_missing_target_raises_whatever_is_read(spark, tmp_path):
    (tmp_path / "m.csv").write_text("date,OT\n2024-01-01 00:00:00,1.5\n2024-01-01 01:00:00,\n")
    df = io.read_multivariate_csv(spark, str(tmp_path / "m.csv"), "date TIMESTAMP_NTZ, OT DOUBLE")
    for action in (df.count, df.select("date").collect, df.collect):
        with pytest.raises(Exception, match="column OT has missing values"):
            action()


def test_bad_rows_are_set_aside_with_their_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("timestamp,value\n2024-01-01 00:00:00,1.5\nyesterday,2\n2024-01-01 02:00:00,\n")
    (tmp_path / "in" / "b.csv").write_text("timestamp,value\n2024-01-02 00:00:00,x\n2024-01-02 01:00:00,4\n")
    rows, rejects = io.load_series_csv(spark, str(tmp_path / "in"), required=["value"])
    assert sorted(r.value for r in rows.collect()) == [1.5, 4.0] and rows.count() == 2
    got = sorted((r.file.rsplit("/", 1)[1], r.reason, r.record) for r in rejects.collect())
    assert [g[:2] for g in got] == [("a.csv", "malformed"), ("a.csv", "no value"), ("b.csv", "malformed")]
    assert got[0][2] == "yesterday,2" and got[2][2] == "2024-01-02 00:00:00,x" and rejects.count() == 3
    good, none = io.load_series_csv(spark, str(tmp_path / "in"))
    assert good.count() == 3 and none.count() == 2


def test_report_rows_come_back_as_json_lines(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, None), ("b", None, 2)], "k STRING, mae DOUBLE, n LONG")
    io.write_report(df, str(tmp_path / "r"))
    assert sorted(spark.read.schema(df.schema).json(str(tmp_path / "r")).collect()) == sorted(df.collect())
