"""Quantiles by rank selection, exact sums, one-pass evaluation, peaks without sorting, language plans."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.functions.exact import cut, joined
from tidemill.operators import completions, language, metrics, scale, split, windows
from tidemill.operators.index import range_chunk
from tidemill.operators.quantiles import group_quantiles
from tidemill.plans import jobs
from tidemill.streaming import telemetry

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.fixture(scope="module")
def crowded(spark):
    """A normal series, one of few values, one of a single value, one crowded at a value, one row, none but missing values, a null key."""
    rng = random.Random(7)
    rows = [("normal", rng.gauss(0, 1)) for _ in range(4000)] + [("few", float(rng.randint(0, 2))) for _ in range(1500)]
    rows += [("one", 3.5)] * 900 + [("crowd", 1.0 if rng.random() < 0.7 else rng.random() * 10**rng.randint(-300, 300)) for _ in range(2500)]
    rows += [("single", -0.25), ("missing", None), ("missing", float("nan")), (None, 2.0), (None, None), (None, 8.0), ("ends", float("-inf")), ("ends", 0.0), ("ends", float("inf"))]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(7).cache()


@pytest.mark.parametrize("bracket_rows", [1, 40, 10**6])
def test_selected_quantiles_equal_the_builtin(crowded, bracket_rows):
    plain = {r.k: r.q for r in group_quantiles(crowded, "v", PROBS, ["k"], "plain").collect()}
    ranged = {r.k: r.q for r in group_quantiles(crowded, "v", PROBS, ["k"], "ranged", bracket_rows=bracket_rows).collect()}
    assert ranged.keys() == plain.keys() and plain["missing"] is None and ranged["missing"] is None
    for k in plain:
        assert str(ranged[k]) == str(plain[k]), k


def test_selected_quantiles_without_keys_or_rows(spark, crowded):
    finite = crowded.where("k <> 'ends'")
    one, two = (group_quantiles(finite, "v", PROBS, [], s, bracket_rows=10).first().q for s in ("plain", "ranged"))
    assert one == two
    for rows in (finite.limit(0), finite.where("k = 'missing'")):
        assert [r.q for r in group_quantiles(rows, "v", PROBS, [], "ranged").collect()] == [None]
    assert group_quantiles(finite.limit(0), "v", PROBS, ["k"], "ranged").collect() == []


def test_columns_are_selected_together(spark, monkeypatch):
    """Rows are stored as they are, not once a column; crowded values, gaps and several columns give the built-in's doubles."""
    from tidemill.operators import quantiles

    rows = spark.range(4000).selectExpr(
        "IF(id % 5 = 0, NULL, id % 3) AS k", "CAST(id % 11 AS DOUBLE) / 100 AS few", "CAST(id * 7919 % 4001 AS DOUBLE) AS many",
        "IF(id % 3 = 1, NULL, IF(id % 4 = 0, CAST('NaN' AS DOUBLE), CAST(id * id % 97 AS DOUBLE))) AS gaps",
    )
    stored, write = [], quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df: stored.append(write(df)) or stored[-1])
    names = ["few", "many", "gaps"]
    plain = {r.k: r[1:] for r in quantiles.column_quantiles(rows, names, PROBS, ["k"], "plain").collect()}
    for bracket_rows in (1, 10**6):
        assert {r.k: r[1:] for r in quantiles.column_quantiles(rows, names, PROBS, ["k"], "ranged", bracket_rows=bracket_rows).collect()} == plain
    params = lambda s: {tuple(r) for r in scale.fit_scaler(rows, "robust", names, ["k"], strategy=s).collect()}
    assert params("ranged") == params("plain")
    assert max(t.count() for t in stored) == 4000


def test_a_series_without_values_keeps_its_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("b", None, 1.0), ("b", 1.0, None)], "k string, actual double, predicted double")
    for strategy in ("plain", "ranged"):
        params = {r.k: (r.center, r.scale) for r in scale.fit_scaler(df, "robust", ["actual", "predicted"], ["k"], strategy=strategy).where("column = 'actual'").collect()}
        assert params == {"a": (1.5, 0.5), "b": (1.0, 0.0)}
        gone = df.withColumn("actual", F.when(F.col("k") == "a", F.col("actual")))
        params = {r.k: (r.center, r.scale) for r in scale.fit_scaler(gone, "robust", ["actual"], ["k"], strategy=strategy).collect()}
        assert params == {"a": (1.5, 0.5), "b": (None, None)}
        box = {r.k: (r.q1, r.median, r.n_outliers) for r in metrics.box_summary(df, ["k"], strategy=strategy).collect()}
        assert box == {"a": (1.25, 1.5, 0), "b": (None, None, 0)}
    rows = metrics.error_histogram(df, 3, ["k"]).orderBy("k", "bin").collect()
    assert [(r.k, r.bin, r.n) for r in rows] == [("a", 0, 1), ("a", 1, 0), ("a", 2, 1), ("b", None, 0)]


# ---- exact sums -----------------------------------------------------------

def test_exact_sums(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-40, 60) for _ in range(500)] + [0.1] * 10 + [1e16, -1e16, 0.0, -0.0, 2.0**53, 5e-324]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    sums = df.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(cut(F.col("x")))])
    # 5e-324 is cut off; the result is rounded a few times, the sum itself is not.
    assert sums.select(joined([F.col(f"s{i}") for i in range(3)])).first()[0] == pytest.approx(math.fsum(values), rel=1e-15)


@pytest.mark.parametrize("options", [{}, {"normalize": False}, {"whiten": False}])
def test_split_and_plain_advantages_are_equal_to_the_bit(spark, options):
    rng = random.Random(11)
    rows = [(s, g, rng.choice([0.1, 0.2, 0.7, 3.5, -4.5, rng.gauss(1e6, 1), None])) for s in range(3) for g in range(400)]
    rows += [(7, 0, 0.3), (8, 0, None), (9, 0, float("nan")), (9, 1, 1.0), (None, 0, 1.0), (None, 5, 2.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sample_id long, generation_id long, reward double")
    text = lambda df: sorted((str(r.sample_id), r.generation_id, repr(r.advantage)) for r in df.collect())
    one = text(completions.group_advantage(df, **options))
    two = text(completions.group_advantage(df.repartition(5, "generation_id"), limit=0, **options))
    assert one == two
    assert one == text(completions.group_advantage(df.orderBy("generation_id"), **options))


def test_advantage_is_right(spark):
    df = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate([1, 2, 3, 4])] + [(2, 0, 5.0)], "sample_id long, generation_id long, reward double")
    got = [r.advantage for r in completions.group_advantage(df).orderBy("sample_id", "generation_id").collect()]
    std = math.sqrt(5 / 3)
    assert got == pytest.approx([-1.5 / (std + 1e-4), -0.5 / (std + 1e-4), 0.5 / (std + 1e-4), 1.5 / (std + 1e-4), 0.0])


# ---- evaluation -----------------------------------------------------------

def test_evaluation_reads_its_input_once(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, i, rng.gauss(0, 1), rng.gauss(0, 1) if rng.random() < 0.9 else None, "r") for k in "ab" for i in range(200)] + [("c", 0, 1.0, None, "r")]
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(rows, "k string, index long, actual double, predicted double, response string")
    counted = F.udf(lambda x: (seen.add(1), x)[1], "double")
    reports = jobs.evaluate(df.withColumn("predicted", counted("predicted")), ["k"], ("k", "index"))
    table = jobs.evaluation_table(reports, ["k"])
    table.collect()
    [r.collect() for r in reports.values()]
    assert seen.value == len(rows)
    plain = lambda r: [f"{x:.9g}" if isinstance(x, float) else x for x in r]
    same = lambda a, b: sorted(map(str, map(plain, a.collect()))) == sorted(map(str, map(plain, b.collect())))
    assert same(reports["metrics"], metrics.forecast_metrics(df, ["k"])) and same(reports["range"], metrics.actual_range(df, ["k"]))
    assert same(reports["box"], metrics.box_summary(df, ["k"])) and same(reports["histogram"], metrics.error_histogram(df, 30, ["k"]))
    assert same(jobs.evaluate(df, ["k"], ("k", "index"), strategy="ranged")["box"], reports["box"])
    assert table.where("k = 'c' AND report = 'metrics' AND name = 'n'").first().value == 0.0
    # Without keys, too.
    assert jobs.evaluate(df)["box"].first() == metrics.box_summary(df).first()


# ---- telemetry ------------------------------------------------------------

def test_order_bits_order_like_doubles(spark):
    rng = random.Random(5)
    values = [s * 2.0**e * f for s in (1, -1) for e in (-1074, -1023, -1022, -1021, -60, -1, 0, 1, 52, 53, 1023) for f in (1.0, 1.25, 1.9999999999999998)]
    values += [rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(300)] + [0.0, float("inf"), -float("inf"), 1e308 * 1.7, 5e-324]
    values = sorted({v + 0.0 for v in values if abs(v) != float("inf")} | {float("inf"), -float("inf")})
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bits = [r.b for r in df.select("x", telemetry.order_bits(F.col("x")).alias("b")).orderBy("x").collect()]
    assert all(a < b for a, b in zip(bits, bits[1:]))


def test_peaks_need_no_sort(spark):
    rng = random.Random(1)
    rows = [(f"k{i % 3}", rng.choice([-2.0, -1.0, 0.0, 7.25, 7.250000000000001, None]), float(rng.randint(-5, 40)), 10.0) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, used_mb double, timestamp double, total_mb double").repartition(6)
    report = telemetry.telemetry_report(df, ["k"])
    assert "SortAggregate" not in report._jdf.queryExecution().executedPlan().toString()
    for r in report.collect():
        used, at = min((-u, t) for k, u, t, _ in rows if k == r.k and u is not None)
        assert (r.peak_used_mb, r.peak_timestamp, r.peak_usage_percent) == (-used, at, -used / 10 * 100)


def test_stream_goes_on_from_its_checkpoint(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet")
    usage = lambda df: df.select("ts", F.col("event_type").alias("k"), F.col("value").alias("used_mb"), F.lit(500.0).alias("total_mb"))
    source, half = str(tmp_path / "in"), F.col("event_id") % 2 == 0
    for part in (half, ~half):
        events.where(part).write.mode("append").parquet(source)
        query = (
            telemetry.telemetry_stream(usage(spark.readStream.schema(events.schema).parquet(source)), "ts", late="400 days", keys=["k"])
            .writeStream.outputMode("complete").format("memory").queryName("resumed")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        read = sum(p["numInputRows"] for p in query.recentProgress)
        assert read == events.where(part).count()
    batch = telemetry.telemetry_stream(usage(events), "ts", keys=["k"])
    close = lambda df: sorted((str(r.window_start), r.k, r.n_measurements, r.peak_timestamp, r.peak_used_mb, round(r.mean_used_mb, 9)) for r in df.collect())
    assert close(spark.table("resumed")) == close(batch)


# ---- language -------------------------------------------------------------

def test_language_plans_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(-1, None, "en"), (-2, "", "en"), (-3, "ab", "en"), (-4, "Ωψ ζζζ", "en"), (-5, "これはテストです", "en"), (-6, "中文文本", "fr"), (None, "the thing and the other", None)]
    told = docs.union(spark.createDataFrame(extra, docs.schema))
    profile = language.language_profile(language.gram_counts(docs))
    labels = lambda **options: sorted(map(str, language.label_language(told, profile, ["doc_id", "lang"], **options).collect()))
    one = labels()
    assert len(one) == told.count()
    assert one == labels(limit=0) == labels(dense=0) == labels(dense=0, limit=0)
    got = {r.doc_id: r.label for r in language.label_language(told, profile, ["doc_id"]).collect()}
    assert [got[i] for i in (-1, -2, -3, -5, -6)] == ["und", "und", "und", "ja", "zh"] and got[None] == "en" and got[-4] != "und"


def test_texts_meet_the_profile_without_a_shuffle_of_trigrams(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    profile = language.language_profile(language.gram_counts(docs))
    plan = language.label_language(docs, profile, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("documents.parquet") == 1


@pytest.mark.parametrize("keys", [["k"], []])
def test_wanted_windows_are_those_cut_with_all_others(spark, keys):
    df = spark.range(700).select(F.when(F.col("id") < 3, "c").when(F.col("id") % 7 == 0, "b").otherwise("a").alias("k"), F.col("id").alias("t"), (F.col("id") * 3 % 11).cast("double").alias("v"))
    options = dict(order_by=["t"], keys=keys, stride=2, columns=["v"], first=["t"])
    whole = split.first_middle_last(windows.strided_windows(df, 5, 3, **options), keys=keys)
    alone = windows.strided_windows(df, 5, 3, wanted=split.ends_and_middle, **options)
    far = windows.strided_windows(df, 5, 3, wanted=lambda n: F.array(n, F.lit(-1).cast("long"), F.lit(1).cast("long"), F.lit(1).cast("long")), **options)
    key = lambda r: (str(r.asDict().get("k")), r.start)
    assert sorted(alone.collect(), key=key) == sorted(whole.select(*alone.columns).collect(), key=key) and alone.count() == (6 if keys else 3)
    assert {r.ordinal for r in far.collect()} == {1}


def test_chunks_rise_with_keys_and_order(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), F.col("id") % 3)).alias("k"), F.timestamp_micros(F.col("id") % 40 * 333_333).alias("t"), F.col("id"))
    rows = df.withColumn("c", range_chunk(df, ["t", "id"], ["k"], 20)).collect()
    ordered = [r.c for r in sorted(rows, key=lambda r: (r.k or "", r.t, r.id))]
    assert ordered == sorted(ordered) and set(ordered) == set(range(20))
    assert max(ordered.count(c) for c in range(20)) < 1000
    empty = df.where("id < 0")
    assert empty.withColumn("c", range_chunk(empty, ["t", "id"])).count() == 0


def test_chunks_are_found_by_halving(spark):
    """A row is compared with as many boundaries as their number has bits, not with its square root."""
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1009).alias("t"), "id")
    for chunks in (1, 2, 37, 64, 65):
        rows = df.withColumn("c", range_chunk(df, ["t", "id"], ["k"], chunks))
        found = [r.c for r in rows.orderBy("k", "t", "id").collect()]
        assert found == sorted(found) and set(found) == set(range(max(found) + 1)) and max(found) < chunks
        if chunks == 65:
            text = rows._jdf.queryExecution().optimizedPlan().toString()
            assert "filter(" not in text and "from_json" not in text and text.count("<=") == 1
            assert f"[{','.join(str(1 << b) for b in reversed(range(max(found).bit_length())))}]" in text
