"""What the physical plans look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemill.operators import clean, completions, profile, scale, windows
from tidemill.operators.index import series_index
from tidemill.plans import sizing


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join_in_any_query(spark, folder):
    for name, fn in entry.queries().items():
        text = plan(fn(spark, folder))
        assert not re.search(r"Python|ArrowEval|CartesianProduct|BroadcastNestedLoop", text), name


def test_keyed_queries_never_gather_rows_in_one_task(spark, folder):
    for name in ("samples_default", "fill_gaps", "long_windows", "strided_windows", "group_advantage", "lang_labels", "ratio_split"):
        assert "SinglePartition" not in plan(entry.queries()[name](spark, folder)), name


def test_one_long_series_has_no_single_task_window(spark):
    df = spark.range(1000).select(F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    for out in (
        series_index(df, ["t"], strategy="ranged"),
        clean.fill_gaps(df, ["t"], strategy="ranged"),
        windows.strided_windows(df, 5, 2, ["t"], columns=["v"], strategy="ranged"),
    ):
        assert "SinglePartition" not in plan(out)


def test_one_scan_for_all_columns(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    columns = ["l_quantity", "l_discount", "l_tax"]
    for out in (profile.range_profile(lines, columns), scale.fit_scaler(lines, "standard", columns)):
        text = plan(out)
        assert text.count("FileScan") == 1 and "l_comment" not in text and "l_shipdate" not in text


def test_lookup_is_broadcast_only_below_the_limit(spark):
    table = spark.range(50)
    rows = spark.range(1000)
    small = sizing.join_on(rows, sizing.broadcast_if_small(table), ["id"])
    assert "BroadcastHashJoin" in plan(small)
    big = sizing.broadcast_if_small(table, limit=10)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()


def test_text_is_not_shuffled_for_samples(spark, folder):
    text = plan(entry.queries()["samples_default"](spark, folder))
    before = text[text.index("Exchange hashpartitioning"):]
    assert "date_format" not in before and "format_number" not in before


def test_regexes_run_once_per_completion(spark):
    df = spark.createDataFrame([(1, 0, "5", 5.0)], "sample_id INT, generation_id INT, content STRING, true_value DOUBLE")
    text = plan(completions.score_completions(df.repartition(2)))
    assert text.count(r"[-+]?\d*\.?\d+") == 1
    assert text.count("</think>") == text.count("<think>") == 1


def test_strategy_names(spark):
    with pytest.raises(ValueError):
        series_index(spark.range(3), ["id"], strategy="fast")


def test_scratch_tables_can_be_dropped(spark):
    sizing.drop_scratch(spark)
    table = sizing.materialize(spark.range(7))
    assert table.count() == 7
    path = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    import os

    assert os.path.isdir(path)
    assert sizing.drop_scratch(spark) == 1 and not os.path.isdir(path)
    assert sizing.drop_scratch(spark) == 0
