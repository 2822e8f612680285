"""Validation and profiling reports, one aggregate pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.wording import ETT_COLUMNS, ETT_ROW_COUNTS
from tidemill.operators.quantiles import group_quantiles
from tidemill.plans.sizing import PERCENTILE_LIMIT, attach


def is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, column: str):
    """True where a value is NULL or, for floats, NaN."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if is_float(df, column) else c.isNull()


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) for every column."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*rows)))


def range_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, min, max, mean) over the non-missing values."""
    stats = []
    for i, c in enumerate(columns):
        x = F.when(~missing(df, c), F.col(c).cast("double"))
        stats += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"avg{i}")]
    wide = df.groupBy(*keys).agg(*stats)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            F.col(f"avg{i}").alias("mean"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def describe(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    strategy: str = "auto",
    plain_limit: int = PERCENTILE_LIMIT,
) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of one column."""
    x = F.when(~missing(df, value), F.col(value).cast("double"))
    base = df.groupBy(*keys).agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    q = group_quantiles(df, value, (0.25, 0.5, 0.75), keys, strategy, plain_limit)
    return attach(base, q, keys).select(
        *keys, "count", "mean", "std", "min",
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max",
    )


def validate_layout(
    df: DataFrame,
    columns: Sequence[str] = ETT_COLUMNS,
    time_column: str = "date",
    target: str = "OT",
    row_counts: Sequence[int] = ETT_ROW_COUNTS,
) -> DataFrame:
    """(check, ok, fatal, detail) rows: columns, row count, times, target.

    An unexpected row count is only a warning, so ``fatal`` is false there; the
    layout is valid when no fatal check failed.
    """
    names = df.columns
    aggs = [F.count("*").alias("n")]
    if time_column in names:
        as_time = F.col(time_column).cast("string").try_cast("timestamp_ntz")
        aggs.append(F.count_if(F.col(time_column).isNotNull() & as_time.isNull()).alias("bad_times"))
    if target in names:
        aggs.append(F.count_if(missing(df, target)).alias("no_target"))
    one = df.agg(*aggs)

    def check(name, ok, fatal, detail):
        return F.struct(
            F.lit(name).alias("check"),
            (ok if not isinstance(ok, bool) else F.lit(ok)).alias("ok"),
            F.lit(fatal).alias("fatal"),
            (detail if not isinstance(detail, str) else F.lit(detail)).cast("string").alias("detail"),
        )

    expected = list(columns)
    rows = [
        check("column_count", len(names) == len(expected), True, str(len(names))),
        check("column_names", names == expected, True, ",".join(names)),
        check("row_count", F.col("n").isin(list(row_counts)), False, F.col("n")),
    ]
    for name, column, agg in (("time_parses", time_column, "bad_times"), ("target_present", target, "no_target")):
        if column in names:
            rows.append(check(name, F.col(agg) == 0, True, F.col(agg)))
        else:
            rows.append(check(name, False, True, f"{column} is absent"))
    return one.select(F.inline(F.array(*rows)))


def layout_is_valid(report: DataFrame) -> bool:
    return report.where(F.col("fatal") & ~F.col("ok")).isEmpty()
