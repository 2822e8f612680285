"""Forecast accuracy: per key, per sample, per segment, and error reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import bind
from tidemill.operators.quantiles import group_quantiles
from tidemill.plans.sizing import PERCENTILE_LIMIT, attach, join_on, materialize

# Upper limits of the absolute-error bands.
ERROR_BANDS = {"excellent": 0.05, "good": 0.15, "poor": 0.30}


def known(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x.cast("double"))


def valid_pairs(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Rows in which both sides are known."""
    return df.where(known(F.col(actual)) & known(F.col(predicted)))


def _r2(rule: str, n: Column, ss_res: Column, ss_tot: Column, flat: Column) -> Column:
    usual = 1 - F.try_divide(ss_res, ss_tot)
    if rule == "sequence":
        return F.when(n == 0, F.lit(None)).when(flat, F.lit(0.0)).otherwise(usual)
    if rule == "evaluator":
        perfect = F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        return F.when(n < 2, F.lit(None)).when(flat, perfect).otherwise(usual)
    raise ValueError(f"unknown r2 rule: {rule}")


def forecast_metrics(
    df: DataFrame,
    keys: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "predicted",
    r2_rule: str = "evaluator",
) -> DataFrame:
    """(keys, n, mae, mse, rmse, r2, mape) in one aggregate over the valid pairs.

    Keys without a valid pair keep a row with n = 0 and NULL metrics.  For a constant
    truth, rule ``evaluator`` gives 1 for a perfect forecast and else 0 (and NULL below
    two rows); rule ``sequence`` gives 0.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return metric_rows(df.groupBy(*keys).agg(*metric_sums(y, p)), keys, r2_rule)


def metric_sums(y: Column, p: Column) -> list[Column]:
    ok = known(y) & known(p)
    e = F.when(ok, p - y)
    truth = F.when(ok, y)
    share = F.when(truth == 0, F.when(e == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))).otherwise(
        F.abs(F.try_divide(e, truth))
    )
    return [
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        (F.avg(share) * 100).alias("mape"),
        F.sum(e * e).alias("__res"),
        (F.var_pop(truth) * F.count(truth)).alias("__tot"),
        (F.min(truth) == F.max(truth)).alias("__flat"),
    ]


def metric_rows(sums: DataFrame, keys: Sequence[str], r2_rule: str) -> DataFrame:
    r2 = _r2(r2_rule, F.col("n"), F.col("__res"), F.col("__tot"), F.col("__flat"))
    return sums.select(*keys, "n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"), "mape")


def sequence_metrics(df: DataFrame, truth: str = "truth", predicted: str = "sequence") -> DataFrame:
    """Add mae, rmse and r2 of two arrays cut to their common length, row by row.

    Both arrays are compared in place, without exploding them.  Metrics are NULL
    where nothing was predicted.
    """
    n = F.least(F.size(truth), F.size(predicted))
    t = F.transform(F.slice(F.col(truth), F.lit(1), F.greatest(n, F.lit(0))), lambda x: x.cast("double"))
    p = F.slice(F.col(predicted), F.lit(1), F.greatest(n, F.lit(0)))
    e = F.zip_with(t, p, lambda a, b: a - b)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    work = df.withColumns({"__n": n, "__t": t, "__e": e})
    work = work.withColumns(
        {
            "__abs": total(F.transform("__e", F.abs)),
            "__res": total(F.transform("__e", lambda x: x * x)),
            "__mean": F.try_divide(total(F.col("__t")), F.col("__n")),
        }
    )
    # The lambda may only see its argument and columns, so the mean is a column.
    ss_tot = total(F.transform("__t", lambda x: (x - F.col("__mean")) * (x - F.col("__mean"))))
    r2 = _r2("sequence", F.col("__n"), F.col("__res"), F.col("__tot"), F.col("__tot") == 0)
    any_pair = F.col("__n") > 0
    return (
        work.withColumn("__tot", ss_tot)
        .withColumns(
            {
                "mae": F.when(any_pair, F.col("__abs") / F.col("__n")),
                "rmse": F.when(any_pair, F.sqrt(F.col("__res") / F.col("__n"))),
                "r2": F.when(any_pair, r2),
            }
        )
        .drop("__n", "__t", "__e", "__abs", "__res", "__mean", "__tot")
    )


def sample_results(df: DataFrame, sample: str = "sample_idx", inputs: str = "input_values", truth: str = "truth", predicted: str = "sequence", preview: str = "response_preview") -> DataFrame:
    """Summary row per sample: lengths, preview and metrics."""
    return sequence_metrics(df, truth, predicted).select(
        sample,
        F.size(inputs).alias("input_length"),
        F.size(truth).alias("true_length"),
        F.size(predicted).alias("pred_length"),
        preview, "mae", "rmse", "r2",
    )


def truth_or_targets(parsed_truth: Column, targets: Column) -> Column:
    """Truth parsed from the expected answer, or the stored targets if that failed."""
    return bind(parsed_truth, lambda parsed: F.when(F.size(parsed) > 0, parsed).otherwise(targets))


def macro_average(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean metrics over the samples that have any, and their share."""
    return results.groupBy(*keys).agg(
        F.count("*").alias("n_total"),
        F.count("mae").alias("n_valid"),
        F.avg("mae").alias("mae"),
        F.avg("rmse").alias("rmse"),
        F.avg("r2").alias("r2"),
        F.try_divide(F.count("mae"), F.count("*")).alias("success_rate"),
    )


def point_error(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Add ``error`` and ``rel_error`` in percent (infinite for a truth of zero)."""
    y, p = F.col(actual), F.col(predicted)
    error = F.abs(p - y)
    rel = F.when(y == 0, F.when(error.isNotNull(), F.lit(float("inf")))).otherwise(F.try_divide(error, F.abs(y)) * 100)
    return df.withColumns({"error": error, "rel_error": rel})


def _errors(df, keys, actual, predicted):
    """Errors, NULL where a side is unknown, so that every key keeps a row."""
    error = F.when(known(F.col(actual)) & known(F.col(predicted)), F.col(predicted) - F.col(actual))
    return df.select(*keys, error.alias("__e"))


def error_bounds(lo: Column, hi: Column) -> list[Column]:
    """Ends of the histogram; if all errors are equal the range is widened by one half on both sides."""
    flat = lo == hi
    return [F.when(flat, lo - 0.5).otherwise(lo).alias("__lo"), F.when(flat, hi + 0.5).otherwise(hi).alias("__hi")]


def error_bin(bins: int) -> Column:
    share = (F.col("__e") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins
    return F.least(F.lit(bins - 1), F.floor(share)).cast("int")


def histogram_rows(bounds: DataFrame, counts: DataFrame, bins: int, keys: Sequence[str]) -> DataFrame:
    """All bins of every key of ``bounds`` with their counts, empty ones too."""
    every = F.when(F.col("__lo").isNotNull(), F.sequence(F.lit(0), F.lit(bins - 1)))
    spread = F.explode_outer if keys else F.explode
    frame = bounds.select(*keys, "__lo", "__hi", spread(every).alias("bin"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    return join_on(frame, counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("low"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def error_histogram(
    df: DataFrame, bins: int = 30, keys: Sequence[str] = (), actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """(keys, bin, low, high, n): equal-width bins over [min, max], empty ones too.

    If all errors are equal the range is widened by one half on both sides.  A key
    without errors has one row with a NULL bin and n = 0; without keys and errors there is no row.
    """
    errors = _errors(df, keys, actual, predicted)
    # Bins and empty bins both start from the bounds, so they are stored.
    bounds = materialize(errors.groupBy(*keys).agg(*error_bounds(F.min("__e"), F.max("__e"))))
    counts = attach(errors, bounds, keys, stored=True).where("__e IS NOT NULL").groupBy(*keys, error_bin(bins).alias("bin")).agg(F.count("*").alias("n"))
    return histogram_rows(bounds, counts, bins, keys)


def box_summary(
    df: DataFrame,
    keys: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "predicted",
    strategy: str = "auto",
    plain_limit: int = PERCENTILE_LIMIT,
) -> DataFrame:
    """Quartiles, whiskers at 1.5 quartile ranges and the number of outliers of the errors; NULL without errors."""
    errors = _errors(df, keys, actual, predicted)
    quartiles = error_quartiles(errors, keys, strategy, plain_limit)
    out = attach(errors, quartiles, keys).groupBy(*keys, "q1", "median", "q3").agg(*box_parts())
    return box_rows(out, keys)


def error_quartiles(errors: DataFrame, keys: Sequence[str], strategy: str, plain_limit: int) -> DataFrame:
    q = group_quantiles(errors, "__e", (0.25, 0.5, 0.75), keys, strategy, plain_limit)
    return q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))


def box_parts() -> list[Column]:
    """Aggregates of errors beside their quartiles; they can be merged by least, greatest and sum."""
    reach, e = (F.col("q3") - F.col("q1")) * 1.5, F.col("__e")
    inside_low, inside_high = e >= F.col("q1") - reach, e <= F.col("q3") + reach
    return [
        F.min(F.when(inside_low, e)).alias("whisker_low"),
        F.max(F.when(inside_high, e)).alias("whisker_high"),
        F.count_if(~inside_low | ~inside_high).alias("n_outliers"),
    ]


def box_rows(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A whisker never ends inside the box; a key without errors has none.
    return parts.select(
        *keys, "q1", "median", "q3", F.least("whisker_low", "q1").alias("whisker_low"),
        F.greatest("whisker_high", "q3").alias("whisker_high"), "n_outliers",
    )


def actual_range(df: DataFrame, keys: Sequence[str] = (), actual: str = "actual") -> DataFrame:
    """Ends of the ideal line of an actual/predicted scatter."""
    y = F.when(known(F.col(actual)), F.col(actual))
    return df.groupBy(*keys).agg(F.min(y).alias("actual_min"), F.max(y).alias("actual_max"))


def segment_metrics(
    df: DataFrame, segment: int = 32, keys: Sequence[str] = (), truth: str = "truth", predicted: str = "sequence"
) -> DataFrame:
    """Metrics per horizon segment (step div ``segment``) over all samples of a key."""
    n = F.greatest(F.least(F.size(truth), F.size(predicted)), F.lit(0))
    pairs = F.arrays_zip(
        F.slice(F.col(truth), F.lit(1), n).alias("a"), F.slice(F.col(predicted), F.lit(1), n).alias("p")
    )
    steps = df.select(*keys, F.posexplode(pairs).alias("step", "pair")).select(
        *keys,
        F.floor(F.col("step") / segment).cast("int").alias("segment"),
        F.col("pair.a").alias("actual"),
        F.col("pair.p").alias("predicted"),
    )
    return forecast_metrics(steps, [*keys, "segment"], r2_rule="sequence")


def error_bands(
    df: DataFrame,
    bands: Mapping[str, float] | None = None,
    keys: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "predicted",
) -> DataFrame:
    """(keys, band, n): absolute errors by band, ``beyond`` above the last limit. Rows where a side is unknown have no error."""
    limits = sorted((bands or ERROR_BANDS).items(), key=lambda item: item[1])
    e = F.abs(F.col("__e"))
    band = None
    for name, limit in limits:
        band = F.when(e <= limit, name) if band is None else band.when(e <= limit, name)
    return (
        _errors(df, keys, actual, predicted)
        .where("__e IS NOT NULL")
        .groupBy(*keys, band.otherwise("beyond").alias("band"))
        .agg(F.count("*").alias("n"))
    )
