"""Usage telemetry reports, over a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import bind


def usage_percent(used: Column, total: Column) -> Column:
    return F.try_divide(used, total) * 100


def order_bits(x: Column) -> Column:
    """A long that orders like the double ``x``: exponent and fraction, negated below zero; NaN is the greatest."""
    size = F.abs(x.cast("double"))
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022))
    # A logarithm may be off by one at a power of two; powers of two themselves are exact.
    exact = lambda e: F.greatest(F.when(size < power(e), e - 1).when(size >= power(e + 1), e + 1).otherwise(e), F.lit(-1022))
    bits = lambda e: (e + 1023).cast("long") * F.lit(1 << 52) + ((size / power(e) - 1) * float(1 << 52)).cast("long")
    top = F.lit(2047 << 52)
    plain = bind(guess, lambda g: bind(exact(g), bits))
    whole = F.when(F.isnan(size), top + 1).when(size == float("inf"), top).when(size == 0, F.lit(0).cast("long")).otherwise(plain)
    return F.when(x < 0, -whole).otherwise(whole)


def _report(at: Column, used: Column, total: Column) -> list[Column]:
    # The first of several equal maxima is the peak. Usage and time make one number of fixed length, because an
    # aggregate whose buffer holds a struct has to sort its rows. Exact for times below 2^87 seconds.
    wide = lambda c: order_bits(c).cast("decimal(19,0)")
    first = wide(used) * F.lit(Decimal(10) ** 19) - F.coalesce(wide(at), F.lit(Decimal(2047 << 52)))
    return [
        F.count("*").alias("n_measurements"),
        F.max(at).alias("duration"),
        F.max_by(at, first).alias("peak_timestamp"),
        F.max(used).alias("peak_used_mb"),
        F.max_by(usage_percent(used, total), first).alias("peak_usage_percent"),
        F.avg(used).alias("mean_used_mb"),
    ]


def telemetry_report(
    df: DataFrame, keys: Sequence[str] = (), timestamp: str = "timestamp", used: str = "used_mb", total: str = "total_mb"
) -> DataFrame:
    """Number of measurements, duration, peak row and mean usage.

    ``timestamp`` is the number of seconds since the start of the run.
    """
    return df.groupBy(*keys).agg(*_report(F.col(timestamp), F.col(used), F.col(total)))


def telemetry_stream(
    df: DataFrame,
    time_column: str,
    window: str = "1 hour",
    late: str = "1 hour",
    keys: Sequence[str] = (),
    used: str = "used_mb",
    total: str = "total_mb",
) -> DataFrame:
    """The same report per tumbling window; rows later than ``late`` are dropped.

    Works on a stream and on a table.  Watermarks need a zoned timestamp, so set the
    session time zone to UTC for naive times.
    """
    at = F.col(time_column).cast("timestamp")
    rows = df.withColumn("__time", at).withWatermark("__time", late)
    seconds = F.unix_micros("__time") / 1e6
    span = F.window("__time", window)
    return (
        rows.groupBy(span.alias("__w"), *keys)
        .agg(*_report(seconds, F.col(used), F.col(total)))
        .select(F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *keys,
                "n_measurements", "peak_timestamp", "peak_used_mb", "peak_usage_percent", "mean_used_mb")
    )
