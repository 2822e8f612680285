"""Chronological splits and sample picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.wording import ROWS_PER_MONTH
from tidemill.plans.sizing import attach


def month_split(df: DataFrame, pos: str = "pos", train_months: int = 12, val_months: int = 4, rows_per_month: int = ROWS_PER_MONTH) -> DataFrame:
    """``split`` by position: train, val, and everything after them as test."""
    train = train_months * rows_per_month
    val = train + val_months * rows_per_month
    return df.withColumn(
        "split",
        F.when(F.col(pos) < train, "train").when(F.col(pos) < val, "val").otherwise("test"),
    )


def with_series_size(df: DataFrame, keys: Sequence[str] = (), sizes: DataFrame | None = None) -> DataFrame:
    """Add ``__n``, the number of rows per series, counted here or given as (keys, n)."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("__n")) if sizes is None else sizes.select(*keys, F.col("n").alias("__n"))
    return attach(df, counted, keys)


def ratio_split(
    df: DataFrame,
    train_ratio: float = 0.8,
    ordinal: str = "ordinal",
    keys: Sequence[str] = (),
    purge: bool = False,
    window: int | None = None,
    start: str = "start",
    sizes: DataFrame | None = None,
    stride: int | None = None,
) -> DataFrame:
    """First ``int(n * train_ratio)`` samples are train, the rest val.

    ``purge=True`` also drops train windows that reach into the first val window;
    it needs the window length in rows.  ``sizes`` gives the sample counts (keys, n)
    if they are known, which saves counting the samples; ``stride`` gives the first
    val window without looking for it.
    """
    sized = with_series_size(df, keys, sizes)
    cut = F.floor(F.col("__n") * F.lit(float(train_ratio)))
    out = sized.withColumn("split", F.when(F.col(ordinal) < cut, "train").otherwise("val"))
    if purge:
        if window is None:
            raise ValueError("purge needs the window length")
        if stride is None:
            firsts = out.where(F.col("split") == "val").groupBy(*keys).agg(F.min(start).alias("__cut"))
            out = attach(out, firsts, keys)
        else:
            out = out.withColumn("__cut", F.when(cut < F.col("__n"), F.greatest(cut, F.lit(0)) * stride))
        overlaps = (F.col("split") == "train") & (F.col(start) + window > F.col("__cut"))
        out = out.where(~F.coalesce(overlaps, F.lit(False))).drop("__cut")
    return out.drop("__n")


def ends_and_middle(n: Column) -> Column:
    """The ordinals 0, n // 2 and n - 1, to be cut alone (``wanted`` of ``strided_windows``)."""
    return F.array(F.lit(0).cast("long"), F.floor(n / 2), n - 1)


def first_middle_last(
    df: DataFrame, ordinal: str = "ordinal", keys: Sequence[str] = (), sizes: DataFrame | None = None
) -> DataFrame:
    """The samples 0, n // 2 and n - 1 of each series; ``sizes`` as in :func:`ratio_split`."""
    n = F.col("__n")
    at = F.col(ordinal)
    return with_series_size(df, keys, sizes).where((at == 0) | (at == F.floor(n / 2)) | (at == n - 1)).drop("__n")


def pick(df: DataFrame, ordinals: Sequence[int], ordinal: str = "ordinal") -> DataFrame:
    """The samples with the given ordinals."""
    return df.where(F.col(ordinal).isin([int(i) for i in ordinals]))


def head(df: DataFrame, n: int, ordinal: str = "ordinal") -> DataFrame:
    """The first ``n`` samples of each series."""
    return df.where(F.col(ordinal) < n)


def report_sample(df: DataFrame, id_columns: Sequence[str], n: int = 100, seed: int = 42) -> DataFrame:
    """At most ``n`` rows, repeatable, in id order (a top-k by the MD5 of ids and seed, not a sort)."""
    mark = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns], F.lit(str(seed))))
    chosen = df.orderBy(mark, *id_columns).limit(n)
    return chosen.orderBy(*id_columns)
