"""Scaling: fitted parameters are a table, applying them is a join.

Two families differ in their corner cases.  ``minmax``, ``standard`` and
``robust`` divide by the bare range, the sample deviation or the quartile range,
so a constant column turns into NULL.  ``minmax_guarded`` and
``standard_guarded`` (population deviation) divide by 1 there and give 0.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.profile import missing
from tidemill.operators.quantiles import column_quantiles
from tidemill.plans.sizing import PERCENTILE_LIMIT, attach

METHODS = ("minmax", "standard", "robust", "minmax_guarded", "standard_guarded")
log = logging.getLogger(__name__)


def usable_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that exist; absent ones are reported and skipped."""
    for c in columns:
        if c not in df.columns:
            log.warning("column not found, skipped: %s", c)
    return [c for c in columns if c in df.columns]


def fit_scaler(
    df: DataFrame,
    method: str = "minmax",
    columns: Sequence[str] = ("OT",),
    keys: Sequence[str] = (),
    fit_on: str = "all",
    split_column: str = "split",
    strategy: str = "auto",
    plain_limit: int = PERCENTILE_LIMIT,
) -> DataFrame:
    """Parameter table (keys, column, method, center, scale) from one pass.

    ``fit_on="all"`` uses every row, ``"train"`` only rows of the train split.
    """
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on}")
    columns = usable_columns(df, columns)
    if not columns:
        raise ValueError("no column to scale")
    rows = df.where(F.col(split_column) == "train") if fit_on == "train" else df
    wide = (
        _fit_quartiles(rows, columns, keys, strategy, plain_limit)
        if method == "robust"
        else _fit_moments(rows, columns, keys, method)
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(method).alias("method"),
            F.col(f"center{i}").alias("center"),
            F.col(f"scale{i}").alias("scale"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def _fit_moments(df, columns, keys, method):
    out = []
    for i, c in enumerate(columns):
        x = F.when(~missing(df, c), F.col(c).cast("double"))
        if method.startswith("minmax"):
            center, scale = F.min(x), F.max(x) - F.min(x)
        else:
            center, scale = F.avg(x), F.stddev_pop(x) if method.endswith("guarded") else F.stddev_samp(x)
        if method.endswith("guarded"):
            scale = F.when(scale == 0, F.lit(1.0)).otherwise(scale)
        out += [center.alias(f"center{i}"), scale.alias(f"scale{i}")]
    return df.groupBy(*keys).agg(*out)


def _fit_quartiles(df, columns, keys, strategy, plain_limit):
    """One quantile pass over the rows serves all columns."""
    q = column_quantiles(df, columns, (0.25, 0.5, 0.75), keys, strategy, plain_limit)
    quartile = lambda c, i: F.col(f"__q{c}")[i]
    wide = [
        x for c in range(len(columns))
        for x in (quartile(c, 1).alias(f"center{c}"), (quartile(c, 2) - quartile(c, 0)).alias(f"scale{c}"))
    ]
    return q.select(*keys, *wide)


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), inverse: bool = False) -> DataFrame:
    """Scale ``columns`` with a fitted table, or undo it with ``inverse=True``."""
    columns = usable_columns(df, columns)
    pick = lambda c, field: F.max(F.when(F.col("column") == c, F.col(field)))
    wide = params.groupBy(*keys).agg(
        *[pick(c, f).alias(f"__{f}_{i}") for i, c in enumerate(columns) for f in ("center", "scale")]
    )
    out = attach(df, wide, keys)
    values = {}
    for i, c in enumerate(columns):
        x, center, scale = F.col(c).cast("double"), F.col(f"__center_{i}"), F.col(f"__scale_{i}")
        values[c] = x * scale + center if inverse else F.try_divide(x - center, scale)
    return out.withColumns(values).select(*df.columns)


def scale(df: DataFrame, method: str = "minmax", columns: Sequence[str] = ("OT",), keys: Sequence[str] = (), **options) -> DataFrame:
    """Fit and apply in one call."""
    columns = usable_columns(df, columns)
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    if not columns:
        return df
    return apply_scaler(df, fit_scaler(df, method, columns, keys, **options), columns, keys)
