"""Filling gaps, removing copies, calendar features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.index import range_chunk
from tidemill.operators.profile import is_float, missing
from tidemill.plans.sizing import PLAIN_LIMIT, broadcast_if_small, join_on, pick_strategy

CHUNK_ROWS = 100_000


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes NULL, the one kind of missing value used downstream."""
    floats = [c for c in (columns or df.columns) if is_float(df, c)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in floats})


def fill_gaps(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    strategy: str = "auto",
    plain_limit: int = PLAIN_LIMIT,
    chunk_rows: int = CHUNK_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Carry the last known value forward, then the first known one backward.

    What is still missing after the forward pass precedes the first known value
    of its series, so the backward pass needs only that one value per series.
    """
    columns = [c for c in (columns or df.columns) if c not in keys and c not in order_by]
    df = nan_to_null(df, columns)
    if pick_strategy(strategy, df, keys, plain_limit) == "plain":
        series = Window.partitionBy(*keys).orderBy(*order_by)
        so_far = series.rowsBetween(Window.unboundedPreceding, 0)
        whole = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.withColumns(
            {c: F.coalesce(F.last(c, True).over(so_far), F.first(c, True).over(whole)) for c in columns}
        )
    return _fill_chunked(df, list(order_by), list(keys), columns, chunk_rows, partitions)


def _fill_chunked(df, order_by, keys, columns, chunk_rows, partitions):
    """Two levels: windows inside range chunks, carries between chunks.

    The rows are shuffled once, to their chunk; the known values at the edges of a chunk are combined map-side.
    """
    rows = df.withColumn("__chunk", range_chunk(df, order_by, keys, partitions, chunk_rows))
    group = [*keys, "__chunk"]

    place = "struct(" + ", ".join(f"`{c}`" for c in order_by) + ")"
    edges = rows.groupBy(*group).agg(
        *[F.expr(f"max_by(`{c}`, {place}) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"__last_{c}") for c in columns],
        *[F.expr(f"min_by(`{c}`, {place}) FILTER (WHERE `{c}` IS NOT NULL)").alias(f"__first_{c}") for c in columns],
    )
    by_chunk = Window.partitionBy(*keys).orderBy("__chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = edges.select(
        *group,
        *[
            F.coalesce(F.last(f"__last_{c}", True).over(before), F.first(f"__first_{c}", True).over(whole)).alias(f"__carry_{c}")
            for c in columns
        ],
    )
    local = Window.partitionBy(*group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    filled = join_on(rows, broadcast_if_small(carry), group, "left").withColumns(
        {c: F.coalesce(F.last(c, True).over(local), F.col(f"__carry_{c}")) for c in columns}
    )
    return filled.select(*df.columns)


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of each group of identical rows; copies collapse before the shuffle."""
    return df.dropDuplicates()


def copy_report(df: DataFrame) -> DataFrame:
    """(n_rows, n_copies): how many rows :func:`drop_copies` removes."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n_copies"),
    )


def clean(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    strategy: str = "auto",
    **options,
) -> DataFrame:
    """Fill gaps, then drop copies, in this order."""
    return drop_copies(fill_gaps(df, order_by, keys, strategy=strategy, **options))


def drop_non_finite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value, counting infinities as missing."""
    columns = list(columns or df.columns)
    ok = F.lit(True)
    for c in columns:
        ok = ok & ~missing(df, c)
        if is_float(df, c):
            ok = ok & (F.abs(F.col(c)) != F.lit(float("inf")))
    return df.where(ok)


def calendar_features(df: DataFrame, time_column: str, strict: bool = True) -> DataFrame:
    """hour, day_of_week (Monday = 0), day_of_month, month and year of a time column.

    With ``strict=False`` an absent column leaves the frame as it is.
    """
    if time_column not in df.columns:
        if strict:
            raise ValueError(f"column not found: {time_column}")
        return df
    if df.schema[time_column].dataType.simpleString() == "string":
        df = df.withColumn(time_column, F.col(time_column).cast("timestamp_ntz"))
    ts = F.col(time_column)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "day_of_month": F.dayofmonth(ts),
            "month": F.month(ts),
            "year": F.year(ts),
        }
    )
