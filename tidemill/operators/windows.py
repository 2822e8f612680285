"""Strided input/target windows, cut from balanced chunks of each series."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.index import series_index
from tidemill.plans.sizing import PLAIN_LIMIT, attach, group_sizes, shuffle_partitions

MIN_CHUNK_ROWS = 4096


def default_stride(horizon: int) -> int:
    return max(1, horizon // 2)


def whole(number: Column, by: int) -> Column:
    """Integer division."""
    return F.call_function("div", number, F.lit(by).cast("long"))


def strided_windows(
    df: DataFrame,
    length: int,
    horizon: int,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    stride: int | None = None,
    columns: Sequence[str] = ("ts", "value"),
    first: Sequence[str] = (),
    derived: Mapping[str, Callable[[Column], Column]] | None = None,
    extra: Sequence[str] = (),
    pos: str | None = None,
    strategy: str = "auto",
    plain_limit: int = PLAIN_LIMIT,
    chunk_rows: int | None = None,
    partitions: int | None = None,
    head: int | None = None,
    wanted: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per window start 0, s, 2s … with start + length + horizon <= rows.

    ``head=n`` cuts only the first ``n`` windows of each series; rows beyond them are
    filtered by position before they are shuffled to chunks.  ``wanted`` makes the array
    of wanted ordinals from a series' number of windows; only the rows of these windows
    are shuffled, each window to a group of its own, and ordinals outside are ignored.

    Output: keys, ``start``, ``ordinal`` (start / stride), per column ``input_<c>``
    and ``target_<c>`` arrays, and each column of ``first`` at the window's first
    row.  ``pos`` names an existing dense position; otherwise one is computed.

    Rows go to the chunk ``pos div C``, and the first window-1 rows of a chunk also
    to the chunk before it.  Every window then lies inside one chunk, a task holds
    at most C + window - 1 rows at a time, and a row is copied 1 + window/C times
    instead of once per window it belongs to.
    """
    window = length + horizon
    stride = default_stride(horizon) if stride is None else stride
    if length < 1 or horizon < 0 or stride < 1:
        raise ValueError("length and stride must be positive, horizon not negative")
    size = chunk_rows or max(MIN_CHUNK_ROWS, 8 * window)
    if size < window:
        raise ValueError(f"chunk_rows must be at least {window}")

    spread, source = False, df
    if pos is None:
        needed = list(dict.fromkeys([*keys, *order_by, *columns, *first, *extra]))
        df = df.select(*needed)
        if strategy == "auto":
            largest, groups = group_sizes(df, keys)
            strategy = "plain" if largest <= plain_limit else "ranged"
            # Few series would leave the windows, many times their rows, to few tasks.
            spread = strategy == "plain" and groups < 4 * shuffle_partitions(df.sparkSession)
        df = series_index(df, order_by, keys, "__pos", strategy, partitions, plain_limit)
        pos = "__pos"
    if head is not None:
        # What is left is a dense prefix that holds the wanted windows and no other.
        df = df.where(F.col(pos) < ((head - 1) * stride + window if head > 0 else 0))

    if wanted is None:
        home = whole(F.col(pos), size)
        borrowed = (F.pmod(F.col(pos), F.lit(size)) < window - 1) & (home > 0)
        homes = F.when(borrowed, F.array(home, home - 1)).otherwise(F.array(home))
    else:
        counts = window_counts(source, length, horizon, stride, keys)
        known = F.filter(F.array_distinct(wanted(F.col("n"))), lambda o: (o >= 0) & (o < F.col("n")))
        df = attach(df, counts.select(*keys, F.transform(known, lambda o: (o * stride).cast("long")).alias("__wanted")), keys)
        homes = F.filter("__wanted", lambda begin: (F.col(pos) >= begin) & (F.col(pos) < begin + window))
    derived = dict(derived or {})
    arrays = [*columns, *derived]
    fields = list(dict.fromkeys([*columns, *first, *extra]))
    placed = df.select(
        *keys,
        F.explode(homes).alias("__chunk"),
        F.struct(F.col(pos).alias("__at"), *[F.col(c) for c in fields]).alias("__row"),
    )
    if spread:
        placed = placed.repartition(shuffle_partitions(df.sparkSession), *keys, "__chunk")
    chunks = placed.groupBy(*keys, "__chunk").agg(F.sort_array(F.collect_list("__row")).alias("__rows"))

    base = F.col("__chunk") * size if wanted is None else F.col("__chunk")
    begin = whole(base + (stride - 1), stride) * stride
    end = F.least(base + size - 1, base + F.size("__rows") - window)
    starts = F.when(begin <= end, F.sequence(begin, end, F.lit(stride).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    if wanted is not None:
        starts = F.array(base)
    chunks = chunks.select(
        *keys,
        base.alias("__base"),
        *[F.col(f"__rows.{c}").alias(f"__all_{c}") for c in dict.fromkeys([*columns, *first])],
        *[F.transform("__rows", make).alias(f"__all_{c}") for c, make in derived.items()],
        starts.alias("__starts"),
    )
    cut = chunks.select("*", F.explode("__starts").alias("start"))
    offset = (F.col("start") - F.col("__base") + 1).cast("int")
    return cut.select(
        *keys,
        "start",
        whole(F.col("start"), stride).alias("ordinal"),
        *[F.slice(F.col(f"__all_{c}"), offset, F.lit(length)).alias(f"input_{c}") for c in arrays],
        *[F.slice(F.col(f"__all_{c}"), offset + length, F.lit(horizon)).alias(f"target_{c}") for c in arrays],
        *[F.get(F.col(f"__all_{c}"), offset - 1).alias(c) for c in first],
    )


def supervised_pairs(df: DataFrame, length: int, order_by: Sequence[str], keys: Sequence[str] = (), value: str = "value", **options) -> DataFrame:
    """(keys, start, x, y): ``length`` values and the value that follows, stride 1."""
    cut = strided_windows(df, length, 1, order_by, keys, stride=1, columns=[value], **options)
    return cut.select(*keys, "start", F.col(f"input_{value}").alias("x"), F.col(f"target_{value}")[0].alias("y"))


def rolling_frame(df: DataFrame, length: int, order_by: Sequence[str], keys: Sequence[str] = (), timestamp: str = "ts", value: str = "value", **options) -> DataFrame:
    """Each window of ``length`` rows with position, time and value of the next row."""
    cut = strided_windows(df, length, 1, order_by, keys, stride=1, columns=[timestamp, value], **options)
    return cut.select(
        *keys,
        (F.col("start") + length).alias("index"),
        F.col(f"target_{timestamp}")[0].alias("timestamp"),
        F.col(f"target_{value}")[0].alias("actual"),
        F.col(f"input_{timestamp}").alias("input_ts"),
        F.col(f"input_{value}").alias("input_values"),
    )


def window_count(rows, length: int, horizon: int = 1, stride: int | None = None):
    """Closed form of the number of windows over a row-count column."""
    stride = default_stride(horizon) if stride is None else stride
    spare = rows - (length + horizon)
    return F.when(spare >= 0, whole(spare, stride) + 1).otherwise(F.lit(0)).cast("long")


def window_counts(df: DataFrame, length: int, horizon: int = 1, stride: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n): number of windows per series, without cutting them."""
    rows = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return rows.select(*keys, window_count(F.col("__n"), length, horizon, stride).alias("n"))


def window_sweep(df: DataFrame, lengths: Sequence[int], horizon: int = 1, stride: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, length, n_windows) for several input lengths, from row counts alone."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    rows = [
        F.struct(F.lit(n).alias("length"), window_count(F.col("__n"), n, horizon, stride).alias("n_windows"))
        for n in lengths
    ]
    return counts.select(*keys, F.inline(F.array(*rows)))
