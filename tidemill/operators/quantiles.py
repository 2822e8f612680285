"""Exact, linearly interpolated quantiles for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.plans.sizing import PERCENTILE_LIMIT, attach, materialize, pick_strategy

# Every quantile is bracketed by a sketch whose error is half of NEAR in rank; groups too small for that take FAR around it.
ACCURACY = 5_000
NEAR, FAR, SPARE_ROWS = 2 / ACCURACY, 1 / 32, 4
# A bracket that still holds too many rows is cut by a sketch of its rows, to about three of these cells.
CELLS, CELL_ACCURACY = 256, 2_000


def group_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    keys: Sequence[str],
    strategy: str = "auto",
    plain_limit: int = PERCENTILE_LIMIT,
    partitions: int | None = None,
    bracket_rows: int = PERCENTILE_LIMIT,
) -> DataFrame:
    """One row per group with ``q`` = array of quantiles of the non-missing values, NULL for a group without any.

    See :func:`column_quantiles`.
    """
    q = column_quantiles(df, [value], probs, keys, strategy, plain_limit, partitions, bracket_rows)
    return q.select(*keys, F.col("__q0").alias("q"))


def column_quantiles(
    df: DataFrame,
    values: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str],
    strategy: str = "auto",
    plain_limit: int = PERCENTILE_LIMIT,
    partitions: int | None = None,
    bracket_rows: int = PERCENTILE_LIMIT,
) -> DataFrame:
    """One row per group with ``__q0``, ``__q1`` … = the quantiles of each of the columns ``values``.

    Small groups use the built-in ``percentile``, which holds the distinct values of a group in one task. Bigger ones
    are selected by rank: a sketch brackets every quantile, the rows below and inside each bracket are counted
    exactly, and so on inside the bracket until it holds at most ``bracket_rows`` rows; only those are sorted. No
    group is shuffled whole, and every round is one aggregate that is combined before the shuffle. The rounds read
    a stored table of keys and values, dealt over ``partitions`` if given: all columns of a row at once.
    """
    every = range(len(values))
    cells = [F.when(~F.isnan(x), x).alias(f"__x{c}") for c, x in enumerate(F.col(v).cast("double") for v in values)]
    data = df.select(*keys, *cells)
    probs = [float(p) for p in probs]
    if pick_strategy(strategy, data, keys, plain_limit) == "ranged":
        data = data.repartition(partitions) if partitions else data
        return _selected(materialize(data), len(values), probs, list(keys), bracket_rows)
    if len(values) == 1:
        return data.groupBy(*keys).agg(_builtin("__x0", probs).alias("__q0"))
    # One group a column, so that a task holds the distinct values of one column at a time.
    entries = F.array(*[F.struct(F.lit(c).alias("__c"), F.col(f"__x{c}").alias("__x")) for c in every])
    q = data.select(*keys, F.inline(entries)).groupBy(*keys, "__c").agg(_builtin("__x", probs).alias("__q"))
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("__c") == c, F.col("__q"))).alias(f"__q{c}") for c in every])


def _builtin(x: str, probs: Sequence[float]) -> Column:
    return F.percentile(x, F.array(*[F.lit(p) for p in probs]))


def _points(probs: Sequence[float]) -> list[float]:
    return [min(1.0, max(0.0, p + side)) for p in probs for side in (-FAR, -NEAR, NEAR, FAR)]


def _sketch(x: Column, points: Sequence[float], accuracy: int) -> Column:
    return F.percentile_approx(x, F.array(*[F.lit(p) for p in points]), accuracy)


def _cell(grid: Column, rank: Column, rows: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Values around the ``rank`` (0 at least) of a sketched bracket of so many rows, a cell to spare on both sides."""
    cell = lambda r: F.floor(F.try_divide(r, rows) * CELLS).cast("int")
    return F.coalesce(F.get(grid, cell(F.floor(rank)) - 1), low), F.coalesce(F.get(grid, cell(F.ceil(rank) + 1) + 2), high)


class _Bracket:
    """The columns of one quantile: column ``c`` of the data, probability ``i``."""

    def __init__(self, c: int, i: int, p: float):
        self.c, self.i, self.tag = c, i, f"{c}_{i}"
        self.x, self.n, self.rank = F.col(f"__x{c}"), F.col(f"__n{c}"), F.lit(p) * (F.col(f"__n{c}") - 1)
        self.lo, self.hi, self.min, self.max, self.hit = (F.col(self.name(s)) for s in ("lo", "hi", "min", "max", "hit"))
        self.below, self.upto_lo, self.below_hi, self.upto_hi = (F.col(self.name(s)) for s in self.counts())
        # The rows of both ends are counted: however many have one value, only those between are work.
        self.between = (self.x > self.lo) & (self.x < self.hi)
        inner = (F.ceil(self.rank) >= self.upto_lo) & (F.floor(self.rank) < self.below_hi)
        self.work = F.when(self.hit, F.when(inner, F.greatest(self.below_hi - self.upto_lo, F.lit(0))).otherwise(0)).otherwise(self.n)

    def counts(self) -> dict[str, Column]:
        """Exact numbers of rows below and up to both ends."""
        x, lo, hi = (F.col(n) for n in (f"__x{self.c}", self.name("lo"), self.name("hi")))
        return {"below": F.count_if(x < lo), "uptolo": F.count_if(x <= lo), "belowhi": F.count_if(x < hi), "uptohi": F.count_if(x <= hi)}

    def name(self, side: str) -> str:
        return f"__{side}{self.tag}"

    def first(self) -> list[Column]:
        """The first bracket, from the sketch of all rows; the one to fall back to is the whole group."""
        grid, least, most = (F.col(f"__{s}{self.c}") for s in ("grid", "min", "max"))
        at = lambda k: F.get(grid, F.lit(4 * self.i + k))
        pick = lambda near, far, end: F.when(self.n * NEAR >= SPARE_ROWS, at(near)).when(self.n * FAR >= SPARE_ROWS, at(far)).otherwise(end)
        sides = {"lo": pick(1, 0, least), "hi": pick(2, 3, most), "min": least, "max": most}
        return [value.alias(self.name(side)) for side, value in sides.items()]


def _selected(data, columns, probs, keys, bracket_rows):
    if not keys and data.isEmpty():
        return data.agg(*[F.lit(None).cast("array<double>").alias(f"__q{c}") for c in range(columns)])
    brackets = [_Bracket(c, i, p) for c in range(columns) for i, p in enumerate(probs)]
    sizes = [F.col(f"__n{c}") for c in range(columns)]
    parts = [(F.col(f"__x{c}"), c) for c in range(columns)]
    first = data.groupBy(*keys).agg(
        *[a.alias(f"__{s}{c}") for x, c in parts for s, a in (
            ("n", F.count(x)), ("min", F.min(x)), ("max", F.max(x)), ("grid", _sketch(x, _points(probs), ACCURACY)),
        )]
    )
    # ``min`` and ``max`` of a bracket are the sides of the one before it.
    limits = first.select(*keys, *sizes, *[side for b in brackets for side in b.first()])
    misses = 0
    while True:
        limits = materialize(limits)
        sides = limits.select(*keys, *[x for b in brackets for x in (b.lo, b.hi)])
        counts = attach(data, sides, keys, stored=True).groupBy(*keys).agg(
            *[n.alias(b.name(s)) for b in brackets for s, n in b.counts().items()]
        )
        # A bracket that misses its ranks is widened to the one before it, which holds them.
        hits = {b.name("hit"): ((b.below <= F.floor(b.rank)) & (F.ceil(b.rank) < b.upto_hi)) | (b.n == 0) for b in brackets}
        counted = materialize(attach(limits, counts, keys).withColumns(hits))
        most, missed = counted.agg(
            F.max(F.greatest(*[b.work for b in brackets], F.lit(0))), F.max(F.greatest(*[(~b.hit).cast("int") for b in brackets], F.lit(0)))
        ).first()
        misses += bool(missed)
        if not most or (not missed and (misses > 1 or most <= bracket_rows)):
            break
        if missed:
            widened = {}
            for b in brackets:
                widened |= {b.name("lo"): F.when(b.hit, b.lo).otherwise(b.min), b.name("hi"): F.when(b.hit, b.hi).otherwise(b.max)}
            limits = counted.withColumns(widened).select(*limits.columns)
            continue
        nearer = _narrowed(data, counted, brackets, keys, bracket_rows).select(*limits.columns)
        # Crowded neighbours that no cell can part are sorted as they are: a few distinct values, counted first.
        cut = [x for b in brackets for x in (b.lo, b.hi)]
        if nearer.select(*keys, *cut).exceptAll(counted.select(*keys, *cut)).isEmpty():
            break
        limits = nearer
    return _read_off(data, counted, columns, brackets, keys)


def _narrowed(data, counted, brackets, keys, bracket_rows):
    """Brackets of too many rows cut by a sketch of the rows inside them."""
    wide = counted.select(*keys, *[x for b in brackets for x in (b.lo, b.hi, (b.work > bracket_rows).alias(b.name("wide")))])
    met = attach(data, wide, keys, stored=True)
    points = [c / CELLS for c in range(CELLS + 1)]
    grids = met.groupBy(*keys).agg(
        *[_sketch(F.when(F.col(b.name("wide")) & b.between, b.x), points, CELL_ACCURACY).alias(b.name("grid")) for b in brackets]
    )
    sides = {}
    for b in brackets:
        low, high = _cell(F.col(b.name("grid")), b.rank - b.upto_lo, b.below_hi - b.upto_lo, b.lo, b.hi)
        cut = b.work > bracket_rows
        sides |= {
            b.name("lo"): F.when(cut, low).otherwise(b.lo), b.name("hi"): F.when(cut, high).otherwise(b.hi),
            b.name("min"): F.when(cut, b.lo).otherwise(b.min), b.name("max"): F.when(cut, b.hi).otherwise(b.max),
        }
    return attach(counted, grids, keys).withColumns(sides)


def _read_off(data, limits, columns, brackets, keys):
    """The two rows around each quantile: the ends of its bracket, or by the counts of the values between them."""
    # A bracket without work gets no rows: its ranks are at its ends.
    needed = limits.select(*keys, *[F.when(b.work > 0, x).alias(b.name(s)) for b in brackets for s, x in (("lo", b.lo), ("hi", b.hi))])
    met = attach(data, needed, keys, stored=True)
    open_rows = [b.between for b in brackets]
    some = open_rows[0]
    for more in open_rows[1:]:
        some = some | more
    within = [F.when(held, F.struct(F.lit(j).alias("__b"), b.x.alias("__x"))) for j, (b, held) in enumerate(zip(brackets, open_rows))]
    near = met.where(some).select(*keys, F.inline(F.filter(F.array(*within), lambda s: s.isNotNull())))
    counts = near.groupBy(*keys, "__b", "__x").agg(F.count("*").alias("__rows"))
    upto = F.sum("__rows").over(Window.partitionBy(*keys, "__b").orderBy("__x"))
    ranks = limits.select(*keys, *[F.col(f"__n{c}") for c in range(columns)], *[b.upto_lo for b in brackets])
    ranked = attach(counts.withColumn("__upto", upto), ranks, keys, stored=True)
    found = []
    for j, b in enumerate(brackets):
        last, mine = F.col("__upto") + b.upto_lo, F.col("__b") == j
        holds = lambda rank: mine & (last > rank) & (last - F.col("__rows") <= rank)
        found += [F.max(F.when(holds(f(b.rank)), F.col("__x"))).alias(b.name(s)) for s, f in (("low", F.floor), ("high", F.ceil))]
    picked = ranked.groupBy(*keys).agg(*found)
    met = attach(limits, picked, keys)
    # The arithmetic of the built-in, so that both plans give the same doubles.
    out = []
    for c in range(columns):
        parts = []
        for b in brackets:
            if b.c != c:
                continue
            value = lambda rank, side: F.when(rank < b.upto_lo, b.lo).when(rank >= b.below_hi, b.hi).otherwise(F.col(b.name(side))) + F.lit(0.0)
            at, low, high = b.rank, value(F.floor(b.rank), "low"), value(F.ceil(b.rank), "high")
            between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
            parts.append(F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise(between))
        out.append(F.when(F.col(f"__n{c}") > 0, F.array(*parts)).alias(f"__q{c}"))
    return met.select(*keys, *out)
