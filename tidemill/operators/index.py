"""Dense positions of rows within their series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.plans.sizing import PLAIN_LIMIT, broadcast_if_small, join_on, pick_strategy, shuffle_partitions

# Rows of a range chunk, chunks at most (their boundaries are literals of the plan), and rows sampled for each boundary.
CHUNK_ROWS = 1_000_000
MAX_CHUNKS = 10_000
SAMPLED = 30
# Boundaries keep microseconds and the offset of their time zone.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def series_index(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    pos: str = "pos",
    strategy: str = "auto",
    partitions: int | None = None,
    plain_limit: int = PLAIN_LIMIT,
) -> DataFrame:
    """Add ``pos`` = 0, 1, 2 … in the order of ``order_by`` within each series.

    ``order_by`` must order the rows of a series totally (end it with a tie-break
    column).  Series of at most ``plain_limit`` rows are numbered by a window.
    Longer ones are cut into range chunks over (keys, order) so that neither a long
    series nor a crowded time stamp ends in one task; see :func:`range_chunk`.
    """
    if pick_strategy(strategy, df, keys, plain_limit) == "plain":
        window = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumn(pos, F.row_number().over(window).cast("long") - 1)
    return _ranged_index(df, list(order_by), list(keys), pos, partitions)


def range_chunk(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), partitions: int | None = None, chunk_rows: int = CHUNK_ROWS) -> Column:
    """The number of the chunk a row lies in, as a function of (keys, order) alone.

    The boundaries are drawn once, from a sample of bounded size, and become literals: whatever is computed from the
    chunk later, in whichever job or attempt, agrees on it, so the rows need not be stored.  Chunk numbers rise with
    (keys, order); a long series and a crowded time stamp are cut by the columns that follow in ``order_by``.  There are
    ``partitions`` chunks, or as many as the rows need at ``chunk_rows`` each (a few per shuffle partition at least).
    """
    place = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([*keys, *order_by])])
    rows = df.select(place.alias("place"))
    total = rows.count()
    chunks = partitions or min(MAX_CHUNKS, max(4 * shuffle_partitions(df.sparkSession), -(-total // chunk_rows)))
    if total > SAMPLED * chunks:
        rows = rows.sample(SAMPLED * chunks / total, seed=1)
    lowest = rows.repartitionByRange(chunks, "place").groupBy(F.spark_partition_id().alias("p")).agg(F.min("place").alias("place"))
    drawn = [r.text for r in lowest.orderBy("p").select(F.to_json("place", _JSON).alias("text")).collect()][1:]
    if not drawn:
        return F.lit(0)

    # A boundary that loses precision as text is still a boundary: only the order matters.
    schema = f"array<{rows.schema['place'].dataType.simpleString()}>"
    edges = F.sort_array(F.from_json(F.lit("[" + ",".join(drawn) + "]"), schema, _JSON))
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(drawn).bit_length()))])

    def last(here: Column) -> Column:
        """The last boundary up to ``here`` (-1: none), by halving; beyond the last there is no boundary, so no step."""
        return F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(edges, at + step) <= here, at + step).otherwise(at))

    # The place is made once a row, not once a comparison.
    # The place is made once a row, not once a comparison.
    return F.transform(F.array(place), last)[0] + 1


def _ranged_index(df, order_by, keys, pos, partitions):
    """Numbers inside range chunks, plus the rows of the series in earlier chunks.

    Counting reads the columns of ``keys`` and ``order_by`` only; the rows are shuffled once, to their chunk, and not
    stored.  ``df`` must give the same rows whenever it is evaluated.
    """
    rows = df.withColumn("__chunk", range_chunk(df, order_by, keys, partitions))
    runs = rows.groupBy(*keys, "__chunk").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    # At most one run per series plus one per chunk.
    runs = runs.select(*keys, "__chunk", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    local = F.row_number().over(Window.partitionBy(*keys, "__chunk").orderBy(*order_by))
    indexed = join_on(rows.withColumn("__local", local), broadcast_if_small(runs), [*keys, "__chunk"])
    return indexed.select(*df.columns, (F.col("__before") + F.col("__local") - 1).cast("long").alias(pos))
