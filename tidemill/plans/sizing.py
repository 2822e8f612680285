"""Size checks and lineage cuts that the operators choose their plan by.

Nothing is broadcast on hope: a table is written once, counted, and only then
hinted; above the limit the join stays a shuffle join on balanced keys.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A window over one group runs in one task.  Groups up to this many rows may.
PLAIN_LIMIT = 2_000_000
# An exact percentile keeps the distinct values of a group, and of many groups at
# once, in memory.  Groups up to this many rows may.
PERCENTILE_LIMIT = 150_000
# What a broadcast side may hold: rows, and bytes of its (compressed) files.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
# Up to this many bytes a table is dealt over all cores before costly work: it may be one file of one row group.
DEAL_BYTES = 256 << 20


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the biggest group, number of groups); one pass over the key columns."""
    if not keys:
        return df.count(), 1
    top, groups = df.groupBy(*keys).count().agg(F.max("count"), F.count("*")).first()
    return int(top or 0), int(groups)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return group_sizes(df, keys)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pick_strategy(strategy: str, df: DataFrame, keys: Sequence[str], limit: int = PLAIN_LIMIT) -> str:
    """Resolve ``auto`` to ``plain`` (one task per group) or ``ranged`` (balanced)."""
    if strategy == "auto":
        return "plain" if largest_group(df, keys) <= limit else "ranged"
    if strategy not in ("plain", "ranged"):
        raise ValueError(f"unknown strategy: {strategy}")
    return strategy


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/") + "/tidemill"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tidemill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder + "/tidemill"


_written: list[str] = []


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cached frame it survives lost executors, and its columns can be
    pruned by the readers that follow.  :func:`drop_scratch` removes the tables.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the tables this process wrote with :func:`materialize`.

    Call it when the results that read them have been written.
    """
    dropped = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def dealt_if_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table over all cores; a big one has enough partitions and is left alone."""
    if estimated_bytes(df) > DEAL_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def is_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the files and rows of a stored table are few enough for every task."""
    return estimated_bytes(table) <= BROADCAST_BYTES and table.count() <= limit


def hint_if_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of a stored table if its rows and its files are few enough."""
    return F.broadcast(table) if is_small(table, limit) else table


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Materialise a lookup table and hint a broadcast only if it has few rows."""
    return hint_if_small(materialize(df), limit)


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the key columns of ``left`` are kept."""
    renamed = right.select(
        *[F.col(c).alias(f"__{c}") for c in on],
        *[F.col(c) for c in right.columns if c not in on],
    )
    if not on:
        raise ValueError("join_on needs at least one column")
    condition = None
    for c in on:
        same = left[c].eqNullSafe(renamed[f"__{c}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__{c}" for c in on])


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], stored: bool = False) -> DataFrame:
    """Add the columns of a per-key table (one row in all when there are no keys).

    ``stored`` says that ``table`` is read from storage and need not be written again.
    """
    if keys:
        return join_on(df, hint_if_small(table) if stored else broadcast_if_small(table), keys, "left")
    # A single row: one scalar subquery instead of a join.
    row = table.select(F.struct(*[F.col(c) for c in table.columns])).scalar()
    out = df.withColumn("__row", row)
    return out.select(*df.columns, *[F.col("__row")[c].alias(c) for c in table.columns])
