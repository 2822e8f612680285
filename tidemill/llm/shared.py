"""Helpers of the corpus operators: tables in the shared folder, text batches as byte arrays."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A list of ids is sent to every task only up to this many rows (16 bytes each).
ID_ROWS = 1_000_000
#: Rows sent to a Python task at once; texts are long, and a batch is in memory on both sides.
BATCH_ROWS = 500
#: Text bytes worked on at once; a longer text is worked on alone.
SLICE_BYTES = 500_000
#: Key of a row without an id where no id repeats.
LAST_KEY = 2**63 - 1


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or a new one of this machine in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemill-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches brought down to ``BATCH_ROWS`` rows."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)
    return df


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again: survives lost executors, cuts lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table of ``stored`` that no later plan reads, and free shuffle files of plans gone by."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    released(spark)


def released(spark: SparkSession) -> None:
    """Spark deletes shuffle files once the driver has collected the plan that wrote them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def only_ids(df: DataFrame, ids: DataFrame, column: str, anti: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the one-column table ``ids`` (or is not).

    The ids go to every task when they are counted to be at most ``ID_ROWS``; beyond that both sides are shuffled.
    """
    key = ids.columns[0]
    ids = ids.select(F.col(key).alias("_id"))
    if ids.count() <= ID_ROWS:
        ids = F.broadcast(ids)
    return df.join(ids, df[column] == F.col("_id"), "left_anti" if anti else "left_semi")


_IDENTITY = {
    "_none": "doc_id IS NULL", "_id": "coalesce(CAST(doc_id AS BIGINT), 0)", "_digest": "unhex(md5(coalesce(text, '')))",
}


def row_keys(docs: DataFrame) -> DataFrame | None:
    """Stored ``(_none, _id, _digest, _n, _key)``: a key for each pair of id and text and its number of rows.

    Keys rise with the id, null ids last, and among texts of one id with their digest, so every text has a place of
    its own. Rows equal in both share a key. None: no id occurs twice, so ids serve as keys.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY)).alias("_id"))
    if ids.groupBy("_id").count().where("count > 1").isEmpty():
        return None
    pairs = docs.select(*(F.expr(e).alias(c) for c, e in _IDENTITY.items())).groupBy(*_IDENTITY).agg(F.count("*").alias("_n"))
    # Partitions of a sorted table follow each other, and so do the numbers that they give to their rows.
    return stored(pairs.orderBy(*_IDENTITY).withColumn("_key", F.monotonically_increasing_id()), "keys")


def with_keys(docs: DataFrame, keys: DataFrame | None) -> DataFrame:
    """``docs`` with ``_key``, and ``_n`` rows of that key, by the ``keys`` of ``row_keys``."""
    if keys is None:
        return docs.withColumn("_n", F.lit(1).cast("long")).withColumn("_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY)))
    return docs.select("*", *(F.expr(e).alias(c) for c, e in _IDENTITY.items())).join(keys, [*_IDENTITY]).drop(*_IDENTITY)


def plain_names(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but id and text renamed by number, so that helper columns cannot clash with them."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"user_{i}" for i, c in enumerate(docs.columns)))


def text_table(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and ``text`` (and more), whatever other columns there are."""
    return docs.select(*(F.col(c) for c in ("doc_id", "text", *columns)))


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        block, start = np.cumsum(sizes) // limit, 0
        for stop in [*(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]:
            yield batch.slice(start, stop - start)
            start = stop
        del batch, texts
        pa.default_memory_pool().release_unused()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and the offsets where each begins (one more than texts); null is empty."""
    if not pa.types.is_large_binary(texts.type):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def named(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
