"""Readers and writers of series, parameters, samples and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.wording import ETT_COLUMNS
from tidemill.operators.profile import missing
from tidemill.plans.sizing import materialize

SERIES_SCHEMA = "timestamp TIMESTAMP_NTZ, value DOUBLE"
ETT_SCHEMA = "date TIMESTAMP_NTZ, " + ", ".join(f"{c} DOUBLE" for c in ETT_COLUMNS[1:])
SAMPLE_SCHEMA = "instruction STRING, output STRING, input_values ARRAY<DOUBLE>, target_values ARRAY<DOUBLE>"
PREDICTION_SCHEMA = "index BIGINT, timestamp STRING, actual DOUBLE, predicted DOUBLE, response STRING"
_RECORD = "__record"
# CSV text spans lines and holds quotes; doubling them is what other readers expect.
CSV_TEXT = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}


def read_series_csv(spark: SparkSession, path: str, schema: str | T.StructType = SERIES_SCHEMA) -> DataFrame:
    """Series with a header row and a declared schema.

    A header whose names or order differ from the schema, or a cell of another type,
    is an error when the rows are read.  Declare the time column as STRING to keep
    its text unchanged in samples.
    """
    return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


def read_multivariate_csv(
    spark: SparkSession, path: str, schema: str | T.StructType = ETT_SCHEMA, target: str = "OT"
) -> DataFrame:
    """Typed multivariate series; a missing target value is an error, whatever columns are read later."""
    df = read_series_csv(spark, path, schema)
    df = df.withColumn(target, F.col(target).cast("double"))
    # A condition on the rows, not on a column: no plan can prune it, and the file is read once.
    none = F.raise_error(F.lit(f"column {target} has missing values")).cast("boolean")
    return df.where(F.when(missing(df, target), none).otherwise(F.lit(True)))


def load_series_csv(
    spark: SparkSession, path: str, schema: str = SERIES_SCHEMA, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a series file that may hold bad rows.

    Every cell is parsed once and the result stored, so that no later plan can prune a check.  A row with a malformed
    cell, or without a value in a ``required`` column, goes to ``rejects`` (file, record, reason); the record is its
    text, or its values as JSON where only a value is missing.  A header that differs from the schema is an error.
    """
    reader = spark.read.schema(f"{schema}, {_RECORD} STRING").options(header=True, enforceSchema=False, columnNameOfCorruptRecord=_RECORD)
    df = reader.csv(path).withColumn("__file", F.col("_metadata.file_path"))
    columns = [c for c in df.columns if c not in (_RECORD, "__file")]
    reason = F.when(F.col(_RECORD).isNotNull(), F.lit("malformed"))
    for c in required:
        reason = reason.when(missing(df, c), F.lit(f"no {c}"))
    told = materialize(df.withColumn("__reason", reason))
    record = F.coalesce(F.col(_RECORD), F.to_json(F.struct(*columns)))
    rejects = told.where("__reason IS NOT NULL").select(F.col("__file").alias("file"), record.alias("record"), F.col("__reason").alias("reason"))
    return told.where("__reason IS NULL").select(*columns), rejects


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions with ``actual`` and ``predicted``; responses may span lines.

    Such files cannot be split, so large tables should have many files or be Parquet.
    """
    return spark.read.schema(PREDICTION_SCHEMA).options(**CSV_TEXT).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV parts with a header; text is quoted so that line breaks survive."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_scaler(params: DataFrame, path: str, mode: str = "error") -> None:
    """Scaler parameters as JSON lines."""
    params.write.mode(mode).json(path)


def read_scaler(spark: SparkSession, path: str, keys: str = "") -> DataFrame:
    """Scaler parameters; ``keys`` declares the key columns, e.g. ``"k STRING"``."""
    fields = "column STRING, method STRING, center DOUBLE, scale DOUBLE"
    return spark.read.schema(f"{keys}, {fields}" if keys else fields).json(path)


def write_samples(df: DataFrame, path: str, format: str = "json", partition_by: Sequence[str] = (), mode: str = "error") -> None:
    """Samples as JSON lines or in columnar form; ``partition_by`` lays out splits."""
    if format not in ("json", "columnar"):
        raise ValueError(f"unknown sample format: {format}")
    writer = df.write.mode(mode).partitionBy(*partition_by)
    writer.json(path) if format == "json" else writer.parquet(path)


def read_samples(spark: SparkSession, path: str, format: str = "json", schema: str = SAMPLE_SCHEMA, array: bool = False) -> DataFrame:
    """Samples written by :func:`write_samples`.

    ``array=True`` reads files that hold one JSON array; such a file is one task's
    work, so convert it to lines once.
    """
    if format == "columnar":
        return spark.read.parquet(path)
    if format != "json":
        raise ValueError(f"unknown sample format: {format}")
    return spark.read.schema(schema).option("multiLine", array).json(path)


def write_text_artifacts(df: DataFrame, path: str, id_columns: Sequence[str], kinds: dict[str, str], mode: str = "error") -> None:
    """Texts of each sample, one folder per kind (prompt, response, truth …)."""
    text_artifacts(df, id_columns, kinds).write.mode(mode).partitionBy("kind").json(path)


def text_artifacts(df: DataFrame, id_columns: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """(id_columns, kind, text) with one row per sample and kind."""
    rows = [F.struct(F.lit(kind).alias("kind"), F.col(c).alias("text")) for kind, c in kinds.items()]
    return df.select(*id_columns, F.inline(F.array(*rows)))


def write_split(df: DataFrame, path: str, format: str = "csv", split: str = "split", mode: str = "error") -> None:
    """One folder per split, written in one job."""
    writer = df.write.mode(mode).partitionBy(split)
    if format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif format == "json":
        writer.json(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {format}")


def write_report(df: DataFrame, path: str, mode: str = "error") -> None:
    """Result rows as JSON lines."""
    df.write.mode(mode).json(path)
