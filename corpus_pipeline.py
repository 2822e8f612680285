"""The corpus pipeline: documents in, packed pieces out. Counted as part of ``tidemill.llm``.

Every stage works on all that the stage before it kept; what a stage returns is written to the shared folder and
read again, so no stage runs twice and a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.decontaminate import contaminated
from tidemill.llm.near_dup import without_near_duplicates
from tidemill.llm.packing import packed_documents
from tidemill.llm.quality import fit_quality, score_quality
from tidemill.llm.shared import crc_bucket, stored
from tidemill.llm.substring import PASSAGE_WORDS, dedup_substrings

#: Learned models and fuzzy alignments are beyond SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from the labels of its training fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels, train=lambda c: crc_bucket(c, 3) != 1)
    return score_quality(docs, model).where("score >= 0.5").select("row.*")


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group of near duplicates; rows without an id take part, last."""
    return without_near_duplicates(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; ``n_chars`` follows the text. A text cut to nothing stays, empty."""
    names = docs.columns
    cut = dedup_substrings(docs, run_words=PASSAGE_WORDS)
    cut = cut.select(*(F.col("row")[c].alias(c) for c in names if c != "text"), F.col("kept_text").alias("text"), "removed")
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.size("removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*names)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, benchmark).where(F.size("items") == 0).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    return packed_documents(docs)


STAGES = [("quality", quality), ("near_dup", near_dup), ("substrings", substrings), ("decontaminate", decontaminate), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
