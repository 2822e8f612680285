"""Registered queries of the corpus operators, and their SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import lexical, negatives, rules
from tidemill.llm.decontaminate import contamination
from tidemill.llm.licenses import license_scan
from tidemill.llm.near_dup import near_duplicates
from tidemill.llm.packing import packed_documents
from tidemill.llm.quality import quality_scores
from tidemill.llm.substring import PASSAGE_WORDS, dedup_substrings
from tidemill.llm.suffix import byte_digests
from tidemill.llm.topk import top_k
from tidemill.llm.toxicity import toxicity_scores
from tidemill.llm.warc import archived

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_minhash_near_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op3_substring_dedup", r"""WITH units AS (
  SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '\n|[^.!?\n]+[.!?]*|[.!?]+') AS parts FROM documents)),
keyed AS (SELECT *, trim(regexp_replace(lower(part), '[ \t\r\n\f\v]+', ' ', 'g'), ' ') AS plain FROM units),
ranked AS (SELECT *, plain <> '' AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, pos) > 1 AS again,
  greatest(length(plain) - length(replace(plain, ' ', '')) + 1, length(plain) // 8) AS words FROM keyed),
runs AS (SELECT *, sum(CAST(NOT again AND plain <> '' AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM ranked),
judged AS (SELECT *, again AND sum(words) FILTER (again) OVER (PARTITION BY doc_id, run) >= 25 AS gone FROM runs),
cut AS (SELECT doc_id, sum(length(part)) FILTER (gone) AS removed,
  coalesce(string_agg(part, '' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed, md5(coalesce(c.kept, d.text)) AS kept_md5
FROM documents d LEFT JOIN cut c USING (doc_id)""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_substrings(_table(spark, folder, "documents"), run_words=PASSAGE_WORDS)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(F.col("row.doc_id").alias("doc_id"), gone.alias("n_removed"), F.md5("kept_text").alias("kept_md5"))


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query("op1_exact_top_k", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_table(spark, folder, "embeddings"))


@query("op4_warc", """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to FROM m""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return archived(_table(spark, folder, "pages"))


@query("op10_packing")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(_table(spark, folder, "documents"))


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return byte_digests(_table(spark, folder, "documents"))


@query("op8_license_scan")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: source / language / hundred / id."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return license_scan(docs, path).select(
        F.col("row.doc_id").alias("doc_id"), "path", "license", "cosine", "share", "effective", "directory"
    )


@query("op11_ranked_lexical_search", lexical.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical.ranked_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query("op12_hard_negatives", negatives.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(_table(spark, folder, "embeddings"))


@query("op13_quality_rules", rules.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(_table(spark, folder, "documents"))
