"""Ranked lexical search the other way round: items wait in an inverted index, documents stream past it."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import in_batches, named, rows, slices, stored

#: Bytes of the postings of one block of items; more items are searched for in more passes over the documents.
INDEX_BYTES = 64 << 20
#: Cells of documents by items that are scored at once, and bytes of a text that are split into words at once.
CELLS, PIECE = 1 << 20, 1 << 20
#: Heaps of a task are merged with those of the tasks of its share first, then all shares of an item.
SHARES = 64
#: Letters and digits stay, A-Z become a-z, bytes of other scripts stay; the rest of ASCII separates terms.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes | None):
    """The terms of a text in lists, so that a long text is never held as words as a whole."""
    plain, at = (text or b"").translate(_PLAIN), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(text: bytes | None, among=None) -> tuple[int, Counter]:
    """Number of terms of a text, and how often each occurs (of those in ``among``, if given)."""
    n, found = 0, Counter()
    for words in terms(text):
        n += len(words)
        found.update(words if among is None else filter(among.__contains__, words))
    return n, found


_ITEMS = pa.schema([("item_id", pa.int64()), ("digest", pa.string()), ("term", pa.binary()), ("times", pa.int64())])


def _item_terms(batches):
    for batch in batches:
        for part in slices([batch]):
            ids, digests, texts = (named(part, c).to_pylist() for c in ("item_id", "digest", "text"))
            counted = [(i, d, t, n) for i, d, x in zip(ids, digests, texts) for t, n in sorted(term_counts(x)[1].items())]
            yield rows(_ITEMS, *([r[k] for r in counted] for k in range(4)))


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])


def _document_terms(vocabulary):
    """Per document its number of terms, and number and count of each of its terms that any item holds."""

    def run(batches):
        number = vocabulary.value
        for part in slices(batches):
            counted = [term_counts(x, number) for x in named(part, "text").to_pylist()]
            yield rows(
                _COUNTS, named(part, "doc_id"), [n for n, _ in counted],
                [[number[t] for t in c] for _, c in counted], [list(c.values()) for _, c in counted],
            )

    return run


class Index:
    """Postings of a block of items: per term its weight, and the items that hold it with their counts."""

    def __init__(self, n_items: int, term: np.ndarray, item: np.ndarray, times: np.ndarray, weight: np.ndarray, documents: int, length: int):
        order = np.argsort(term, kind="stable")
        self.items, self.times = item[order], times[order]
        self.first = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.n_items, self.weight, self.documents, self.length = n_items, weight, documents, length

    def scores(self, n: list[int], document: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Documents by items, in 64-bit integers; ``document``, ``term`` and ``tf`` are the terms of all documents."""
        # Python's integers: the product may pass 64 bits.
        m = np.array([75 + 25 * x * self.documents // self.length for x in n], np.int64)
        gain = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[document]))
        held = self.first[term + 1] - self.first[term]
        total = np.zeros(len(n) * self.n_items, np.int64)
        at = np.repeat(self.first[term] - np.cumsum(held) + held, held) + np.arange(held.sum())
        np.add.at(total, np.repeat(document, held) * self.n_items + self.items[at], np.repeat(gain, held) * self.times[at])
        return total.reshape(len(n), self.n_items)


class Heaps:
    """The ``k`` best documents of every item so far; what comes in is cut to them whenever it outgrows them."""

    def __init__(self, n_items: int, k: int):
        self.k, self.n_items, self.floor = k, n_items, np.ones(n_items, np.int64)
        self.held, self.size = [], 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        self.held.append((item, scores[doc, item], missing[doc], ids[doc]))
        self.size += len(doc)
        if self.size > 2 * self.k * self.n_items + CELLS // 4:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Sorted by item, best first, ties by id (rows without one last). An item with ``k`` raises its floor."""
        item, score, missing, ids = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((ids, missing, -score, item))
        item, score, missing, ids = (x[order] for x in (item, score, missing, ids))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.floor[item[full]] = score[full]
        keep = place < self.k
        self.held = [(item[keep], score[keep], missing[keep], ids[keep])]
        self.size = int(keep.sum())
        return self.held[0]


_BEST = pa.schema([("item", pa.int64()), ("share", pa.int32()), ("score", pa.int64()), ("doc_id", pa.int64())])


def _streamed(index, k: int):
    def run(batches):
        found = index.value
        heaps, step = Heaps(found.n_items, k), max(1, CELLS // found.n_items)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                n, ids, held, tf = (named(part, c) for c in ("n", "doc_id", "terms", "tf"))
                size = np.asarray(held.value_lengths(), np.int64)
                missing = np.asarray(ids.is_null())
                scores = found.scores(
                    n.to_pylist(), np.repeat(np.arange(len(size)), size), np.asarray(held.flatten(), np.int64), np.asarray(tf.flatten(), np.int64)
                )
                heaps.add(scores, np.asarray(ids.fill_null(0), np.int64), missing)
        item, score, missing, ids = heaps.cut()
        share = np.full(len(item), TaskContext.get().partitionId() % SHARES)
        yield rows(_BEST, item, share, score, pa.array(ids, pa.int64(), mask=missing.astype(bool)))

    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``item_id, item_digest, rank, doc_id, score``: the ``k`` best documents of every item, scores above 0 only.

    The items' terms are numbered and sent to all tasks in blocks of at most about ``INDEX_BYTES`` (an item with a
    longer text is a block of its own size). Documents are split into terms once a block; their counts of the items'
    terms are stored and give the totals and the number of documents of each term. Then the counts of every document
    run through the inverted index, where each task keeps one bounded heap per item, and the heaps are merged, those
    of one share of the tasks first. Nothing is left out: a document meets every item that shares a term with it.

    Null and empty texts have no terms: such documents count nowhere and such items have no rows. Rows equal in id and
    text are one item; different texts under one id (null is an id too) are items apart, told by ``item_digest``, the
    text's MD5. Each row of ``docs`` is a document; equal scores go by id, rows without an id last. Other columns are
    ignored. Empty tables give no rows. Memory of a task follows its longest text, which is split piece by piece.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.col("text").cast("binary").alias("text"))
    counted = in_batches(texts).mapInArrow(_item_terms, "item_id long, digest string, term binary, times long")
    # Repeated rows of an item are one.
    asked = stored(counted.distinct(), "items")
    size = asked.agg(F.sum(F.length("term") + 40)).first()[0] or 0
    blocks = -(-size // INDEX_BYTES)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "digest"), F.lit(blocks)) == block).toArrow()
        words, term = np.unique(np.array(mine.column("term").to_pylist(), object), return_inverse=True)
        names = list(zip(mine.column("item_id").to_pylist(), mine.column("digest").to_pylist()))
        number = {name: i for i, name in enumerate(dict.fromkeys(names))}
        vocabulary = context.broadcast({w: i for i, w in enumerate(words)})
        counts = stored(source.mapInArrow(_document_terms(vocabulary), "doc_id long, n long, terms array<int>, tf array<long>"), "counts")
        total = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
        if not total["length"]:
            break
        n = F.lit(total["documents"])
        spread = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.ln((2 * n + 2) / (2 * F.col("df") + 1))).alias("weight")
        weighed = spread.select("term", weight).toArrow()
        weights = np.zeros(len(words), np.int64)
        weights[np.asarray(weighed.column("term"))] = np.asarray(weighed.column("weight"))
        held = np.array([number[x] for x in names], np.int64)
        index = context.broadcast(Index(len(number), term, held, np.asarray(mine.column("times")), weights, total["documents"], total["length"]))
        best = counts.mapInArrow(_streamed(index, k), "item long, share int, score long, doc_id long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for keys in (["item", "share"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        asked_for = pa.table({"item": list(number.values()), "item_id": [i for i, _ in number], "item_digest": [d for _, d in number]})
        known = spark.createDataFrame(asked_for.cast(pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("item_digest", pa.string())])))
        found.append(stored(best.join(F.broadcast(known), "item").select("item_id", "item_digest", "rank", "doc_id", "score"), "ranked"))
        vocabulary.unpersist()
        index.unpersist()
    schema = "item_id long, item_digest string, rank int, doc_id long, score long"
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f.stored_path for f in found))


#: The same ranking over views ``documents`` and ``benchmark``.
SQL = r"""WITH words AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM words WHERE len(w) > 0),
tf AS (SELECT place, doc_id, n, term, count(*) AS tf FROM (SELECT place, doc_id, len(w) AS n, unnest(w) AS term FROM words) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, totals GROUP BY term, docs),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scored AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, place, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20"""
