"""Benchmark decontamination: spaced seeds of test items and documents are joined, hits verified around their place."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import dropped, in_batches, named, rows, slices, stored, text_bytes
from tidemill.llm.words import PLACE, mix, plain_words

#: Which of the following words a seed looks at (1) or ignores (0). Together they hit every overlap that counts (tested).
MASKS = ("11111", "1110111", "1101011", "11100101", "101100011")
#: An overlap is this many aligned words (a whole item, if it has fewer), of which so many per cent are equal.
WINDOW, PERCENT = 20, 80
#: Items of fewer words are looked for whole, word by word equal.
MIN_ITEM = 8
#: Up to this many seeds of items go to every task (about 400 bytes each); beyond it both sides are shuffled by seed.
BROADCAST_SEEDS = 50_000
#: Hits of one seed in one task where both sides are shuffled; those of more frequent seeds are dealt over several.
HITS = 100_000
#: The bit table in front of the join has so many bits for each seed of an item, between these powers of two.
SEED_BITS, LEAST_BITS, MOST_BITS = 256, 16, 26
_SEEDS = pa.schema([("seed", pa.int64()), ("item_id", pa.int64()), ("need", pa.int32()), ("least", pa.int32()), ("item_words", pa.binary())])
_HITS = pa.schema([("seed", pa.int64()), ("digest", pa.binary()), ("at", pa.int64()), ("words", pa.binary())])


def _seeds(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, PLACE[32 + number])
    for k, bit in enumerate(mask):
        if bit == "1":
            total += words[k: k + n] * PLACE[k]
    return mix(total)


def _short(n: int) -> tuple[int, str]:
    """Number and mask of the seeds of items of ``n`` words, fewer than ``MIN_ITEM``."""
    return 16 + n, "1" * n


def _surroundings(words: np.ndarray, first: np.ndarray, at: np.ndarray, text: np.ndarray, window: int, outside: int) -> np.ndarray:
    """The ``window - 1`` words before and ``window`` words from each place on; ``outside`` where the text has ended."""
    places = at[:, None] + np.arange(1 - window, window)
    inside = (places >= first[text][:, None]) & (places < first[text + 1][:, None])
    return np.where(inside, words[np.clip(places, 0, max(len(words) - 1, 0))], np.uint64(outside))


def item_seeds(benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """A row per seed of an item: seed, item, words in a window, words that must be equal, and the words around."""

    def run(batches):
        for batch in slices(batches):
            words, first = plain_words(*text_bytes(named(batch, "text")))
            ids, size = np.asarray(named(batch, "item_id")), np.diff(first)
            for number, mask in [*enumerate(MASKS), *map(_short, range(1, MIN_ITEM))]:
                seeds = _seeds(words, mask, number)
                at = np.arange(len(seeds))
                text = np.searchsorted(first, at, "right") - 1
                whole = number >= len(MASKS)
                keep = (size[text] == len(mask)) & (at == first[text]) if whole else (at + len(mask) <= first[text + 1]) & (size[text] >= MIN_ITEM)
                at, text = at[keep], text[keep]
                need = np.minimum(window, size[text]) if not whole else size[text]
                least = need if whole else -(-need * percent // 100)
                for k in range(0, len(at), 2_000):
                    part = slice(k, k + 2_000)
                    around = _surroundings(words, first, at[part], text[part], max(window, MIN_ITEM), 1)
                    yield rows(
                        _SEEDS, seeds[at[part]].view(np.int64).tolist(), ids[text[part]].tolist(), need[part].tolist(), least[part].tolist(),
                        [r.tobytes() for r in around],
                    )

    items = in_batches(benchmark).where("item_id IS NOT NULL AND text IS NOT NULL")
    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "seed long, item_id long, need int, least int, item_words binary"
    )


def _probes(seeds: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of each seed in a table of 2 ** bits."""
    shift = np.uint64(64 - bits)
    return [seeds >> shift, (seeds << np.uint64(20)) >> shift, (seeds * np.uint64(0x9E3779B97F4A7C15)) >> shift]


def _bit_table(seeds: DataFrame, n_seeds: int) -> tuple[np.ndarray, int]:
    """A packed table of the seeds' places, at most 2 ** ``MOST_BITS`` bits; its words are put together in Spark."""
    bits = min(MOST_BITS, max(LEAST_BITS, (n_seeds * SEED_BITS).bit_length()))

    def run(batches):
        for batch in batches:
            places = np.unique(np.concatenate(_probes(np.asarray(named(batch, "seed")).view(np.uint64), bits))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])

    words = seeds.select("seed").mapInArrow(run, "place long").groupBy(F.shiftright("place", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 31 AS INT))")).alias("bits")
    ).toArrow()
    table = np.zeros(1 << bits >> 5, np.uint32)
    table[np.asarray(words.column("word"))] = np.asarray(words.column("bits")).astype(np.uint32)
    return table, bits


def _hits(docs: DataFrame, seeds: DataFrame, n_seeds: int, lengths: list[int], window: int) -> DataFrame:
    """A row per word of a document where a seed stands that items may have: seed, digest of the text, place, words around."""
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(seeds, n_seeds))
    masks = [*enumerate(MASKS), *(_short(n) for n in lengths)]

    def run(batches):
        table, bits = shared.value
        for batch in slices(batches):
            words, first = plain_words(*text_bytes(named(batch, "text")))
            digests = named(batch, "digest")
            for number, mask in masks:
                seen = _seeds(words, mask, number)
                at = np.arange(len(seen))
                for k in range(3):
                    place = _probes(seen[at], bits)[k]
                    at = at[(table[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0]
                text = np.searchsorted(first, at, "right") - 1
                inside = at + len(mask) <= first[text + 1]
                at, text = at[inside], text[inside]
                for k in range(0, len(at), 2_000):
                    part = slice(k, k + 2_000)
                    around = _surroundings(words, first, at[part], text[part], max(window, MIN_ITEM), 0)
                    yield rows(
                        _HITS, seen[at[part]].view(np.int64).tolist(), digests.take(pa.array(text[part])), (at - first[text])[part].tolist(),
                        [r.tobytes() for r in around],
                    )

    texts = in_batches(docs).where("text IS NOT NULL").select("text", F.unhex(F.md5("text")).alias("digest"))
    return texts.mapInArrow(run, "seed long, digest binary, at long, words binary")


def _verified(batches):
    """The (digest, item) pairs whose words, aligned at the hit, have a window with enough equal words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        mine, theirs = (np.frombuffer(b"".join(named(batch, c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("words", "item_words"))
        inside = (mine != 0) & (theirs != 1)
        need, least = np.asarray(named(batch, "need")), np.asarray(named(batch, "least"))
        sums = [np.pad(np.cumsum(x, axis=1), ((0, 0), (1, 0))) for x in (inside, inside & (mine == theirs))]
        good = np.zeros(batch.num_rows, bool)
        for n in np.unique(need):
            some = np.flatnonzero(need == n)
            full, same = (x[some, n:] - x[some, :-n] for x in sums)
            good[some] = ((full == n) & (same >= least[some][:, None])).any(axis=1)
        yield pa.RecordBatch.from_arrays([named(batch, c).filter(pa.array(good)) for c in ("digest", "item_id")], ["digest", "item_id"])


def _dealt(hits: DataFrame, seeds: DataFrame, most: int) -> DataFrame:
    """Stored hits joined with seeds by a shuffle; the hits of a frequent seed are dealt over several tasks, its items copied to them."""
    often = stored(hits.groupBy("seed").count().where(F.col("count") > most).select("seed", F.ceil(F.col("count") / most).cast("int").alias("deals")), "often")
    # At most one row per ``most`` hits.
    often = F.broadcast(often) if often.count() <= BROADCAST_SEEDS else often
    deals = F.coalesce("deals", F.lit(1))
    hits = hits.join(often, "seed", "left").withColumn("deal", F.pmod(F.xxhash64("digest", "at"), deals).cast("int")).drop("deals")
    seeds = seeds.join(often, "seed", "left").withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1))).drop("deals")
    return hits.join(seeds, ["seed", "deal"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT, broadcast_seeds: int = BROADCAST_SEEDS, hits_in_task: int = HITS
) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``items``: the benchmark items it overlaps with, sorted.

    A document overlaps with an item if, with one shift between their words and no insertions, ``window``
    consecutive words (all words of a shorter item) are equal in at least ``percent`` per cent of the places.
    Seeds of items and documents, hashes of the words that one of the ``MASKS`` looks at, are joined; the masks skip
    fixed places, so that single replaced words do not hide a passage. Each side brings the words around its seed, and
    the windows under the shift of the hit are compared there: every overlap has a hit inside of its window. Document
    seeds that no item has are mostly dropped beforehand by a bit table of bounded size. Up to ``broadcast_seeds`` item
    seeds go to every task, so documents are not shuffled; beyond that hits and seeds meet by a shuffle, frequent seeds dealt.

    An item of fewer than ``MIN_ITEM`` words, even of one, must stand in the document whole, with equal words. In scripts
    without spaces every character is a word. Texts without words overlap with nothing. Rows with null or repeated
    ids are judged one by one, by their texts. Empty tables: no rows, or no items. Rows of the benchmark without id or
    text are left out. A text is worked on whole: memory follows the longest, at some 60 bytes a word.
    """
    wide = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.unhex(F.md5("text")).alias("digest"))
    seeds = stored(item_seeds(benchmark, window, percent).distinct(), "seeds")
    n_seeds = seeds.count()
    none = F.array().cast("array<bigint>")
    if not n_seeds:
        return wide.select("row", none.alias("items"))
    lengths = [r.need for r in seeds.where(F.col("need") < MIN_ITEM).select("need").distinct().orderBy("need").collect()]
    # Read again before they are verified: else each task would hold two Python workers, which stay with their executor.
    hits = stored(_hits(docs, seeds, n_seeds, lengths, window), "hits")
    met = hits.join(F.broadcast(seeds), "seed") if n_seeds <= broadcast_seeds else _dealt(hits, seeds, hits_in_task)
    pairs = met.select("digest", "item_id", "need", "least", "words", "item_words").mapInArrow(_verified, "digest binary, item_id long")
    found = stored(pairs.groupBy("digest").agg(F.sort_array(F.collect_set("item_id")).alias("items")), "found")
    dropped(hits)
    few = found.agg(F.count("*"), F.coalesce(F.sum(F.size("items")), F.lit(0))).first()
    if sum(few) <= 2 * BROADCAST_SEEDS:
        found = F.broadcast(found)
    return wide.join(found, "digest", "left").select("row", F.coalesce("items", none).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, items`` for every document."""
    return contaminated(docs, benchmark).select(F.col("row.doc_id").alias("doc_id"), (F.size("items") > 0).alias("contaminated"), "items")
