"""Exact removal of repeated byte strings: prefix doubling on sampled positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import dropped, in_batches, named, only_ids, released, row_keys, rows, slices, stored, text_bytes, with_keys
from tidemill.llm.words import PLACE, mix, prefix_sums, spans

#: Bytes of a repeat, and of the first rank.
LENGTH, GRAM = 100, 32
_REACH = LENGTH - GRAM + 1
_HIGH, _LOW, _MOST = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF), np.uint64(2**64 - 1)
#: Bits of the table that says which first ranks occur more than once: 8 MB whatever the input.
_TABLE_BITS = 26
_SLICE = 1_000_000
#: Runs with one anchor rank that a single task compares; more of them go by the ranks of single windows.
TOGETHER = 2_000

_RUN = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])
_RUNS = "h long, c long, doc long, at long"


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of x[i : i + size] for every i; beyond the end counts as the largest value."""
    padded = np.full(-(-(len(x) + size) // size) * size, _MOST)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, size)
    before = np.minimum.accumulate(blocks, 1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[: len(x)], before[size - 1: size - 1 + len(x)])


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(sums, first window, last window, anchor, rank of the anchor, text) of every run of windows.

    A window is a byte string of LENGTH inside a text, its anchor the leftmost of its GRAM-byte strings with the
    smallest fingerprint. The anchor depends on the window's bytes alone, so equal windows have equal anchors at
    equal places. Windows with one anchor are a run; about one position in 35 is an anchor.
    """
    sums, n = prefix_sums(raw), len(raw)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return sums, none, none, none, np.zeros(0, np.uint64), none
    at = np.arange(n - GRAM + 1)
    gram = spans(sums, at, at + GRAM)
    end = np.repeat(offsets[1:], np.diff(offsets))
    key = np.where(at + GRAM <= end[: len(at)], (gram & _HIGH) | at.astype(np.uint64), _MOST)
    lowest = _sliding_min(key, _REACH)
    window = np.flatnonzero(np.arange(n) + LENGTH <= end)
    anchor = (lowest[window] & _LOW).astype(np.int64)
    if not len(window):
        return sums, window, window, anchor, np.zeros(0, np.uint64), window
    begins = np.ones(len(window), bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(window) > 1)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(window)) - 1
    return sums, window[first], window[last], anchor[first], gram[anchor[first]], np.searchsorted(offsets, window[first], "right") - 1


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document joined where they touch."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    group = np.cumsum(new) - 1
    # The farthest end so far, kept apart per document by a shift.
    shift = int(end.max()) + 1
    far = np.maximum.accumulate(end + group * shift)
    new[1:] |= start[1:] + group[1:] * shift > far[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], far[last] - group[last] * shift


def _later(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first among those with equal keys, by (doc, start), and rows that come later.

    Rows at the place of the first one are its repetitions and in neither.
    """
    order = np.lexsort((start, doc, *keys[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], 0)
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    later = (doc[order] != doc[lead]) | (start[order] != start[lead])
    return order[new], order[later]


def _cut_rows(doc, start, end) -> pa.RecordBatch:
    """Removed intervals as rows of the run schema: the place is negative, the second key holds the end."""
    doc, start, end = _merged(doc, start, end)
    return rows(_RUN, doc * 31 + start, end, doc, -1 - start)


_COUNT = pa.schema([("h", pa.int64()), ("n", pa.int64())])


def _ranks(batches: Iterator[pa.RecordBatch]):
    for batch in slices(batches, _SLICE):
        ranks, counts = np.unique(anchors(*text_bytes(named(batch, "text")))[4], return_counts=True)
        yield rows(_COUNT, ranks.view(np.int64), np.minimum(counts, 2))


def _table(docs: DataFrame) -> np.ndarray:
    """One bit per hash of a first rank, set if a rank with that hash occurs more than once.

    It only spares unique positions the further rounds; a bit shared with a repeated rank costs work, no result.
    Its words are put together by Spark and their number is fixed.
    """
    often = docs.mapInArrow(_ranks, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    slot = F.shiftrightunsigned("h", 64 - _TABLE_BITS)
    words = often.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - _TABLE_BITS}) & 63 AS INT))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (_TABLE_BITS - 6), np.uint64)
    table[np.asarray(got.column("word"), np.int64)] = np.asarray(got.column("bits"), np.int64).view(np.uint64)
    return table


def _runs(table):
    def run(batches):
        for batch in slices(batches, _SLICE):
            raw, offsets = text_bytes(named(batch, "text"))
            sums, lo, hi, p, rank, text = anchors(raw, offsets)
            if not len(lo):
                continue
            slot = rank >> np.uint64(64 - _TABLE_BITS)
            often = (table.value[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
            lo, hi, p, rank, text = (x[often] for x in (lo, hi, p, rank, text))
            c = mix(spans(sums, lo, hi + LENGTH) + (p - lo).astype(np.uint64) * PLACE[40] + (hi - lo).astype(np.uint64) * PLACE[41]).view(np.int64)
            doc = named(batch, "key").to_numpy()[text]
            start = lo - offsets[text]
            h = rank.view(np.int64)
            first, later = _later([h, c], doc, start)
            place = (start << 14) | ((p - lo) << 7) | (hi - lo)
            yield rows(_RUN, h[first], c[first], doc[first], place[first])
            if len(later):
                yield _cut_rows(doc[later], start[later], (start + hi - lo)[later] + LENGTH)

    return run


def _whole(batches) -> list[np.ndarray]:
    """All rows of a partition as arrays."""
    got = pa.Table.from_batches(list(batches), _RUN)
    return [np.asarray(got.column(c).combine_chunks()) if got.num_rows else np.zeros(0, np.int64) for c in _RUN.names]


def _settled(batches):
    """Runs with equal bytes and windows: all but the first are removed whole."""
    h, c, doc, at = _whole(batches)
    cut = at < 0
    if cut.any():
        yield _cut_rows(doc[cut], -1 - at[cut], c[cut])
    h, c, doc, at = (x[~cut] for x in (h, c, doc, at))
    start = at >> 14
    first, later = _later([h, c], doc, start)
    yield rows(_RUN, h[first], c[first], doc[first], at[first])
    if len(later):
        yield _cut_rows(doc[later], start[later], start[later] + (at[later] & 127) + LENGTH)


def _opened(batches):
    """(text slice, places of its open runs, text of each place)."""
    for batch in slices(batches, _SLICE):
        places = named(batch, "places")
        at = np.asarray(places.flatten(), np.int64)
        yield batch, at, np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(places), np.int64))


def _exploded(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every window of the runs ``at``: number of its run, and its place in it."""
    size = (at & 127) + 1
    return np.repeat(np.arange(len(at)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


_HALF = LENGTH // 2


def _windows(batches):
    """The pair of ranks at offset LENGTH / 2 of every window of the open runs: together the rank of the window."""
    for batch, at, text in _opened(batches):
        raw, offsets = text_bytes(named(batch, "text"))
        sums = prefix_sums(raw)
        run, step = _exploded(at)
        start, text = (at >> 14)[run] + step, text[run]
        i = start + offsets[text]
        a, b = (spans(sums, i + k, i + k + _HALF).view(np.int64) for k in (0, _HALF))
        doc = named(batch, "key").to_numpy()[text]
        first, later = _later([a, b], doc, start)
        yield rows(_RUN, a[first], b[first], doc[first], start[first])
        if len(later):
            yield _cut_rows(doc[later], start[later], start[later] + LENGTH)


_SPAN = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("span", pa.binary())])


def _spans(batches):
    """The bytes of every open run, under the rank of its anchor."""
    for batch, at, text in _opened(batches):
        raw, offsets = text_bytes(named(batch, "text"))
        sums, data = prefix_sums(raw), raw.tobytes()
        lo = (at >> 14) + offsets[text]
        anchor = lo + ((at >> 7) & 127)
        h = spans(sums, anchor, anchor + GRAM).view(np.int64)
        yield rows(
            _SPAN, h, named(batch, "key").to_numpy()[text], at,
            [data[i:j] for i, j in zip(lo.tolist(), (lo + (at & 127) + LENGTH).tolist())],
        )


def _span_cuts(batches):
    """Windows of runs with one anchor rank: equal halves at an equal place before the anchor make equal windows."""
    got = pa.Table.from_batches(list(batches), _SPAN)
    order = np.argsort(np.asarray(got.column("h"), np.int64), kind="stable")
    h, doc, at = (np.asarray(got.column(c), np.int64)[order] for c in ("h", "doc", "at"))
    got = got.column("span").take(pa.array(order))
    edges = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    # Whole groups of about so many runs at once.
    stops, start = [*edges[np.flatnonzero(np.diff(edges // 8_000)) + 1].tolist(), len(h)], 0
    for stop in stops:
        raw, offsets = text_bytes(pc.cast(got.slice(start, stop - start).combine_chunks(), pa.large_binary()))
        run, step = _exploded(at[start:stop])
        i = offsets[run] + step
        sums = prefix_sums(raw)
        a, b = (spans(sums, i + k, i + k + _HALF) for k in (0, _HALF))
        a = mix(a + h[start:stop][run].view(np.uint64))
        by = np.argsort(a, kind="stable")
        same = np.zeros(len(a), bool)
        twin = a[by[1:]] == a[by[:-1]]
        same[by[1:]] |= twin
        same[by[:-1]] |= twin
        a, b, run, step = a[same], b[same], run[same], step[same]
        where, first = doc[start:stop][run], (at[start:stop] >> 14)[run] + step
        _, later = _later([a, b], where, first)
        if len(later):
            yield _cut_rows(where[later], first[later], first[later] + LENGTH)
        start = stop


def _window_cuts(batches):
    h, c, doc, at = _whole(batches)
    cut = at < 0
    _, later = _later([h[~cut], c[~cut]], doc[~cut], at[~cut])
    starts = np.concatenate([-1 - at[cut], at[~cut][later]])
    if len(starts):
        yield _cut_rows(np.concatenate([doc[cut], doc[~cut][later]]), starts, np.concatenate([c[cut], at[~cut][later] + LENGTH]))


def _applied(schema: pa.Schema):
    def run(batches):
        for batch in slices(batches):
            size, removed, count, kept = [], [], [], []
            raw, offsets = text_bytes(named(batch, "text"))
            data = raw.tobytes()
            for cuts, a, b in zip(named(batch, "cuts").to_pylist(), offsets[:-1], offsets[1:]):
                text = data[a:b]
                if cuts:
                    start, end = (np.array([x[k] for x in cuts], np.int64) for k in ("start", "end"))
                    _, start, end = _merged(np.zeros(len(start), np.int64), start, end)
                else:
                    start = end = np.zeros(0, np.int64)
                spans_ = list(zip(start.tolist(), end.tolist()))
                rest, at = [], 0
                for s, e in spans_:
                    rest.append(text[at:s])
                    at = e
                rest = b"".join([*rest, text[at:]])
                size.append(len(text))
                removed.append([{"start": s, "end": e} for s, e in spans_])
                count.append(len(text) - len(rest))
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [named(batch, "row"), pa.array(size, pa.int64()), pa.array(count, pa.int64()), pa.array(removed, schema.field("removed").type),
                 pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["row", *schema.names],
            )

    return run


_APPLIED = pa.schema([
    ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.binary()), ("kept_sha256", pa.string()),
])


def _keyed(docs: DataFrame, keys: DataFrame | None) -> DataFrame:
    """(key, text) of every text searched for repeats; rows with equal ids and texts give one."""
    keyed = with_keys(in_batches(docs), keys).select(F.col("_key").alias("key"), "text", "_n")
    if keys is None:
        return keyed.select("key", "text")
    again = keyed.where("_n > 1").groupBy("key").agg(F.min("text").alias("text"))
    return stored(keyed.where("_n = 1").select("key", "text").union(again), "keyed")


def repeats(keyed: DataFrame) -> DataFrame:
    """``(key, text)`` with distinct keys -> stored ``(key, start, end)``: byte intervals to remove, by the rounds below.

    1. Rank the GRAM-byte strings at the anchors; the windows of an anchor whose rank is unique are
       unique and done with.
    2. Rank what is left by the bytes of a whole run of windows: runs of equal rank are repeats but for the first.
    3. A first run may still share single windows with runs of other bytes at the same anchor. Where the anchor's
       rank has several runs, rank the windows by the pair of ranks of their halves. Up to TOGETHER runs of one
       anchor rank are compared in one task, from the bytes of the runs; the windows of more frequent ranks are dealt
       by their own ranks.
    Ranks are fingerprints, so no round needs a global order. Rounds 2 and 3 deal rows by the rank of whole runs or
    windows, and a task sends one row at most per rank and slice of text, so no rank gathers its occurrences in one task.
    """
    spark = keyed.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * keyed.rdd.getNumPartitions())
    table = spark.sparkContext.broadcast(_table(keyed))
    released(spark)
    ranked = stored(keyed.mapInArrow(_runs(table), _RUNS).repartition(parts, "h", "c").mapInArrow(_settled, _RUNS), "ranked")
    released(spark)
    left = ranked.where("at >= 0")
    several = stored(left.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "several")
    few = F.col("n") <= TOGETHER
    opened = stored(
        left.join(several, "h").groupBy(F.col("doc").alias("_doc"))
        .agg(F.collect_list(F.when(few, F.col("at"))).alias("few"), F.collect_list(F.when(~few, F.col("at"))).alias("many")), "opened",
    )

    def places(column: str) -> DataFrame:
        some = opened.where(F.size(column) > 0)
        return only_ids(keyed, some.select("_doc"), "key").join(some, F.col("key") == F.col("_doc")).select("key", "text", F.col(column).alias("places"))

    found = places("few").mapInArrow(_spans, "h long, doc long, at long, span binary").repartition(parts, "h").mapInArrow(_span_cuts, _RUNS)
    if not several.where(~few).isEmpty():
        found = found.union(places("many").mapInArrow(_windows, _RUNS).repartition(2 * parts, "h", "c").mapInArrow(_window_cuts, _RUNS))
    cuts = stored(
        ranked.where("at < 0").union(found).select(F.col("doc").alias("key"), (-1 - F.col("at")).alias("start"), F.col("c").alias("end")), "cuts"
    )
    for old in (ranked, several, opened):
        dropped(old)
    released(spark)
    return cuts


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``n_bytes, n_removed, removed, kept, kept_sha256``.

    Of a text's UTF-8 bytes every one is removed that is covered by a string of LENGTH bytes which also starts
    earlier: in a smaller id, or before in the same text. Strings overlap, never cross documents, and are judged on
    the input. ``removed`` holds the maximal (start, end) runs, ``kept`` the other bytes.

    A null text is empty. Rows with a null id rank last. Every text is searched and cut: texts that share an id, or
    have none, are documents of their own, ranked by digest. Only rows equal in id and text count as one document and
    are cut alike. Empty table: no rows.
    """
    keys = row_keys(docs)
    keyed = _keyed(docs, keys)
    cuts = repeats(keyed)
    if keys is not None:
        dropped(keyed)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    wide = with_keys(docs, keys).select(row, "text", "_key")
    schema = wide.select("row").schema
    for name, kind in (("n_bytes", "bigint"), ("n_removed", "bigint"), ("removed", "array<struct<start:bigint,end:bigint>>"), ("kept", "binary"), ("kept_sha256", "string")):
        schema = schema.add(name, wide.select(F.lit(None).cast(kind).alias("x")).schema["x"].dataType)
    per = cuts.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    joined = wide.join(per, wide["_key"] == per["key"], "left")
    return joined.select("row", "text", "cuts").mapInArrow(_applied(_APPLIED), schema)


def byte_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    return dedup_bytes(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256"
    )
