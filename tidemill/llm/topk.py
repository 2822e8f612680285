"""Exact top-k search by distributed selection on score histograms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import dropped, rows, stored

#: Vectors in one block; a query block meets a candidate block in one step of a task.
QUERY_BLOCK, BLOCK = 1024, 2048
#: Bins of a histogram; a round narrows the interval of every k-th value by this factor.
BINS = 1024
#: Exact as doubles below this bound on |query| * |candidate|.
_EXACT = 2.0**52
#: Scores must stay below; the first interval then fits 64 bits.
WIDEST = 2.0**61

_PACKED = pa.schema([("dim", pa.int64()), ("block", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()), ("matrix", pa.binary())])


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``id, vector``: each component x as floor(scale * x); vectors with missing or non-finite parts are left out."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("id"), x.alias("vector"))


def _pack(table: pa.Table) -> pa.Table:
    vectors = table.column("vector").combine_chunks()
    dim = table.column("dim")[0].as_py()
    # Counted by ids: nothing can be told from the components of vectors of length 0.
    matrix = np.asarray(vectors.values if hasattr(vectors, "values") else vectors.flatten(), np.int64).reshape(len(vectors), dim)
    length = np.sqrt((matrix.astype(np.float64) ** 2).sum(1)).max() if dim else 0.0
    ids = np.asarray(table.column("id"), np.int64)
    return pa.table([[dim], [table.column("block")[0].as_py()], [float(length)], [ids.tobytes()], [matrix.tobytes()]], schema=_PACKED)


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of about ``size`` vectors of one dimension, each a row: ids and integer matrix."""
    sized = vectors.withColumn("dim", F.size("vector").cast("long"))
    n = sized.groupBy("dim").agg(F.ceil(F.count("*") / size).alias("n"))
    dealt = sized.join(n, "dim").withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.col("n"))).drop("n")
    return dealt.groupBy("dim", "block").applyInArrow(_pack, "dim long, block long, longest double, ids binary, matrix binary")


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, and exact integer inner products with the query's own row at the far left end."""
    q, c = (np.frombuffer(row[k], np.int64) for k in ("q_ids", "ids"))
    x, y = (np.frombuffer(row[k], np.int64).reshape(len(i), -1) for k, i in (("q_matrix", q), ("matrix", c)))
    if row["q_longest"] * row["longest"] < _EXACT:
        scores = (x.astype(np.float64) @ y.T.astype(np.float64)).astype(np.int64)
    else:
        # Whole numbers modulo 2**64, right wherever the true score fits; doubles tell where it does not.
        scores = x @ y.T
        if (np.abs((x.astype(np.float64) @ y.T.astype(np.float64)))[q[:, None] != c[None, :]] >= WIDEST).any():
            raise OverflowError("inner products beyond 2**61 cannot be ranked")
    return q, c, np.where(q[:, None] == c[None, :], np.iinfo(np.int64).min, scores)


_HIST = pa.schema([("query_id", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])


def _histograms(k: int):
    """Counts per bin of the interval [low, low + span) of every query; of one block only its upper bins that hold k."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q, _, scores = _scores(row)
                low, span, above = (np.frombuffer(row[c], np.int64) for c in ("low", "span", "above"))
                for i in range(len(q)):
                    # Scores above the interval were counted in an earlier round.
                    inside = scores[i][(scores[i] >= low[i]) & (scores[i] < low[i] + span[i])]
                    bins = (inside - low[i]) // -(-span[i] // BINS)
                    if not len(bins):
                        continue
                    need = max(1, k - int(above[i]))
                    if len(bins) > need:
                        bins = bins[bins >= np.partition(bins, len(bins) - need)[len(bins) - need]]
                    which, count = np.unique(bins, return_counts=True)
                    yield rows(_HIST, np.full(len(which), q[i]), which.astype(np.int64), count.astype(np.int64))

    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _selected(k: int):
    """Of a block, every score above the k-th value and of the ties at it the k smallest ids."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q, c, scores = _scores(row)
                low = np.frombuffer(row["low"], np.int64)
                own = q[:, None] == c[None, :]
                for i in range(len(q)):
                    at = np.flatnonzero((scores[i] >= low[i]) & ~own[i])
                    if not len(at):
                        continue
                    if len(at) > k:
                        at = at[np.lexsort((c[at], -scores[i][at]))[:k]]
                    yield rows(_FOUND, np.full(len(at), q[i]), c[at], scores[i][at])

    return run


def _gathered(batches):
    """Small record batches joined to fewer."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n > 20_000:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query its ``k`` best candidates by integer inner product.

    Queries are the vectors whose id is divisible by ``every``, in blocks; candidates all others. Each round scores
    every candidate block against every query block and adds up, per query, counts per score bin; the bin with the
    k-th best score becomes the next round's interval, until it is one score wide. A last pass keeps what lies above
    that score and, of the ties at it, the smallest ids. A block reports only the upper bins that already hold k
    scores: lower ones cannot hold the k-th best of all.

    Vectors that are null, have null or non-finite components, or a null id, take no part. Vectors meet only vectors
    of their dimension; empty ones meet each other, with score 0. Rows with a query's id are its own and no candidates for it; a repeated query id is asked
    once, with its smallest vector; other repeated rows are candidates each. Fewer than k candidates: all of them.
    Empty table: no rows. Scores of 2**61 and more are an error.
    """
    usable = quantised(vectors, scale)
    candidates = stored(_blocks(usable, BLOCK), "candidates")
    asked = usable.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = stored(_blocks(asked, QUERY_BLOCK), "asked")
    longest = candidates.groupBy("dim").agg(F.max("longest").alias("far"))
    state = stored(asked.join(longest, "dim").mapInArrow(_opening, _STATE), "state")
    # Every query block meets every candidate block of its dimension, a row for each meeting.
    side = asked.select("dim", F.col("block").alias("q_block"), F.col("longest").alias("q_longest"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"))

    def met(limits: DataFrame) -> DataFrame:
        queries = side.join(limits.drop("ids"), ["dim", "q_block"])
        return candidates.join(queries, "dim").repartition("dim", "block", "q_block")

    while not state.where("open").isEmpty():
        live = state.where("open").drop("open")
        counted = met(live).mapInArrow(lambda b, f=_histograms(k): _gathered(f(b)), "query_id long, bin long, n long")
        counted = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        reach = counted.withColumn("sum", F.sum("n").over(down))
        limits = _intervals(state).join(reach, "query_id", "left")
        # The bin of the k-th value: the first from above where the count reaches k. None: all candidates are wanted.
        hit = F.col("above") + F.col("sum") >= k
        chosen = limits.groupBy("dim", "q_block", "place", "query_id", "low", "span", "above").agg(
            F.max(F.when(hit, F.col("bin"))).alias("bin"), F.max(F.when(~hit, F.col("sum"))).alias("before")
        )
        width = F.expr(f"(span + {BINS - 1}) div {BINS}")
        known, low = F.col("bin").isNotNull(), F.col("low") + F.col("bin") * width
        span = F.least(width, F.col("low") + F.col("span") - low)
        narrowed = chosen.select(
            "dim", "q_block", "place", "query_id",
            F.when(known, low).otherwise(F.col("low")).alias("low"), F.when(known, span).otherwise(F.col("span")).alias("span"),
            (F.col("above") + F.when(known, F.coalesce("before", F.lit(0))).otherwise(0)).alias("above"),
            (known & (span > 1)).alias("open"),
        )
        after = stored(narrowed.groupBy("dim", "q_block").applyInArrow(_repacked, _STATE), "state")
        dropped(state)
        state = after
    found = met(state.drop("open")).mapInArrow(lambda b, f=_selected(k): _gathered(f(b)), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_STATE = "dim long, q_block long, ids binary, low binary, span binary, above binary, open boolean"
_STATE_ARROW = pa.schema([("dim", pa.int64()), ("q_block", pa.int64()), ("ids", pa.binary()), ("low", pa.binary()), ("span", pa.binary()), ("above", pa.binary()), ("open", pa.bool_())])


def _opening(batches):
    """The first interval of every query holds all its scores, by the lengths of the vectors."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            matrix = np.frombuffer(row["matrix"], np.int64).reshape(len(ids), -1).astype(np.float64)
            bound = np.ceil(np.minimum(np.sqrt((matrix**2).sum(1)) * row["far"] * (1 + 1e-9), WIDEST)).astype(np.int64) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(
                    [row["dim"], row["block"], row["ids"], (-bound).tobytes(), (2 * bound + 1).tobytes(), np.zeros(len(ids), np.int64).tobytes(), True],
                    _STATE_ARROW.types,
                )], schema=_STATE_ARROW,
            )


_ROWS = pa.schema([("dim", pa.int64()), ("q_block", pa.int64()), ("place", pa.int64()), ("query_id", pa.int64()), ("low", pa.int64()), ("span", pa.int64()), ("above", pa.int64())])


def _unpacked(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids, low, span, above = (np.frombuffer(row[c], np.int64) for c in ("ids", "low", "span", "above"))
            n = len(ids)
            yield rows(_ROWS, np.full(n, row["dim"]), np.full(n, row["q_block"]), np.arange(n), ids, low, span, above)


def _intervals(state: DataFrame) -> DataFrame:
    return state.mapInArrow(_unpacked, "dim long, q_block long, place long, query_id long, low long, span long, above long")


def _repacked(table: pa.Table) -> pa.Table:
    """A query block in its order again; it stays open while any of its intervals spans more than one score."""
    table = table.sort_by("place")
    flat = lambda c: np.asarray(table.column(c), np.int64).tobytes()
    return pa.table([
        [table.column("dim")[0].as_py()], [table.column("q_block")[0].as_py()], [flat("query_id")], [flat("low")], [flat("span")],
        [flat("above")], [any(table.column("open").to_pylist())],
    ], schema=_STATE_ARROW)
