"""Hard negatives: anchors hang in a spanning tree, and scores at a parent bound those at its children."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import in_batches, named, rows, stored

#: Anchors of one tree, rows scored at once, and bytes of anchors that the tasks hold at once (more take more passes).
TREE, BLOCK, PASS_BYTES = 1024, 2048, 32 << 20
#: Products of lengths below this bound are exact in doubles.
_EXACT = 2.0**52

_VECTORS = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int64()), ("vector", pa.list_(pa.float64()))])
_VECTOR_TYPE = "id long, label long, dim long, vector array<double>"


def usable(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels, lengths and offsets' base values of rows that take part; components as floor(scale * x).

    Returned as ``ids, labels, sizes, values`` where ``values`` holds the components of those rows on end.
    """
    vectors = named(batch, "vector")
    complete = np.asarray(vectors.is_valid()) & np.asarray(named(batch, "id").is_valid()) & np.asarray(named(batch, "label").is_valid())
    batch = batch.filter(pa.array(complete))
    vectors = named(batch, "vector")
    sizes = np.asarray(vectors.value_lengths(), np.int64)
    flat = vectors.flatten()
    values = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    good = np.ones(len(sizes), bool)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good[row[~np.isfinite(values)]] = False
    ids, labels = (np.asarray(named(batch, c), np.int64) for c in ("id", "label"))
    return ids[good], labels[good], sizes[good], values[good[row]]


def _anchor_rows(scale: int):
    def run(batches):
        for batch in batches:
            ids, labels, sizes, values = usable(batch, scale)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield rows(_VECTORS, ids, labels, sizes, pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))

    return run


def blocks(batches, scale: int):
    """``ids, labels, matrix`` of the rows that take part, up to ``BLOCK`` of one dimension at once."""
    waiting: dict[int, list] = {}

    def joined(held):
        return tuple(np.concatenate(x) for x in zip(*held))

    for batch in batches:
        ids, labels, sizes, values = usable(batch, scale)
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            matrix = values[starts[at][:, None] + np.arange(dim)]
            for k in range(0, len(at), BLOCK):
                held = waiting.setdefault(int(dim), [])
                held.append((ids[at[k: k + BLOCK]], labels[at[k: k + BLOCK]], matrix[k: k + BLOCK]))
                if sum(len(x[0]) for x in held) >= BLOCK:
                    yield joined(waiting.pop(int(dim)))
    for held in waiting.values():
        yield joined(held)


def products(x: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``x`` with one vector; Python's integers where 64 bits may not do."""
    if not len(x):
        return np.zeros(0, np.int64)
    if np.sqrt((x * x).sum(1).max()) * np.sqrt(anchor @ anchor) < _EXACT:
        return (x @ anchor).astype(np.int64)
    whole = [int(v) for v in anchor]
    return np.array([sum(int(u) * v for u, v in zip(row, whole)) for row in x], object)


_TREES = pa.schema([
    ("dim", pa.int64()), ("label", pa.int64()), ("tree", pa.int64()), ("ids", pa.binary()), ("matrix", pa.binary()),
    ("parent", pa.binary()), ("edge", pa.binary()),
])
_TREE_TYPE = "dim long, label long, tree long, ids binary, matrix binary, parent binary, edge binary"


def spanning_tree(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by Euclidean distance: the rows with parents before children, parents' places, edge lengths.

    Children follow their parent depth first, so only the scores along one branch need to be kept.
    """
    n = len(matrix)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    inside, children, at = np.zeros(n, bool), [[] for _ in range(n)], 0
    for _ in range(n):
        inside[at] = True
        if parent[at] >= 0:
            children[parent[at]].append(at)
        far = np.sqrt(((matrix - matrix[at]) ** 2).sum(1))
        closer = ~inside & (far < near)
        near[closer], parent[closer] = far[closer], at
        at = int(np.argmin(np.where(inside, np.inf, near)))
    order, stack, place = [], [0], np.zeros(n, np.int64)
    while stack:
        node = stack.pop()
        place[node] = len(order)
        order.append(node)
        stack += children[node]
    order = np.array(order)
    up = parent[order]
    return order, np.where(up < 0, -1, place[up]), np.where(up < 0, 0.0, near[order])


def _planted(table: pa.Table) -> pa.Table:
    """One tree from the anchors of a group."""
    first = lambda c: table.column(c)[0].as_py()
    ids = np.asarray(table.column("id"), np.int64)
    vectors = table.column("vector").combine_chunks()
    matrix = np.asarray(vectors.flatten(), np.float64).reshape(len(ids), first("dim"))
    start = np.argsort(ids, kind="stable")
    order, parent, edge = spanning_tree(matrix[start])
    order = start[order]
    packed = [first("dim"), first("label"), first("tree"), ids[order].tobytes(), matrix[order].tobytes(), parent.astype(np.int64).tobytes(), edge.tobytes()]
    return pa.table([[x] for x in packed], schema=_TREES)


class Tree:
    """The anchors of one label and dimension, parents before children."""

    def __init__(self, row: dict):
        self.label, self.dim = row["label"], row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.matrix = np.frombuffer(row["matrix"], np.float64).reshape(len(self.ids), self.dim)
        self.parent, self.edge = np.frombuffer(row["parent"], np.int64), np.frombuffer(row["edge"], np.float64)
        self.last = {int(p): i for i, p in enumerate(self.parent)}

    def walk(self, x: np.ndarray, window, found) -> None:
        """Score the rows of ``x`` against every anchor where ``window(anchor)``, a pair of scores, may hold them.

        The score of a row at an anchor differs from that at its parent by at most edge * length of the row. Rows whose
        bounds miss the window are not scored and pass their bounds on; ``found(anchor, places, scores)`` gets the rest.
        """
        length = np.sqrt((x * x).sum(1))
        bounds: dict[int, tuple] = {}
        for i in range(len(self.ids)):
            up = int(self.parent[i])
            if up < 0:
                low, high, need = np.empty(len(x)), np.empty(len(x)), np.arange(len(x))
            else:
                before = bounds[up]
                # One more for what rounding of lengths may cost; scores are integers.
                reach = self.edge[i] * (1 + 1e-9) * length + 1 + 1e-9 * np.maximum(np.abs(before[0]), np.abs(before[1]))
                low, high = before[0] - reach, before[1] + reach
                least, most = window(i)
                need = np.flatnonzero((high >= least) & (low <= most))
                if self.last[up] == i:
                    del bounds[up]
            scores = products(x[need] if len(need) < len(x) else x, self.matrix[i])
            low[need] = high[need] = scores
            if i in self.last:
                bounds[i] = (low, high)
            if len(need):
                found(i, need, scores)


class Best:
    """Per place the ``k`` best scores so far, ties to smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n

    def least(self, i: int, otherwise):
        """What a score must reach to count."""
        return int(self.score[i][-1]) if len(self.score[i]) == self.k else otherwise

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        # An error here says that a score does not fit 64 bits.
        score, ids = np.concatenate([self.score[i], score.astype(np.int64)]), np.concatenate([self.id[i], ids])
        best = np.lexsort((ids, -score))[: self.k]
        self.score[i], self.id[i] = score[best], ids[best]


_POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])


def _same_label(trees, scale: int, k: int):
    """The ``k`` best rows of its label for every anchor, of those that a task sees."""

    def run(batches):
        held = [Tree(row) for row in trees.value]
        best = [Best(len(t.ids), k) for t in held]
        for ids, labels, x in blocks(batches, scale):
            for tree, top in zip(held, best):
                mine = np.flatnonzero(labels == tree.label) if tree.dim == x.shape[1] else ()
                if not len(mine):
                    continue

                def found(i, need, scores, tree=tree, top=top, mine=mine):
                    other = ids[mine[need]]
                    good = (scores >= top.least(i, -np.inf)) & (other != tree.ids[i])
                    if good.any():
                        top.add(i, scores[good], other[good])

                tree.walk(x[mine], lambda i, top=top: (top.least(i, -np.inf), np.inf), found)
        for tree, top in zip(held, best):
            size = [len(s) for s in top.score]
            yield rows(_POSITIVES, np.repeat(tree.ids, size), np.concatenate(top.id), np.concatenate(top.score))

    return run


_NEGATIVES = pa.schema([("anchor_id", pa.int64()), ("place", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _other_labels(trees, positives, scale: int, k: int, low: int, high: int):
    """The ``k`` best rows of other labels in the window of every positive, of those that a task sees."""

    def run(batches):
        held, known = [Tree(row) for row in trees.value], positives.value
        windows, best = [], []
        for tree in held:
            scores = [known.get(int(a), ()) for a in tree.ids]
            # Python's integers: no product can overflow. A negative score leaves an empty window.
            windows.append([[(-(-low * s // 100), high * s // 100) for s in mine] for mine in scores])
            best.append([Best(len(mine), k) for mine in scores])
        for ids, labels, x in blocks(batches, scale):
            for tree, spans, tops in zip(held, windows, best):
                other = np.flatnonzero(labels != tree.label) if tree.dim == x.shape[1] else ()
                if not len(other):
                    continue

                def window(i, spans=spans, tops=tops):
                    wanted = [(max(a, tops[i].least(j, a)), b) for j, (a, b) in enumerate(spans[i]) if a <= b]
                    return (min(a for a, _ in wanted), max(b for _, b in wanted)) if wanted else (np.inf, -np.inf)

                def found(i, need, scores, tree=tree, spans=spans, tops=tops, other=other):
                    for j, (a, b) in enumerate(spans[i]):
                        inside = (scores >= max(a, tops[i].least(j, a))) & (scores <= b)
                        # A repeated id of the anchor is the anchor, whatever its label.
                        inside &= ids[other[need]] != tree.ids[i]
                        if inside.any():
                            tops[i].add(j, scores[inside], ids[other[need]][inside])

                tree.walk(x[other], window, found)
        for tree, tops in zip(held, best):
            got = [(a, j, top.id[j], top.score[j]) for a, top in zip(tree.ids, tops) for j in range(len(top.score)) if len(top.score[j])]
            if got:
                size = [len(x[2]) for x in got]
                yield rows(
                    _NEGATIVES, np.repeat([x[0] for x in got], size), np.repeat([x[1] for x in got], size),
                    np.concatenate([x[2] for x in got]), np.concatenate([x[3] for x in got]),
                )

    return run


def _ranked(df: DataFrame, keys: list[str], score: str, other: str, k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """Negatives that score between ``low`` and ``high`` percent of a positive, from ``id, label, vector``.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Components count as
    floor(scale * x), scores are integer inner products with the anchor, best first, ties by smaller id. Anchors are the
    rows whose id is divisible by ``every``; a positive is one of an anchor's first ``positives`` other rows of its
    label, and each gets its first ``negatives`` rows of other labels in its window.

    The anchors of a label hang in minimum spanning trees of about ``TREE`` anchors. A pass sends trees of at most about
    ``PASS_BYTES`` to the tasks and runs all rows past them, twice: for positives, then for negatives in the windows
    known by then. A row is scored at a tree's root; further down its bounds are the parent's plus or minus edge times
    length of the row, and only rows whose bounds meet the window are scored again. Bounds decide what is computed,
    never what is found. Between the passes only the best few rows of each anchor and task are shuffled.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors meet only
    vectors of their length; empty ones score 0. Rows with an anchor's id are the anchor itself; of several, the one
    with the smallest label, then vector, counts. Other repeated rows count each. Scores are exact at any size; one
    that does not fit 64 bits is an error. No anchors, no partners or an empty table: no rows.
    """
    spark = vectors.sparkSession
    source = in_batches(vectors.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector"))
    anchors = source.where(F.col("id") % every == 0).mapInArrow(_anchor_rows(scale), _VECTOR_TYPE)
    anchors = stored(anchors.groupBy("id").agg(F.min(F.struct("label", "dim", "vector")).alias("row")).select("id", "row.*"), "anchors")
    trees = anchors.groupBy("dim", "label").agg(F.ceil(F.count("*") / TREE).alias("trees"))
    dealt = anchors.join(trees, ["dim", "label"]).withColumn("tree", F.pmod(F.xxhash64("id"), "trees")).drop("trees")
    planted = stored(dealt.groupBy("dim", "label", "tree").applyInArrow(_planted, _TREE_TYPE), "trees")
    size = planted.agg(F.sum(F.length("matrix") + 64 * F.length("ids"))).first()[0] or 0
    passes = -(-size // PASS_BYTES)
    found = []
    for turn in range(passes):
        mine = planted.where(F.pmod(F.xxhash64("dim", "label", "tree"), F.lit(passes)) == turn)
        sent = spark.sparkContext.broadcast(mine.toArrow().to_pylist())
        near = source.mapInArrow(_same_label(sent, scale, positives), "anchor_id long, positive_id long, positive_score long")
        near = stored(_ranked(near, ["anchor_id"], "positive_score", "positive_id", positives, "place"), "positives")
        known: dict[int, list] = {}
        # A few rows per anchor of this pass.
        for row in near.orderBy("anchor_id", "place").toArrow().to_pylist():
            known.setdefault(row["anchor_id"], []).append(row["positive_score"])
        scores = spark.sparkContext.broadcast(known)
        far = source.mapInArrow(_other_labels(sent, scores, scale, negatives, low, high), "anchor_id long, place long, negative_id long, negative_score long")
        far = _ranked(far, ["anchor_id", "place"], "negative_score", "negative_id", negatives, "rank")
        pairs = far.join(near.withColumn("place", F.col("place").cast("long") - 1), ["anchor_id", "place"])
        found.append(stored(pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives"))
        sent.unpersist()
        scores.unpersist()
    if not found:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*(f.stored_path for f in found))


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings``; every seventh row has its label moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector")))


#: The same over a view ``embeddings``.
SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
