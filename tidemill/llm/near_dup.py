"""Near duplicates: bottom-k sketches, inverted lists, union-sketch estimates, exact confirmation."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.components import components
from tidemill.llm.shared import dropped, in_batches, named, only_ids, plain_names, row_keys, rows, slices, stored, text_bytes, with_keys
from tidemill.llm.words import shingle_sets

SKETCH = 64
#: Lists up to this length are paired outright (28 pairs at most); longer ones go by a leader, then by blocks.
SHORT_LIST = 8
#: Shingles per block of a long list, 8 bytes each.
BLOCK_SHINGLES = 300_000
#: Members of such a block.
BLOCK_MEMBERS = 2_000
#: Chance of overlooking, by its sketch, a link exactly at the threshold.
MISS = 1e-9

_SET = pa.schema([("doc_id", pa.int64()), ("_key", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("sketch", pa.list_(pa.int64()))])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_BLOCK = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("open", pa.int64()), ("ids", pa.binary()), ("roots", pa.binary()), ("sizes", pa.binary()), ("values", pa.binary())])


@lru_cache
def least_shared(k: int, percent: int) -> int:
    """What the k smallest of a union hold in common, but for a chance of ``MISS``, at the threshold."""
    p, tail = percent / 100, 0.0
    for x in range(k + 1):
        tail += comb(k, x) * p**x * (1 - p) ** (k - x)
        if tail > MISS:
            return x
    return k


def _sketches(size: int, k: int):
    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(*text_bytes(named(batch, "text")), size)
            yield rows(
                _SET, named(batch, "doc_id"), named(batch, "_key"), [len(s) for s in sets],
                [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                # The order of the unsigned values is kept by moving them to the signed range.
                [(s[:k] ^ np.uint64(1 << 63)).view(np.int64) for s in sets],
            )

    return run


def _estimated(percent: int, k: int):
    least = least_shared(k, percent)

    def run(batches):
        for batch in batches:
            keep = []
            for x, y, n, m in zip(*(named(batch, c).to_numpy(zero_copy_only=False) for c in ("sketch_a", "sketch_b", "n_a", "n_b"))):
                common = np.intersect1d(x, y, assume_unique=True)
                union = np.union1d(x, y)[:k]
                shared = int(np.searchsorted(common, union[-1], "right"))
                whole = n <= k and m <= k
                keep.append(100 * len(common) >= percent * (n + m - len(common)) if whole else shared >= least * len(union) / k)
            yield rows(_PAIR, named(batch, "a"), named(batch, "b")).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(size: int, percent: int):
    def run(batches):
        for batch in slices(batches, column="text_a"):
            a, b = (shingle_sets(*text_bytes(named(batch, c)), size) for c in ("text_a", "text_b"))
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
            keep = [100 * c >= percent * (len(x) + len(y) - c) for x, y, c in zip(a, b, common)]
            yield rows(_PAIR, named(batch, "a"), named(batch, "b")).filter(pa.array(keep, pa.bool_()))

    return run


def _sets_of(size: int):
    schema = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("root", pa.int64()), ("full", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(*text_bytes(named(batch, "text")), size)
            yield rows(schema, *(named(batch, c) for c in ("bucket", "block", "node", "root")), [s.tobytes() for s in sets])

    return run


def _packed(table: pa.Table) -> pa.Table:
    """One block of a bucket: the sets of its members on end."""
    full = table.column("full").to_pylist()
    bucket, block = table.column("bucket")[0].as_py(), table.column("block")[0].as_py()
    ids, roots = (np.asarray(table.column(c), np.int64) for c in ("node", "root"))
    sizes = np.array([len(x) // 8 for x in full], np.int64)
    return pa.table([[bucket], [block], [int((roots != bucket).sum())], [ids.tobytes()], [roots.tobytes()], [sizes.tobytes()], [b"".join(full)]], schema=_BLOCK)


def overlaps(x: tuple, y: tuple) -> np.ndarray:
    """Exact intersection sizes of two blocks ``(sizes, values)``: products of 0/1 matrices, some columns at a time.

    Values met only once cannot be shared and are left out, so the matrices stay narrow.
    """
    n = len(x[0])
    values = np.concatenate([x[1], y[1]])
    owner = np.repeat(np.arange(n + len(y[0])), np.concatenate([x[0], y[0]]))
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    often = count[column] > 1
    _, column = np.unique(column[often], return_inverse=True)
    owner = owner[often]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out, width = np.zeros((n, len(y[0])), np.float32), 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        ones = np.zeros((n + len(y[0]), width), np.float32)
        ones[owner[a:b], column[a:b] - first] = 1
        out += ones[:n] @ ones[n:].T
    return out.astype(np.int64)


def _block_links(percent: int):
    def forest(ids_x, roots_x, ids_y, roots_y, hit):
        parent: dict[int, int] = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, j in zip(*np.nonzero(hit)):
            p, q = find(int(roots_x[i])), find(int(roots_y[j]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                yield int(ids_x[i]), int(ids_y[j])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y = ({c: np.frombuffer(row[f"{c}_{s}"], np.uint64 if c == "values" else np.int64) for c in ("ids", "roots", "sizes", "values")} for s in "xy")
                common = overlaps((x["sizes"], x["values"]), (y["sizes"], y["values"]))
                union = x["sizes"][:, None] + y["sizes"][None, :] - common
                hit = (100 * common >= percent * union) & (x["roots"][:, None] != y["roots"][None, :])
                found = list(forest(x["ids"], x["roots"], y["ids"], y["roots"], hit))
                yield rows(_PAIR, [a for a, _ in found], [b for _, b in found])

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, sketch: int = SKETCH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their sets of ``size``-word shingles have at least ``percent`` % of their union in
    common; links are confirmed on whole sets. Equal sets are one class from the start. The values kept by the
    sketches form inverted lists. By how rare its values are, a class is listed under so many of them only that any
    two linked classes share a list. Short lists give their pairs. In a longer list every member is compared
    with one leader; members that are not yet connected with most of the list then meet all of it, block by block,
    on whole sets, and only links between different components leave the task.

    Nulls: a null or empty text has an empty set and links with nothing. A row without ``doc_id`` takes no part:
    its component is null and it is kept. Texts that share a ``doc_id`` are nodes of their own, so one may be kept and
    the other not; rows equal in id and text are one node. Empty table: no rows. Other columns are ignored.
    """
    keyed = with_keys(in_batches(docs), row_keys(docs))
    return _decided(keyed, False, size, percent, sketch).select("doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, sketch: int = SKETCH) -> DataFrame:
    """The rows of ``docs`` that are kept when every row takes part, those without ``doc_id`` last.

    Rows equal in id and text stay or go together; without an id one of them stays. Blank texts have no copies.
    """
    names, docs = docs.columns, plain_names(docs)
    keyed = with_keys(in_batches(docs), row_keys(docs))
    gone = stored(_decided(keyed, True, size, percent, sketch).where("NOT kept").select("_key").distinct(), "gone")
    left = only_ids(keyed, gone, "_key", anti=True)
    copies = F.coalesce(F.col("doc_id").isNull() & (F.col("_n") > 1) & F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    one = left.where(copies).groupBy("_key").agg(F.first(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("row"))
    return left.where(~copies).select(*docs.columns).union(one.select("row.*")).toDF(*names)


def _decided(keyed: DataFrame, nulls: bool, size: int, percent: int, sketch: int) -> DataFrame:
    """``_key, doc_id, n_shingles, component_id, kept`` of rows with ``_key``; without ``nulls`` null ids take no part."""
    part = F.lit(True) if nulls else F.col("doc_id").isNotNull()
    sets = stored(
        keyed.select("doc_id", "_key", "text").mapInArrow(
            _sketches(size, sketch), "doc_id long, _key long, n_shingles long, set_id binary, sketch array<long>"
        ), "sets"
    )
    classes = stored(
        sets.where(part & (F.col("n_shingles") > 0)).groupBy("set_id")
        .agg(F.min(F.struct("_key", "doc_id")).alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .select("set_id", F.col("least._key").alias("node"), F.col("least.doc_id").alias("label"), "n", "sketch"), "classes"
    )
    members = stored(_listed(classes, sketch, percent), "members")
    met = only_ids(keyed.where(part), members.select("node").distinct(), "_key")
    again = met.where("_n > 1").groupBy("_key").agg(F.min("text").alias("text"))
    texts = stored(met.where("_n = 1").select("_key", "text").union(again).withColumnRenamed("_key", "doc_id"), "texts")
    found = stored(_pairs(members, classes, texts, size, percent, sketch), "found")
    roots = components(found)
    more = stored(_rest(members, roots, texts, size, percent), "more")
    dropped(members)
    dropped(texts)
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    labels = classes.select("set_id", "node").join(roots, "node", "left").select("set_id", F.coalesce("root", "node").alias("root"))
    labels = stored(labels.join(classes.select(F.col("node").alias("root"), "label"), "root"), "labels")
    dropped(classes)
    root = F.when(part, F.coalesce("root", "_key"))
    component = F.when(part, F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("label")))
    return sets.drop("sketch").join(labels, "set_id", "left").select(
        "_key", "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("_key") == root, F.lit(True)).alias("kept")
    )


def _listed(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, node, n, alone): the inverted lists, each class under its rarest values only.

    A class whose partners all fit into a sketch needs ``percent`` % of its own values in common; a larger one what
    the k smallest of a union must share. Values beyond that many can be left out, the most frequent ones first.
    """
    values = classes.select("node", "n", F.explode("sketch").alias("value"))
    often = stored(values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1"), "often")
    kept = F.least(F.col("n"), F.lit(k))
    needed = F.when(F.col("n") * 100 <= percent * k, F.ceil(F.col("n") * percent / 100)).otherwise(least_shared(k, percent))
    own = Window.partitionBy("node")
    ranked = values.join(often, "value").withColumn("alone", kept - F.count("*").over(own)).withColumn(
        "rank", F.col("alone") + F.row_number().over(own.orderBy("often", "value"))
    )
    return ranked.where(F.col("rank") <= kept - needed + 1).select("value", "node", "n", "alone")


def _similar_size(percent: int):
    return (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)


def _pairs(members: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int, k: int) -> DataFrame:
    """Confirmed links of short lists and of leaders; the leader has the fewest values of its own."""
    lists = stored(
        members.groupBy("value").agg(F.count("*").alias("length"), F.min(F.struct("alone", "node", "n")).alias("leader")).where("length > 1"),
        "lists",
    )
    met = members.join(lists, "value")
    long = met.where(F.col("length") > SHORT_LIST).select(
        F.col("leader.node").alias("a"), F.col("leader.n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b")
    )
    short = met.where(F.col("length") <= SHORT_LIST)
    left = short.select("value", F.col("node").alias("a"), F.col("n").alias("n_a"))
    right = short.select("value", F.col("node").alias("b"), F.col("n").alias("n_b"))
    pairs = (
        left.join(right, "value").where("a < b").drop("value").unionByName(long.where("a <> b"))
        .where(_similar_size(percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    of = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    likely = pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(_estimated(percent, k), "a long, b long")
    text = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    return likely.join(text("a"), "a").join(text("b"), "b").mapInArrow(_confirmed(size, percent), "a long, b long")


def _rest(members: DataFrame, roots: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links in long lists between members that the leaders left in different components.

    Lists with the same largest component are one bucket, so a group of near copies that shares hundreds of values
    is compared once. Pairs inside the largest component need no look.
    """
    at = members.join(roots, "node", "left").select("value", "node", "n", F.coalesce("root", "node").alias("root"))
    per_root = at.groupBy("value", "root").agg(F.count("*").alias("c"))
    per_list = per_root.groupBy("value").agg(
        F.sum("c").alias("length"), F.count("*").alias("parts"), F.max(F.struct("c", (-F.col("root")).alias("r"))).alias("most")
    )
    opened = stored(
        per_list.where((F.col("length") > SHORT_LIST) & (F.col("parts") > 1)).select("value", (-F.col("most.r")).alias("bucket")), "opened"
    )
    inside = stored(at.join(opened, "value").select("bucket", "node", "n", "root").distinct(), "inside")
    blocks = inside.groupBy("bucket").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_MEMBERS)).alias("blocks"))
    dealt = inside.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    full = dealt.join(texts, dealt.node == texts.doc_id).select("bucket", "block", "node", "root", "text").mapInArrow(
        _sets_of(size), "bucket long, block long, node long, root long, full binary"
    )
    packed = stored(
        full.groupBy("bucket", "block").applyInArrow(
            _packed, "bucket long, block long, open long, ids binary, roots binary, sizes binary, values binary"
        ), "packed",
    )
    side = lambda s: packed.select("bucket", *(F.col(c).alias(f"{c}_{s}") for c in packed.columns[1:]))
    met = side("x").join(side("y"), "bucket").where("block_x <= block_y AND open_x + open_y > 0")
    return met.repartition("bucket", "block_x", "block_y").mapInArrow(_block_links(percent), "a long, b long")
