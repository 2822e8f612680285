"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import crc_bucket, in_batches, named, rows, slices, text_bytes
from tidemill.llm.words import lower_ascii, prefix_sums, space, spans, word_spans

#: Hashed words, factors, and the labelled rows a model is fitted on at most (the first by hash of the id).
BUCKETS, FACTORS, TRAIN_ROWS = 4096, 8, 12_000
#: Texts whose dense word counts are held at once.
ROWS_AT_ONCE = 128

_KINDS = [
    lambda b: (b >= 65) & (b <= 90),
    lambda b: (b >= 97) & (b <= 122),
    lambda b: (b >= 48) & (b <= 57),
    space,
    lambda b: b == 10,
    lambda b: b >= 128,
    lambda b: np.isin(b, np.frombuffer(b".,;:?'\"-()", np.uint8)),
    lambda b: b == 33,
    lambda b: b == 124,
    lambda b: np.isin(b, np.frombuffer(b"#$%&*@<>{}[]\\^_`~=+/", np.uint8)),
]
STATS = len(_KINDS) + 8


def _features(raw: np.ndarray, offsets: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense (texts, BUCKETS) word weights of length 1, and (texts, STATS) statistics."""
    n, size = len(offsets) - 1, np.diff(offsets)
    shares = np.empty((n, len(_KINDS)))
    for k, kind in enumerate(_KINDS):
        total = np.concatenate([[0], np.cumsum(kind(raw), dtype=np.int64)])
        shares[:, k] = np.diff(total[offsets])
    lines = shares[:, 4] + 1
    start, end, text = word_spans(space(raw), offsets)
    hashes = spans(prefix_sums(lower_ascii(raw)), start, end)
    counts = np.bincount(text * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
    words = np.bincount(text, minlength=n)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    some = np.maximum(words, 1)
    more = np.stack([
        np.log1p(size) / 10, np.log1p(words) / 8, np.log1p(np.maximum(chars, 0)) / 10,
        np.bincount(text, end - start, minlength=n) / some / 10,
        np.bincount(text, again, minlength=n) / some,
        (counts > 0).sum(1) / some, counts.max(1, initial=0) / some, np.log1p(words / lines) / 5,
    ], 1)
    weights = np.sqrt(counts.astype(np.float32))
    weights /= np.maximum(np.sqrt((weights**2).sum(1, keepdims=True)), 1e-9)
    return weights, np.concatenate([shares / np.maximum(size, 1)[:, None], more], 1).astype(np.float32)


@dataclass
class Machine:
    """w0 + w.x + half of (sum of v x)^2 - sum of (v x)^2, summed over the factors: linear in the features."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, words: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return np.concatenate([words, np.clip((stats - self.mean) / self.scale, -4, 4) / 2], 1, dtype=np.float32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        sums = x @ self.factors
        squares = (x * x) @ (self.factors * self.factors)
        return self.bias + x @ self.linear + 0.5 * (sums * sums - squares).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(np.float64), -35, 35)))


def fitted(words: list, weights: list, stats: np.ndarray, label: np.ndarray, rounds: int = 12, rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """Logistic loss, mini-batches, step sizes per coordinate. Without both labels only the bias is fitted."""
    size, n = BUCKETS + STATS, len(label)
    rng = np.random.default_rng(7)
    model = Machine(0.0, np.zeros(size, np.float32), rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32), np.zeros(STATS, np.float32), np.ones(STATS, np.float32))
    if not n:
        return model
    share = float(np.clip(label.mean(), 0.01, 0.99))
    model.bias = float(np.log(share / (1 - share)))
    if label.min() == label.max():
        return model
    model.mean, model.scale = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    seen = [np.full(1, 1e-3), np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32)]
    for _ in range(rounds):
        order = rng.permutation(n)
        for at in np.split(order, range(256, n, 256)):
            dense = np.zeros((len(at), BUCKETS), np.float32)
            for i, j in enumerate(at):
                dense[i, words[j]] = weights[j]
            x = model.inputs(dense, stats[at])
            error = (model.score(x) - label[at]).astype(np.float32) / len(at)
            sums = x @ model.factors
            slopes = [
                np.array([error.sum()]),
                x.T @ error + decay * model.linear,
                x.T @ (error[:, None] * sums) - model.factors * ((x * x).T @ error)[:, None] + decay * model.factors,
            ]
            for s, g in zip(seen, slopes):
                s += g * g
            model.bias -= float(rate * slopes[0][0] / np.sqrt(seen[0][0]))
            model.linear -= rate * slopes[1] / np.sqrt(seen[1])
            model.factors -= rate * slopes[2] / np.sqrt(seen[2])
    return model


def _chunks(batches):
    for batch in slices(batches):
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            chars = part.column(part.schema.get_field_index("chars")).to_numpy(zero_copy_only=False)
            yield part, *_features(*text_bytes(named(part, "text")), np.nan_to_num(chars.astype(float)))


_TRAIN = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("words", pa.list_(pa.int16())), ("weights", pa.list_(pa.float32())), ("stats", pa.list_(pa.float32()))])


def _training_rows(batches):
    for part, words, stats in _chunks(batches):
        at = [np.flatnonzero(w) for w in words]
        yield rows(
            _TRAIN, named(part, "id"), named(part, "label"), [a.astype(np.int16) for a in at],
            [w[a] for w, a in zip(words, at)], list(stats),
        )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, limit: int) -> DataFrame:
    """Documents with a label of the training fold: at most ``limit`` ids, the first by a hash of the id.

    Null ids and labels are left out; of several labels of one id the smallest counts.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(train(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id")).agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(limit)
    )
    # Only what is learnt from: other columns may have any name.
    docs = docs.select(*(c for c in ("doc_id", "text", "n_chars") if c in docs.columns))
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("id"))


def _inputs(docs: DataFrame, *extra) -> DataFrame:
    in_batches(docs)
    chars = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")
    return docs.select(*extra, "text", F.coalesce(chars.cast("double"), F.lit(0.0)).alias("chars"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", train=lambda c: F.lit(True), limit: int = TRAIN_ROWS) -> Machine:
    """Fit on a bounded sample of labelled documents of the fold ``train``; only their features reach the driver."""
    sample = labelled_sample(docs, labels, label, train, limit)
    got = _inputs(sample, "id", "label").mapInArrow(
        _training_rows, "id long, label int, words array<short>, weights array<float>, stats array<float>"
    ).toArrow()
    got = got.sort_by("id")
    lists = lambda c: [np.asarray(x.values) for x in got.column(c)]
    stats = np.array(lists("stats"), np.float32).reshape(-1, STATS)
    return fitted(lists("words"), lists("weights"), stats, np.asarray(got.column("label"), np.float32))


def score_quality(docs: DataFrame, model: Machine) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with its ``score`` (0 to 1).

    A null text counts as empty and is scored like any other; so are rows with a null id and repeated rows.
    """
    machine = docs.sparkSession.sparkContext.broadcast(model)
    wide = docs.withColumn("row", F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    schema = wide.select("row").schema.add("score", "double")

    def run(batches):
        for part, words, stats in _chunks(batches):
            score = machine.value.score(machine.value.inputs(words, stats))
            yield pa.RecordBatch.from_arrays([named(part, "row"), pa.array(score, pa.float64())], ["row", "score"])

    return _inputs(wide, "row").mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, rest: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Labels are learnt only from documents outside the fold ``crc32(doc_id as text) mod modulus = rest``. Labels,
    language, source and id are no inputs. Without usable labels every score is 0.5; with one label only it is
    that label's clipped share. Empty table: no rows.
    """
    train = lambda c: crc_bucket(c, modulus) != rest
    model = fit_quality(docs, labels, train=train)
    scored = score_quality(docs, model)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), (crc_bucket(F.col("row.doc_id"), modulus) == rest).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
