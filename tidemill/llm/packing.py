"""Vector bin packing of tokenised examples into training sequences, by the dot-product heuristic."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import in_batches, named, rows, slices, text_bytes
from tidemill.llm.words import space

#: Examples that wait in a task until they are packed, and how many of them stay for a better choice later.
POOL, KEEP = 4096, 512
#: Chunks of text whose ids a task remembers; when full it starts anew.
REMEMBERED = 400_000
#: Bytes of a chunk that is remembered.
LONGEST = 64
END_ID = 1


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most. ``least`` is the shortest piece that a cut may leave (0: never cut)."""

    tokens: int = 2048
    segments: int = 1024
    loss: int = 2048
    least: int = 16


class Packer:
    """Fills one sequence at a time: of all waiting examples that fit, the one whose (tokens, segments, loss) has the
    largest dot product with what is left, both as shares of the limits. Equal vectors are one class, so a step
    costs the number of classes. If none fits and cuts are allowed, the longest example gives the missing tokens.
    """

    def __init__(self, limits: Limits):
        self.limits = limits
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.classes: dict[tuple[int, int], int] = {}
        self.vectors = np.zeros((256, 3))
        self.waiting: list[list] = []
        self.counts = np.zeros(256, np.int64)
        self.size = 0

    def add(self, tokens: int, loss: int, example) -> None:
        key = (tokens, loss)
        at = self.classes.setdefault(key, len(self.classes))
        if at == len(self.waiting):
            self.waiting.append([])
            if at == len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.vectors[at] = tokens, 1, loss
        self.waiting[at].append(example)
        self.counts[at] += 1
        self.size += 1

    def _take(self, at: int):
        self.counts[at] -= 1
        self.size -= 1
        return self.waiting[at].pop()

    def sequence(self) -> list[tuple]:
        """(example, tokens) pieces of the next sequence; a cut example returns to the pool with its rest."""
        left, out = self.caps.copy(), []
        while self.size:
            vectors = self.vectors[: len(self.waiting)]
            fits = (self.counts[: len(vectors)] > 0) & (vectors <= left).all(1)
            if fits.any():
                score = np.where(fits, vectors @ (left / self.caps**2), -1.0)
                at = int(score.argmax())
                left -= vectors[at]
                out.append((self._take(at), int(vectors[at][0])))
                continue
            room = int(left[0])
            if not self.limits.least or room < self.limits.least or left[1] < 1:
                break
            # Only examples that bear loss throughout are cut, and only where both parts are long enough.
            whole = (self.counts[: len(vectors)] > 0) & (vectors[:, 0] == vectors[:, 2]) & (vectors[:, 0] >= room + self.limits.least)
            room = min(room, int(left[2]))
            if not whole.any() or room < self.limits.least:
                break
            at = int(np.where(whole, vectors[:, 0], -1).argmax())
            tokens = int(vectors[at][0])
            example = self._take(at)
            out.append((example, room))
            rest = (*example[:-1], example[-1] + room)
            self.add(tokens - room, tokens - room, rest)
            break
        return out

    def sequences(self, keep: int = 0) -> Iterator[list[tuple]]:
        while self.size > keep:
            yield self.sequence()
        if not self.size:
            self.__init__(self.limits)


class Tokens:
    """Ids of whole texts by a byte-level BPE vocabulary.

    The vocabulary's pattern never joins what stands before white space to it, so a text is cut where a run of ASCII
    white space begins and every distinct chunk is tokenised once and remembered. Texts with other white space or
    control characters are tokenised whole.
    """

    _ODD = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"\x1c", b"\x1d", b"\x1e", b"\x1f"]

    def __init__(self, ranks: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(table)}
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)
        self.known: dict[bytes, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode(text, allowed_special="all"), np.uint32)

    def _chunk(self, raw: bytes) -> bytes:
        text = raw.decode()
        ids = self.encoding.encode(text, allowed_special="all") if "<|" in text else self.encoding.encode_ordinary(text)
        return np.array(ids, np.uint32).tobytes()

    def batch(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of every text."""
        data = raw.tobytes()
        if any(x in data for x in self._ODD):
            odd = [any(x in data[a:b] for x in self._ODD) for a, b in zip(offsets[:-1], offsets[1:])]
        else:
            odd = [False] * (len(offsets) - 1)
        blank = space(raw)
        begins = np.zeros(len(raw) + 1, bool)
        begins[:-1] = blank
        begins[1:-1] &= ~blank[:-1]
        begins[offsets] = True
        begins[len(raw)] = False
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(raw))
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, ids = self.known, []
        for a, b in zip(start.tolist(), end.tolist()):
            chunk = data[a:b]
            got = known.get(chunk)
            if got is None:
                got = self._chunk(chunk)
                if len(chunk) <= LONGEST:
                    known[chunk] = got
            ids.append(got)
        bound = np.searchsorted(start, offsets).tolist()
        return [
            self.encode(data[a:b].decode()) if o else np.frombuffer(b"".join(ids[i:j]), np.uint32)
            for o, a, b, i, j in zip(odd, offsets[:-1], offsets[1:], bound[:-1], bound[1:])
        ]


_tokens: dict = {}


def tokens(ranks: str | None = None) -> Tokens:
    """The tokeniser of this worker, loaded once."""
    if ranks not in _tokens:
        _tokens[ranks] = Tokens(ranks)
    return _tokens[ranks]


_PIECE = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _pieces(limits: Limits, ranks: str | None):
    whole = min(limits.tokens, limits.loss)

    def run(batches):
        number = TaskContext.get().partitionId() << 36
        packer, tokeniser = Packer(limits), tokens(ranks)

        def written(sequences):
            nonlocal number
            out = []
            for pieces in sequences:
                offset = 0
                for (doc_id, total, first, ids, at), length in pieces:
                    out.append((doc_id, first + at, length, zlib.crc32(ids[at: at + length].tobytes()), total, number, offset))
                    offset += length
                number += 1
            return rows(_PIECE, *zip(*out)) if out else None

        def encoded(batch):
            for part in slices([batch]):
                yield from zip(named(part, "doc_id").to_pylist(), tokeniser.batch(*text_bytes(named(part, "text"))))

        for batch in slices(batches, 1_500_000):
            full = []
            for doc_id, ids in encoded(batch):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), whole):
                    piece = ids[start: start + whole]
                    size = len(piece)
                    if size == limits.tokens:
                        full.append([((doc_id, len(ids), start, piece, 0), size)])
                    else:
                        # A copy: what waits holds its own ids only, not those of its whole document.
                        packer.add(size, size, (doc_id, len(ids), start, piece.copy(), 0))
            out = written(full)
            if out:
                yield out
            if packer.size > POOL and (out := written(packer.sequences(KEEP))):
                yield out
        if out := written(packer.sequences()):
            yield out

    return run


def packed_documents(docs: DataFrame, limits: Limits = Limits(), ranks: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: the pieces of all documents.

    A document is its ids and the end id, all of them bearing loss. Stretches of a full sequence are sequences of
    their own; what remains waits in its task until enough examples are there to choose from. A task reads its
    documents once, packs them as it goes and shuffles nothing; its last sequence may be short. Sequence ids are
    unique over all tasks and the same when a task runs again. Memory follows the longest text; an example that waits
    takes the ids of at most one sequence.

    A null or empty text is the end id alone. Null ids are kept; rows that repeat an id are documents of their own.
    Empty table: no rows. Other columns are ignored.
    """
    return in_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pieces(limits, ranks), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )


def packed_examples(examples: DataFrame, limits: Limits = Limits(least=0)) -> DataFrame:
    """``example_id, n_tokens, n_loss`` -> ``example_id, sequence_id, offset``: instruction data, never cut.

    Every row gets one place. An example beyond a limit by itself has null for both. Null counts are 0.
    """
    schema = pa.schema([("example_id", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        number = TaskContext.get().partitionId() << 36
        packer = Packer(limits)

        def written(sequences):
            nonlocal number
            out = []
            for pieces in sequences:
                offset = 0
                for (example,), n in pieces:
                    out.append((example, number, offset))
                    offset += n
                number += 1
            return rows(schema, *zip(*out)) if out else None

        for batch in batches:
            alone = []
            for example, n, loss in zip(*(named(batch, c).to_pylist() for c in ("example_id", "n_tokens", "n_loss"))):
                if n > limits.tokens or loss > limits.loss:
                    alone.append((example, None, None))
                else:
                    packer.add(n, loss, (example,))
            if alone:
                yield rows(schema, *zip(*alone))
            if packer.size > POOL and (out := written(packer.sequences(KEEP))):
                yield out
        if out := written(packer.sequences()):
            yield out

    counts = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("n_tokens", "n_loss")]
    return examples.select(F.col("example_id").cast("long"), *counts).mapInArrow(run, "example_id long, sequence_id long, offset long")
