"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.quality import labelled_sample
from tidemill.llm.shared import crc_bucket, in_batches, named, rows, slices

#: Labelled rows a lexicon is learnt from at most, and terms it takes from them at most (the heaviest).
TRAIN_ROWS, TERMS = 30_000, 2_000
#: Weights before anything is learnt.
SEED = {
    "idiot": 2.0, "moron": 2.0, "scum": 2.5, "loser": 1.5, "stupid": 1.5, "pathetic": 1.5, "worthless": 2.0,
    "disgusting": 1.5, "trash": 1.0, "clown": 1.0, "imbecile": 2.0, "dumb": 1.5, "vermin": 2.0, "filth": 1.5,
}
#: Phrases in which a term of the lexicon says nothing bad.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "circus clown", "sore loser", "trash collection")

#: Look-alikes beyond what compatibility normalisation folds.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁһкмтвнɡαενορτυικχℓıłøđ", "aeopcyxijsdhkmtbhgaevoptuikxlilod"
)
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_INSIDE = re.compile(r"(?<=[a-z])[013457@$!]+(?=[a-z])|(?<![^\W_])[013457@$]+(?=[a-z])|(?<=[a-z])[013457]+(?![^\W_])")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")


def folded(text: str) -> str:
    """Lower case without accents, look-alike letters and the digits and signs that stand for letters in a word.

    Signs after the last letter of a word stay, so that trailing junk does not change the word.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
        text = "".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text
        text = text.lower().translate(HOMOGLYPHS)
    else:
        text = text.lower()
    return _INSIDE.sub(lambda m: "".join(LEET[c] for c in m[0]), text)


@dataclass
class Lexicon:
    """Terms with weights, harmless phrases, and how a density becomes a score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 3.0, 1.0]))

    def __post_init__(self):
        self.automaton = None

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "automaton": None}

    def matcher(self):
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self.automaton.add_word(phrase, (len(phrase), None))
            for term, weight in self.weights.items():
                if term not in self.exceptions:
                    self.automaton.add_word(term, (len(term), weight))
            self.automaton.make_automaton()
        return self.automaton

    def weight(self, text: str) -> tuple[float, int]:
        """Total weight and number of whole-word terms outside of harmless phrases."""
        text = folded(text)
        found, harmless = [], []
        if self.weights or self.exceptions:
            for end, (size, weight) in self.matcher().iter(text):
                start = end + 1 - size
                if (start and text[start - 1].isalnum()) or (end + 1 < len(text) and text[end + 1].isalnum()):
                    continue
                (harmless if weight is None else found).append((start, end, weight))
        if harmless:
            found = [x for x in found if not any(a <= x[0] and x[1] <= b for a, b, _ in harmless)]
        return sum(x[2] for x in found), len(found)

    def inputs(self, texts: list[str | None]) -> np.ndarray:
        """(total weight on a log scale, weight per root of the length in words) of each text."""
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            if text:
                total, n = self.weight(text)
                if n:
                    out[i] = np.log1p(max(total, 0)), max(total, 0) / np.sqrt(1 + text.count(" ") + text.count("\n"))
        return out

    def score(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + inputs @ self.curve[1:], -35, 35)))


_WORD = re.compile(r"[^\W\d_]{3,30}")


def _document_words(batches):
    schema = pa.schema([("label", pa.int32()), ("term", pa.string())])
    for batch in slices(batches):
        label, term = [], []
        for y, text in zip(named(batch, "label").to_pylist(), named(batch, "text").to_pylist()):
            words = set(_WORD.findall(folded(text or "")))
            label += [y] * len(words)
            term += words
        yield rows(schema, label, term)


def fit_lexicon(docs: DataFrame, labels: DataFrame, train=lambda c: F.lit(True), limit: int = TRAIN_ROWS) -> Lexicon:
    """Weights from a bounded sample of labelled documents, then a logistic curve over the densities.

    A word joins the lexicon if its log odds ratio between toxic and other documents exceeds 1 by more than three
    standard errors; a seed word keeps its own weight until it has such evidence. The counts are a Spark aggregate.
    """
    sample = labelled_sample(in_batches(docs), labels, "toxic", train, limit).select("id", "label", "text")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon(dict(SEED))
    if not bad or not good:
        return lexicon
    words = sample.mapInArrow(_document_words, "label int, term string").groupBy("term").agg(
        F.sum(F.col("label")).alias("b"), F.sum(1 - F.col("label")).alias("g")
    ).where("b >= 3")
    b, g = F.col("b") + 0.5, F.col("g") + 0.5
    odds = F.log(b / (bad + 1 - b) / (g / (good + 1 - g)))
    error = F.sqrt(1 / b + 1 / (bad + 1 - b) + 1 / g + 1 / (good + 1 - g))
    learnt = words.select("term", odds.alias("w"), error.alias("e")).where("w - 3 * e > 1").orderBy(F.desc("w"), "term").limit(TERMS)
    lexicon.weights |= {r.term: float(min(r.w, 6.0)) for r in learnt.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("x", pa.float64()), ("y", pa.float64())])

    def run(batches):
        for batch in slices(batches):
            x = shared.value.inputs(named(batch, "text").to_pylist())
            yield rows(schema, named(batch, "id"), named(batch, "label"), x[:, 0], x[:, 1])

    got = sample.mapInArrow(run, "id long, label int, x double, y double").toArrow().sort_by("id")
    x = np.stack([np.ones(got.num_rows), np.asarray(got.column("x")), np.asarray(got.column("y"))], 1)
    y, curve = np.asarray(got.column("label"), float), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -35, 35)))
        slope = x.T @ (p - y) + 0.1 * curve
        curve = curve - np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.1 * np.eye(3), slope)
    lexicon.curve = curve
    return lexicon


def toxicity_scores(docs: DataFrame, labels: DataFrame, modulus: int = 5, rest: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document, whole texts.

    Labels are learnt only outside the fold ``crc32(doc_id as text) mod modulus = rest``. A null or empty text has no
    terms and the score of a text without terms; rows with a null id and repeated rows are scored like any other.
    Without both labels the seed lexicon and a fixed curve are used. Empty table: no rows.
    """
    lexicon = fit_lexicon(docs, labels, lambda c: crc_bucket(c, modulus) != rest)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in slices(batches):
            yield rows(schema, named(batch, "doc_id"), shared.value.score(shared.value.inputs(named(batch, "text").to_pylist())))

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", (crc_bucket(F.col("doc_id"), modulus) == rest).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
