"""Inputs that once gave wrong or lost results, and user columns named like the operators' own."""

import zlib
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm import decontaminate
from tidemill.llm.decontaminate import contaminated
from tidemill.llm.near_dup import near_duplicates, without_near_duplicates
from tidemill.llm.packing import packed_documents
from tidemill.llm.quality import fit_quality, quality_scores, score_quality
from tidemill.llm.substring import dedup_substrings
from tidemill.llm.topk import top_k
from tidemill.llm.toxicity import toxicity_scores
from tidemill.llm.warc import read_archives, write_archives

TWIN = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
OTHER = TWIN.translate(str.maketrans("ab", "ba"))


def test_long_words_of_two_letters_have_their_own_ids(spark):
    texts = {1: TWIN, 2: OTHER, 3: f"x {TWIN[:1024]} y", 4: f"x {OTHER[:1024]} y", 5: f"{OTHER} {TWIN}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for piece in packed_documents(docs).collect():
        ids = tokenizer.encode(texts[piece.doc_id], add_special_tokens=False).ids + [1]
        part = ids[piece.start: piece.start + piece.length]
        assert piece.doc_tokens == len(ids) and piece.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


def test_long_words_of_two_letters_are_not_copies(spark):
    docs = spark.createDataFrame([(1, f"{TWIN} x y z q"), (2, f"{OTHER} x y z q"), (3, f"{TWIN} x  y z q")], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, False)}


def test_seeds_hit_every_overlap():
    """All ways to replace words of 8 to 20 that still count as an overlap."""
    for n in range(decontaminate.MIN_ITEM, decontaminate.WINDOW + 1):
        least = -(-n * decontaminate.PERCENT // 100)
        seeds = [{s + k for k, bit in enumerate(m) if bit == "1"} for m in decontaminate.MASKS for s in range(n - len(m) + 1)]
        for bad in combinations(range(n), n - least):
            assert any(not seed & set(bad) for seed in seeds), (n, bad)


def test_two_words_replaced_in_ten(spark):
    items = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh ii jj")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "aa bb cc X ee ff gg Y ii jj"), (2, "so aa bb cc X ee ff gg Y ii jj it is"), (3, "aa bb cc X ee Z gg Y ii jj")], "doc_id long, text string")
    assert {r.row.doc_id: len(r["items"]) for r in contaminated(docs, items).collect()} == {1: 1, 2: 1, 3: 0}


def test_long_vectors_are_ranked(spark):
    rows = [(0, [1e8, 1e8]), (1, [0.5, 0.25]), (2, [1.0, -1.0]), (3, [1.0, 1.0]), (50, [3e4, 2e4])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(x * 256 // 1) for x in v] for i, v in rows}
    want = set()
    for q in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in top_k(df).collect()} == want
    with pytest.raises(Exception, match="2\\*\\*61"):
        top_k(spark.createDataFrame([(0, [1e8, 1e8]), (1, [1e8, 1e8])], df.schema)).collect()


NAMES = ("id", "label", "_id", "_n", "_key", "_none", "_digest", "text_a", "row", "score", "kept", "gone", "user_3")


@pytest.fixture(scope="module")
def named(spark):
    base = " ".join(f"w{i}" for i in range(80)) + ". A sentence that stands in all of them. "
    texts = [(1, base + "one"), (2, base + "two"), (2, base), (3, "Other words make up this text, all new."), (None, base), (None, None), (4, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return docs.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("x"))) for n in NAMES})


def test_users_columns_come_back_as_they_were(spark, named):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    right = lambda rows: all(r[n] == n + ("x" if r.doc_id is None else str(r.doc_id)) for r in rows for n in NAMES)
    kept = without_near_duplicates(named)
    assert kept.columns == named.columns and right(kept.collect()) and {r.doc_id for r in kept.collect()} >= {1, 3, 4}
    for rows in (dedup_substrings(named).collect(), score_quality(named, fit_quality(named, labels)).collect()):
        assert len(rows) == 7 and right([r.row for r in rows])
    for scored in (quality_scores(named, labels), toxicity_scores(named, labels)):
        assert scored.count() == 7


def test_items_are_found_alike_by_broadcast_and_by_dealt_joins(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.selectExpr("doc_id + 100000", "text")).union(docs.limit(5).selectExpr("CAST(NULL AS LONG)", "text"))
    found = [
        sorted((r.row.doc_id or -1, r.row.text or "", r["items"]) for r in contaminated(docs, items, **options).collect())
        for options in ({}, {"broadcast_seeds": 0}, {"broadcast_seeds": 0, "hits_in_task": 3})
    ]
    assert found[0] == found[1] == found[2] and any(r[2] for r in found[0])


def test_archives_of_a_lost_attempt_are_not_read(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i % 7}", "p" * (90 + i % 30)) for i in range(200)], "page_id long, url string, html string").repartition(4)
    target, manifest = write_archives(pages)
    whole = sorted(r.page_id for r in read_archives(spark, target).collect())
    archives = sorted(Path(target.removeprefix("file://")).glob("*.warc.zst"))
    (archives[0].parent / "part-000000-lost-0000.warc.zst").write_bytes(archives[0].read_bytes())
    (archives[0].parent / "part-000001-lost-0000.warc.zst").write_bytes(archives[1].read_bytes()[:100])
    assert whole == list(range(200)) == sorted(r.page_id for r in read_archives(spark, target).collect())
    assert manifest.count() == len(archives) and manifest.agg(F.sum("records")).first()[0] == 200


def test_only_runs_of_enough_repeated_words_go(spark):
    passage = [f"Sentence number {k} of a passage that is copied." for k in range(4)]
    texts = [
        (1, " ".join(passage)),
        (2, f"New words. {passage[1]} More of them."),
        (3, f"Lead. {passage[0]}\n\n{passage[1]} {passage[2]} Tail."),
        (4, f"{passage[0]} Between. {passage[1]} {passage[2]}"),
        (5, "重复的段落没有空格" * 30), (6, "新的开头\n" + "重复的段落没有空格" * 30), (7, None), (8, "Short. Short. Short."),
    ]
    rows = {r.row.doc_id: r for r in dedup_substrings(spark.createDataFrame(texts, "doc_id long, text string"), run_words=25).collect()}
    assert [rows[k].kept_text for k in (1, 2, 4, 5, 7, 8)] == [dict(texts)[k] for k in (1, 2, 4, 5, 7, 8)]
    assert rows[3].kept_text == "Lead.\n\n Tail." and rows[6].kept_text == "新的开头\n"
    for r in rows.values():
        left = list(r.row.text or "")
        for s in reversed(r.removed):
            del left[s.start:s.end]
        assert "".join(left) == (r.kept_text or "")


def test_ids_equal_those_of_tokenizers():
    import random

    import pyarrow as pa

    from tidemill.llm.packing import Tokens
    from tidemill.llm.shared import text_bytes

    plain_tokens = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "b", "The", "'s", "12", "é", "重", "<|endoftext|>", "<|", "!", "..", "\x1c", "\u0085", " ", "　", "x" * 70]
    draw, tokens = random.Random(5), Tokens()
    for _ in range(20):
        texts = ["".join(draw.choices(parts, k=draw.randrange(30))) for _ in range(100)]
        got = tokens.batch(*text_bytes(pa.array(texts)))
        assert [ids.tolist() for ids in got] == [plain_tokens.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_sent_to_the_cut_once(spark):
    """The cut takes the text from the row, wherever it stands there, and gets no second copy."""
    passage = "One sentence of the passage that stands in both texts. " * 6
    rows = [(passage + "Tail one.", 5, 1), ("Head two. " + passage, 6, 2), (None, 7, 3), ("", 8, 4)]
    docs = spark.createDataFrame(rows, "text string, note long, doc_id long")
    out = dedup_substrings(docs, run_words=25)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sent = next(x for x in plan[plan.index("MapInArrow"):].splitlines()[1:] if "Project" in x)
    assert "AS text" not in sent
    got = {r.row.doc_id: (r.row.note, r.kept_text) for r in out.collect()}
    assert got[3] == (7, None) and got[4] == (8, "") and got[2] == (6, "Head two. ")
    assert len(got[1][1]) < len(rows[0][0]) and got[1][1].endswith("Tail one.")


def test_waiting_examples_hold_their_own_ids_only(monkeypatch):
    """The ids of long documents do not stay in the task until their last stretch is packed."""
    import pyarrow as pa

    from tidemill.llm import packing

    made, held = [], []
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("At", (), {"partitionId": lambda self: 0})())}))
    monkeypatch.setattr(packing, "Packer", lambda limits, kind=packing.Packer: made.append(kind(limits)) or made[-1])

    def batches():
        for k in range(3):
            texts = [" ".join(f"w{i}" for i in range(4_000 + 37 * (5 * k + j))) for j in range(5)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(range(5 * k, 5 * k + 5)), "text": texts})
        for example in (x for waiting in made[0].waiting for x in waiting):
            held.extend((x if x.base is None else x.base).nbytes for x in example if isinstance(x, np.ndarray))

    pieces = [r for out in packing._pieces(packing.Limits(), None)(batches()) for r in out.to_pylist()]
    assert len(held) == 15 and max(held) <= 4 * packing.Limits().tokens
    for doc_id in range(15):
        own = sorted((r["start"], r["length"], r["doc_tokens"]) for r in pieces if r["doc_id"] == doc_id)
        assert [a for a, _, _ in own] == [0, *np.cumsum([n for _, n, _ in own])[:-1]] and sum(n for _, n, _ in own) == own[0][2]


@pytest.mark.parametrize("seeds_sent", [decontaminate.BROADCAST_SEEDS, 0])
def test_hits_and_their_verification_run_in_different_tasks(spark, monkeypatch, seeds_sent):
    """A task with two Python steps holds two workers; both stay with the executor and so add to its memory for good."""
    steps = []

    def stored(df, name, keep=decontaminate.stored):
        steps.append(df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"))
        return keep(df, name)

    monkeypatch.setattr(decontaminate, "stored", stored)
    words = " ".join(f"word{k}" for k in range(40))
    docs = spark.createDataFrame([(1, f"before {words} after"), (2, "nothing of it " * 20), (3, None)], "doc_id long, text string")
    out = contaminated(docs, spark.createDataFrame([(7, words)], "item_id long, text string"), broadcast_seeds=seeds_sent)
    assert max(steps) == 1
    assert {r.row.doc_id: r["items"] for r in out.collect()} == {1: [7], 2: [], 3: []}
