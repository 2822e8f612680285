"""Operators on whole small tables and on awkward rows, against brute force, round trips or held-out labels."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest

from tests.compare import difference, oracle, spark_result, sql_result, type_difference
from tidemill.llm import near_dup, suffix
from tidemill.llm.components import components
from tidemill.llm.decontaminate import contaminated, contamination
from tidemill.llm.licenses import license_scan
from tidemill.llm.near_dup import near_duplicates
from tidemill.llm.packing import Limits, packed_documents, packed_examples, tokens
from tidemill.llm.quality import quality_scores
from tidemill.llm.queries import QUERIES, SQL
from tidemill.llm.substring import dedup_substrings
from tidemill.llm.suffix import byte_digests
from tidemill.llm.topk import top_k
from tidemill.llm.toxicity import folded, toxicity_scores
from tidemill.llm.warc import read_archives, write_archives

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, component_id long"


def words(n, seed=0):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 10**9, n)]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing column names."""
    base = words(60, 1)
    near = base[:-1] + ["other"]
    texts = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (3, " ".join(base)), (4, ""), (5, None), (None, " ".join(base)),
        (None, None), (6, "one two"), (7, "One  TWO"), (8, " ".join(words(30_000, 2))), (9, "a" * 5000), (10, " \n\t "), (11, "é x y <|endoftext|> z"),
    ]
    return spark.createDataFrame([(i, t, None, None, None, 0.5, "r", None) for i, t in texts], DOCS)


def shingles(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[j:j + 5]) for j in range(len(w) - 4)])


def brute_components(docs):
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(t) for i, t in docs.items()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for j, n in collections.Counter(j for v in s for j in where[v]).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for v in s:
            where[v].append(i)
    return {i: (len(sets[i]), find(i)) for i in docs}


def table_docs(folder):
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    assert type_difference(df, con, SQL[name]) is None
    assert difference(spark_result(df), sql_result(con, SQL[name])) is None


def test_near_duplicates_equal_brute_force(spark, folder):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_minhash_near_dedup"](spark, folder).collect()}
    assert got == brute_components(table_docs(folder))


def test_near_copies_of_one_text_in_long_lists(spark, monkeypatch):
    """Copies with one to eight edits: the leader links the close ones, blocks settle the rest."""
    monkeypatch.setattr(near_dup, "SHORT_LIST", 2)
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 10)
    base, rng, docs = words(120, 3), np.random.default_rng(4), {}
    for i in range(60):
        text = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 9)):
            text[at] = f"e{rng.integers(0, 4)}"
        docs[i] = " ".join(text)
    got = near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs)


def test_links_that_no_leader_finds(spark, monkeypatch):
    """Windows over one long text: neighbours are linked, and most are far from the leader of their list."""
    calls = []
    monkeypatch.setattr(near_dup, "SHORT_LIST", 2)
    monkeypatch.setattr(near_dup, "components", lambda links: calls.append(links.columns) or components(links))
    text, ids = words(400, 6), [int(x) for x in np.random.default_rng(7).permutation(60)]
    docs = {i: " ".join(text[5 * k: 5 * k + 100]) for k, i in enumerate(ids)}
    got = near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs)
    assert calls == [["a", "b"]] * 2


def test_near_duplicates_of_awkward_rows(awkward):
    rows = near_duplicates(awkward).collect()
    got = collections.defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.component_id, r.kept))
    assert len(rows) == 14
    assert got[1] == {(1, True)} and got[2] == got[3] == {(1, False)} and got[None] == {(None, True)}
    assert got[4] == {(4, True)} and got[5] == {(5, True)} and got[10] == {(10, True)} and got[7] == {(6, False)}


def test_near_duplicates_go_by_row_not_by_id(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(words(40, k)) for k in range(30, 34))
    texts = [(1, a), (5, a), (5, b), (None, a), (None, c), (None, c), (None, c + " end"), (None, d), (None, ""), (None, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.component_id, r.kept) for r in near_duplicates(docs).collect() if r.doc_id == 5}
    assert got == {(1, False), (5, True)}
    left = sorted((r.doc_id or 0, r.text[:len(c)]) for r in corpus_pipeline.near_dup(spark, docs, "").collect())
    assert left == sorted([(1, a), (5, b), (0, c), (0, d), (0, ""), (0, "")])


def brute_bytes(docs):
    seen, out = set(), {}
    for i, text in sorted(docs.items()):
        data, cover = (text or "").encode(), set()
        for j in range(len(data) - 99):
            if data[j:j + 100] in seen:
                cover.update(range(j, j + 100))
            seen.add(data[j:j + 100])
        kept = bytes(c for k, c in enumerate(data) if k not in cover)
        out[i] = (len(data), len(cover), sum(k - 1 not in cover for k in cover), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("together", [2, 2000])
def test_repeated_bytes_equal_brute_force(spark, folder, monkeypatch, together):
    monkeypatch.setattr(suffix, "TOGETHER", together)
    monkeypatch.setattr(suffix, "_SLICE", 60_000)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_suffix_array_dedup"](spark, folder).collect()}
    assert got == brute_bytes(table_docs(folder))


def test_repeated_bytes_of_awkward_rows(awkward):
    rows = collections.defaultdict(list)
    for r in byte_digests(awkward).collect():
        rows[r.doc_id].append(r)
    size = rows[1][0].n_bytes
    assert [r.n_removed for r in rows[1]] == [0] and [r.n_removed for r in rows[3]] == [size] * 2
    assert sorted((r.n_bytes, r.n_removed) for r in rows[None]) in ([(0, 0), (size, 0)], [(0, 0), (size, size)])
    assert rows[9][0].n_removed == 4999 and rows[9][0].n_spans == 1 and rows[5][0].n_bytes == 0


def test_every_text_of_a_repeated_or_null_id_is_searched(spark):
    a, b, c, d, e = (" ".join(words(40, k)) for k in range(20, 25))
    texts = [(1, a), (2, b), (2, f"{c} {a}"), (2, f"{c} {a}"), (None, f"{d} {b}"), (None, f"{e} {d}"), (2**63 - 1, e), (3, c)]
    got = {(r.row.doc_id, r.row.text): bytes(r.kept).decode() for r in suffix.dedup_bytes(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1, a] == a and got[2, b] == b and got[2, f"{c} {a}"].strip() == c and got[3, c] == "" and got[2**63 - 1, e] == e
    nulls = sorted((got[None, f"{d} {b}"].strip(), got[None, f"{e} {d}"].strip()))
    assert nulls in (sorted((d, "")), sorted(("", d)))


def test_substrings_of_awkward_rows(awkward):
    rows = collections.defaultdict(list)
    for r in dedup_substrings(awkward).collect():
        rows[r.row.doc_id].append(r)
    assert rows[1][0].removed == [] and rows[3][0].kept_text == rows[3][1].kept_text == "" and rows[5][0].kept_text is None
    assert rows[4][0].kept_text == "" and rows[8][0].removed == [] and rows[1][0].row.score == 0.5
    span = rows[3][0].removed[0]
    assert (span.start, span.end) == (0, len(rows[3][0].row.text))


def test_units_of_one_id_or_none_are_cut_in_their_own_row_only(spark):
    a, b, c, d = (f"This is the sentence of kind {k} here." for k in "abcd")
    texts = [(1, a), (None, a), (None, b), (None, c + "\n" + d), (None, d), (2, a + "\n" + b), (2, c), (2, c)]
    rows = dedup_substrings(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    got = {(r.row.doc_id, r.row.text): r.kept_text.strip() for r in rows}
    assert len(rows) == 8 and got[1, a] == a and got[2, a + "\n" + b] == b and got[2, c] == c
    assert got[None, a] == "" and got[None, b] == ""
    assert sorted((got[None, c + "\n" + d], got[None, d])) == ["", d]


def test_passage_inside_lines_is_cut_with_offsets(spark):
    passage = "Here is one sentence of a passage. And here is the next one of it."
    docs = spark.createDataFrame([(1, "Intro words. " + passage), (2, "Other lead\n" + passage + " The end is new here.")], "doc_id long, text string")
    second = next(r for r in dedup_substrings(docs).collect() if r.row.doc_id == 2)
    assert "next one" not in second.kept_text and "The end is new here." in second.kept_text
    assert all(passage.find(second.row.text[s.start:s.end].strip()[:10]) >= 0 for s in second.removed)


def plain(text):
    return [re.sub("[A-ZÀ-ÖØ-Þ]", lambda m: m[0].lower(), w) for w in re.findall("[a-zA-Z0-9\u0080-\U0010ffff]+", text or "")]


def brute_items(text, items, window=20, percent=80):
    w, found = plain(text), set()
    for item, b in items.items():
        b = plain(b)
        need = min(window, len(b))
        for shift in range(-len(b), len(w)) if len(b) >= 8 else ():
            same = [0 <= shift + q < len(w) and w[shift + q] == b[q] for q in range(len(b))]
            for q in range(len(b) - need + 1):
                if 0 <= shift + q and shift + q + need <= len(w) and sum(same[q:q + need]) * 100 >= percent * need:
                    found.add(item)
    return sorted(found)


def test_decontamination_equals_brute_force(spark, folder):
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall())
    docs = {i: t for i, t in table_docs(folder).items() if len(t) < 2500}
    got = {r.doc_id: r["items"] for r in QUERIES["op9_benchmark_decontamination"](spark, folder).collect()}
    assert {i: got[i] for i in docs} == {i: brute_items(t, items) for i, t in docs.items()}


def test_replaced_words_do_not_hide_a_passage(spark, awkward):
    item = words(40, 5)
    text = list(item)
    for at in (3, 11, 18, 26, 33):
        text[at] = "replaced"
    docs = spark.createDataFrame([(1, "lead " + " ".join(text) + " tail"), (2, " ".join(words(60, 6)))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, None), (None, "x"), (9, "too short")], "item_id long, text string")
    assert {r.doc_id: r["items"] for r in contamination(docs, benchmark).collect()} == {1: [7], 2: []}
    assert contaminated(awkward, benchmark).count() == 14 and contaminated(docs, benchmark.limit(0)).where("size(items) > 0").isEmpty()


def test_short_and_unspaced_items_are_found(spark):
    zh, th = "水是由氢和氧两种元素组成的化合物，常温下是无色无味的液体。", "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"
    texts = [
        (1, "He asked: who wrote Hamlet? Nobody knew."), (2, "Who wrote it, Hamlet or the king?"), (3, "前言如下：" + zh.replace("无色", "白色") + "完"),
        (4, "คำนำ" + th + "จบ"), (5, "Ends in who wrote"), (6, "Hamlet is here"), (7, "東京"), (8, ""), (9, "水是液体。" * 3),
    ]
    items = [(1, "Who wrote Hamlet?"), (2, zh), (3, th), (4, "Who wrote Hamlet"), (5, "東京"), (6, "?!"), (7, "Nobody")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r["items"] for r in contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: [1, 4, 7], 2: [], 3: [2], 4: [3], 5: [], 6: [], 7: [5], 8: [], 9: []}


def test_packing_is_a_round_trip(spark, awkward, folder):
    from tokenizers import Tokenizer

    import public_tokenizers

    plain_tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for docs in (awkward.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), spark.read.parquet(f"{folder}/documents.parquet")):
        texts = {r.doc_id: r.text for r in docs.collect()}
        ids = {i: np.array(plain_tokens.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
        rows = packed_documents(docs).collect()
        sequences, covered = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            piece = ids[r.doc_id][r.start:r.start + r.length]
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
            sequences[r.sequence_id].append((r.offset, r.length))
            covered[r.doc_id].append((r.start, r.length))
        for pieces, total in [(p, 2048) for p in sequences.values()] + [(p, len(ids[i])) for i, p in covered.items()]:
            at = 0
            for start, length in sorted(pieces):
                assert start == at
                at += length
            assert at <= total
        assert sum(r.length for r in rows) == sum(map(len, ids.values())) and set(covered) == set(texts)


def test_remembered_chunks_give_the_same_ids():
    import pyarrow as pa

    from tidemill.llm.shared import text_bytes

    texts = ["a  b\n\n c", "", " x y", " lead", "it's  don't\t\tx ", "x" * 500 + " " + "1234 567", "<|endoftext|> end", "日本 語\n"]
    t = tokens()
    assert [x.tolist() for x in t.batch(*text_bytes(pa.array(texts)))] == [t.encode(x).tolist() for x in texts]


def test_examples_keep_all_limits(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(n), int(rng.integers(0, n + 1))) for i, n in enumerate(rng.integers(1, 900, 800))] + [(900, 5000, 1), (901, None, None)]
    limits = Limits(tokens=2048, segments=6, loss=900, least=0)
    counts = {i: (n or 0, m or 0) for i, n, m in rows}
    got = packed_examples(spark.createDataFrame(rows, "example_id long, n_tokens long, n_loss long").coalesce(1), limits).collect()
    assert sorted(r.example_id for r in got) == sorted(counts)
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append(counts[r.example_id])
    assert held.pop(None) == [(5000, 1)]
    for pieces in held.values():
        assert sum(n for n, _ in pieces) <= 2048 and len(pieces) <= 6 and sum(m for _, m in pieces) <= 900
    floor = max(sum(n for n, _ in counts.values()) / 2048, sum(m for _, m in counts.values() if m <= 900) / 900, len(counts) / 6)
    assert len(held) <= 1.15 * floor + 1


def test_warc_round_trip(spark):
    page, other = "<p>é" + "x" * 200, "small"
    rows = [(5, "http://a/b c\r\nX: y", page), (2, "http://a/2", page), (2, "http://a/2", page), (9, None, page), (None, "http://n", page), (3, "u", other), (4, "u", other), (6, "u", None), (7, "u", "")]
    folder, manifest = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = read_archives(spark, folder).collect()
    assert sorted(map(str, [(r[0], len((r[2] or "").encode())) for r in rows])) == sorted(str((r.page_id, r.payload_bytes)) for r in got)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert kinds == {(2, "response", None), (5, "revisit", 2), (9, "revisit", 2), (None, "revisit", 2), (3, "response", None), (4, "response", None), (6, "response", None), (7, "response", None)}
    assert all(bytes(r.payload) == page.encode() for r in got if r.page_id == 2) and manifest.count() > 0
    assert all(r.payload_digest == hashlib.sha256(page.encode()).hexdigest() for r in got if r.payload_bytes > 100)


def test_top_k_of_awkward_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [9.0]), (None, [1.0, 1.0]), (7, [-1.0, 0.0]), (8, [1.0, 0.5]), (9, [1.0, 0.5])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5).collect()
    score = 256 * 256 + 128 * 128
    assert [tuple(r) for r in sorted(got) if r.query_id == 0] == [(0, k + 1, v, score) for k, v in enumerate([1, 2, 2, 8, 9])]
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()


def test_top_k_of_empty_vectors(spark):
    rows = [(0, []), (3, []), (1, []), (50, [1.0]), (51, [2.0]), (100, [])]
    got = sorted(tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 2).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 3, 0), (50, 1, 51, 2 * 256 * 256), (100, 1, 0, 0), (100, 2, 1, 0)]


@pytest.mark.parametrize("name, label, least", [("op7_quality_classifier", "quality", 0.93), ("op5_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}
    labels = duckdb.sql(f"SELECT doc_id, {label} FROM '{folder}/labels.parquet'").fetchall()
    modulus, rest = (3, 1) if label == "quality" else (5, 0)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) >= least * len(held)


def test_scores_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 1), (8, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for scores in (quality_scores, toxicity_scores):
        for given in (labels, labels.limit(0)):
            rows = scores(awkward, given).collect()
            assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)


def test_folding():
    assert folded("1D10T") == "idiot" and folded("іdіоt") == "idiot" and folded("Ｍｏｒｏｎ") == "moron"
    assert folded("clown$$$ in 2024!") == "clown$$$ in 2024!" and folded("$cum sc​um") == "scum scum"


def test_licences_are_inherited_from_the_nearest_directory(spark):
    from pyspark.sql import functions as F

    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [("p/LICENSE", mit), ("p/a/b/x", "code " * 50), ("p/a/COPYING", apache), ("p/y", "code"), ("q/z", None), (None, ""), ("p/a/own", "code " * 50 + "\n" + mit)]
    got = {r.path: (r.effective, r.directory) for r in license_scan(spark.createDataFrame(rows, "path string, text string"), F.col("path")).collect()}
    assert got == {"p/LICENSE": ("MIT", None), "p/a/b/x": ("Apache-2.0", "p/a"), "p/a/COPYING": ("Apache-2.0", None), "p/y": ("MIT", "p"), "q/z": (None, None), None: (None, None), "p/a/own": ("MIT", None)}


@pytest.mark.parametrize("operator", [near_duplicates, byte_digests, dedup_substrings, packed_documents])
def test_empty_tables(awkward, operator):
    assert operator(awkward.limit(0)).isEmpty()


def test_pipeline_follows_its_stages(spark, folder):
    import corpus_pipeline

    pieces = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = {r.row.doc_id for r in corpus_pipeline.score_quality(docs, corpus_pipeline.fit_quality(
        docs, spark.read.parquet(f"{folder}/labels.parquet"), train=lambda c: corpus_pipeline.crc_bucket(c, 3) != 1)).collect() if r.score >= 0.5}
    texts = {i: t for i, t in table_docs(folder).items() if i in good}
    kept = {i for i, (_, root) in brute_components(texts).items() if i == root}
    con = oracle(folder)
    assert {r.doc_id for r in pieces} <= kept
    items = dict(con.sql("SELECT item_id, text FROM benchmark").fetchall())
    assert {i for i in kept if not brute_items(texts[i], items)} <= {r.doc_id for r in pieces}
