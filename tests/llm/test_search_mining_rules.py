"""Ranked lexical search, hard negatives and quality rules against brute force, SQL and awkward rows."""

import collections
import math
import re

import numpy as np
import pytest

from tests.compare import difference, spark_result, sql_result, type_difference
from tidemill.llm import lexical, negatives, rules
from tidemill.llm.queries import QUERIES, SQL

NEW = ("op11_ranked_lexical_search", "op12_hard_negatives", "op13_quality_rules")


@pytest.mark.parametrize("name", NEW)
def test_equals_sql(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    assert type_difference(df, con, SQL[name]) is None
    assert difference(spark_result(df), sql_result(con, SQL[name])) is None


# ---- ranked search --------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    counted = [(i, collections.Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c, n in counted:
            m = 75 + 25 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in plain_terms(text) if t in c
            )
            scored += [(-score, i is None, i or 0)] * (score > 0)
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(out)


DOCS = [
    (1, "Alpha beta, gamma!"), (2, "alpha ALPHA alpha"), (3, ""), (4, None), (5, "  \n\t ... "), (None, "alpha beta"), (6, "É été 東京 alpha\x7fbeta"),
    (7, "beta " * 3000 + "delta"), (8, "x" * 40_000), (9, "alpha beta"), (9, "alpha beta"), (9, "gamma delta"), (-4, "0 1 22 alpha_beta"),
]
ITEMS = [(1, "alpha beta beta"), (1, "alpha beta beta"), (1, "gamma"), (2, None), (3, "?!"), (4, "nothing here"), (None, "été DELTA delta 東京"), (5, "x" * 40_000)]


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def tables(spark, docs, items):
    docs = spark.createDataFrame([(i, t, None, 0.5, 7, "s") for i, t in docs], "doc_id long, text string, lang string, score double, item_id int, term string")
    return docs, spark.createDataFrame([(i, t, 1, "r") for i, t in items], "item_id long, text string, doc_id int, rank string")


@pytest.mark.parametrize("k", [2, 20])
def test_search_equals_brute_force(spark, k, monkeypatch):
    docs, items = tables(spark, DOCS, ITEMS)
    found = rows_of(lexical.ranked_search(docs.repartition(5), items, k).drop("item_digest"))
    assert found == brute_search(DOCS, ITEMS, k)
    # Items in many blocks, texts in small pieces and heaps cut often give the same.
    monkeypatch.setattr(lexical, "INDEX_BYTES", 20_000)
    monkeypatch.setattr(lexical, "CELLS", 8)
    assert rows_of(lexical.ranked_search(docs.repartition(3), items, k).drop("item_digest")) == found


def test_pieces_of_a_text_are_its_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 7)
    for text in ("", "a", " a  b ", "abcdefghijklmnop", "one two threefourfive six. Seven\neight", "東京 été x" * 9):
        assert [w.decode() for p in lexical.terms(text.encode()) for w in p] == plain_terms(text)


def test_search_without_rows(spark):
    docs, items = tables(spark, DOCS, ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id = 3"), items)):
        assert lexical.ranked_search(d, i).count() == 0


# ---- hard negatives -------------------------------------------------------

VECTORS = "id long, label int, vector array<double>, score double, dim string, anchor_id int"


def brute_negatives(data, every=50, positives=5, negatives_=3, scale=256):
    usable = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in data if None not in (i, lab, v) and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, lab, v in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lab, len(v), v)), (lab, len(v), v))
    out = []
    for a, (lab, n, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in usable if i != a and len(w) == n)
        for s, p, _ in [x for x in scored if x[2] == lab][:positives]:
            fit = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives_]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit, 1)]
    return collections.Counter(out)


def vectors(spark, data):
    return spark.createDataFrame([(*x, 0.5, "d", 3) for x in data], VECTORS)


@pytest.fixture(scope="module")
def random_vectors():
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 0.4, (4, 6))
    data = []
    for i in range(700):
        label = int(rng.integers(0, 4))
        data.append((i, label, [float(x) for x in (centre[label] + rng.normal(0, 0.3, 6)).round(int(rng.integers(0, 4)))]))
    # Repeated rows, ids with several rows, ties and rows that take no part.
    data += data[:60] + [(100, 1, data[0][2]), (150, 2, data[3][2]), (300, 0, [0.0] * 6), (None, 1, data[1][2]), (701, None, data[2][2])]
    data += [(702, 1, None), (703, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (704, 1, [float("nan")] * 6), (705, 1, [float("inf")] * 6), (750, 1, [])]
    return data + [(751, 1, []), (752, 2, []), (800, 3, [1.0, 2.0]), (801, 3, [1.0, 2.0]), (802, 1, [0.9, 1.2])]


@pytest.mark.parametrize("tree, block, passes", [(1024, 2048, 32 << 20), (3, 16, 5000)])
def test_negatives_equal_brute_force(spark, random_vectors, monkeypatch, tree, block, passes):
    for name, value in (("TREE", tree), ("BLOCK", block), ("PASS_BYTES", passes)):
        monkeypatch.setattr(negatives, name, value)
    found = rows_of(negatives.hard_negatives(vectors(spark, random_vectors).repartition(4)))
    assert found == brute_negatives(random_vectors) and sum(found.values()) > 100


def test_negatives_of_long_vectors_are_exact(spark):
    big = float(2**30)
    data = [(0, 0, [big, 1.0]), (1, 0, [2.0**10, 3.0]), (2, 1, [2.0**9 + 1, 7.0]), (3, 1, [2.0**9 + 1, 8.0]), (4, 1, [1.0, 1.0])]
    assert rows_of(negatives.hard_negatives(vectors(spark, data))) == brute_negatives(data)
    with pytest.raises(Exception, match="Overflow|overflow|too (big|large)"):
        negatives.hard_negatives(vectors(spark, [(0, 0, [big * big]), (1, 0, [big * big])])).collect()


def test_negatives_without_rows(spark, random_vectors):
    for data in ([], [(0, 0, [1.0]), (1, 1, [1.0])], [(0, 0, [1.0]), (1, 0, [-1.0]), (2, 1, [1.0])]):
        assert negatives.hard_negatives(vectors(spark, data)).count() == 0


def test_bounds_spare_scores():
    rng = np.random.default_rng(1)
    anchors = np.floor(rng.normal(0, 1, (50, 8)) + 200 * np.arange(50)[:, None] // 10)
    order, parent, edge = negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(50)) and parent[0] == -1 and (parent[1:] < np.arange(1, 50)).all()
    assert np.allclose(edge[1:], np.sqrt(((anchors[order][1:] - anchors[order][parent[1:]]) ** 2).sum(1)))
    tree = negatives.Tree({
        "label": 0, "dim": 8, "ids": np.arange(50).tobytes(), "matrix": anchors[order].tobytes(), "parent": parent.astype(np.int64).tobytes(), "edge": edge.tobytes(),
    })
    x = np.floor(rng.normal(0, 50, (400, 8)))
    least, scored, right = 60_000, 0, 0

    def found(i, need, scores):
        nonlocal scored, right
        scored += len(need)
        right += (scores >= least).sum()

    tree.walk(x, lambda i: (least, np.inf), found)
    assert right == (x @ anchors.T >= least).sum() > 0 and scored < x.shape[0] * 50 * 0.8


# ---- quality rules --------------------------------------------------------

def plain_statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    three = collections.defaultdict(list)
    for i in range(len(w) - 2):
        three[tuple(w[i:i + 3])].append(i)
    covered = {i + j for at in three.values() if len(at) > 1 for i in at for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


AWKWARD = [
    None, "", " \n\t\x0b\r", "a", "a b", "a b c", "a a a a", "a a a a a", "x y z x y z", "x y z q x y z x", "A b c a b c",
    "l\nl\n l\nl \n\n\n \n \nl", "# * $ % & | < > #a", "é 東京 é 東京 é 東京", "no break no break wide", "w " * 60, " ".join(map(str, range(49))), " ".join(map(str, range(50))),
    " ".join(map(str, range(30_000))) + "\n" + " ".join(map(str, range(7))), "y" * 50_000, "a\rb\rc\x0ca\rb\rc", "same line\n" * 400,
]


def test_statistics_of_awkward_texts(spark):
    schema = "n int, text string, lang string, source string, kept string, g int, row string, bin int, n_words string"
    docs = spark.createDataFrame([(i, t, None, None, "k", 1, "r", 2, "w") for i, t in enumerate(AWKWARD)], schema)
    for r in rules.with_statistics(docs).collect():
        assert tuple(r[c] for c in rules.STATISTICS) == plain_statistics(AWKWARD[r["n"]]), AWKWARD[r["n"]]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert rules.judged(rules.with_statistics(docs)).count() == len(AWKWARD)


def brute_outliers(stats, groups):
    """Squared distances from a plain concentration per group of distinct vectors."""
    unit = rules.UNIT
    vector = lambda s: tuple(math.floor(v * unit + 0.5) for v in (
        math.log(1 + s[0]), math.log(s[1] / s[0]), math.sqrt(s[2] / s[1]), math.sqrt(s[4] / s[3]), math.sqrt(s[5] / s[0])))
    rows = [(g, vector(s)) for g, s in zip(groups, stats)]
    floors = np.diag([(f * unit) ** 2 for _, f in rules.VECTOR.values()])
    fits = {}
    for g in set(groups):
        x = np.array(sorted({v for h, v in rows if h == g}), float)
        at = lambda q: np.sort(x, 0)[-(-len(x) * q // 4) - 1]
        m, c = at(2), np.maximum(np.diag(((at(3) - at(1)) / 1.349) ** 2), floors)
        for _ in range(rules.MAX_STEPS):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            bins = np.floor(np.sqrt(np.sqrt(d)) * 4096)
            inner = x[bins <= np.sort(bins)[-(-len(x) * 3 // 4) - 1]]
            m, c = inner.mean(0), np.cov(inner.T, bias=True) * rules.FACTOR + floors
        fits[g] = m, np.linalg.inv(c)
    return [float((np.array(v) - fits[g][0]) @ fits[g][1] @ (np.array(v) - fits[g][0])) for g, v in rows]


def test_outliers_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    texts, keys = [], []
    for i in range(900):
        words = [f"w{x}" for x in rng.integers(0, 3000, int(rng.integers(60, 400)))]
        if i % 19 == 0:
            words = [w + "$%" * int(rng.integers(1, 4)) for w in words]
        if i % 23 == 0:
            words = words[:30] + words[:12]  * 2 + words[30:]
        texts.append("\n".join(" ".join(words[j:j + 40]) for j in range(0, len(words), 40)))
        # Two large groups, small ones of a language that are judged together, and small ones of several.
        keys.append([("a", "x"), ("a", "x"), (None, None), ("b", f"s{i % 7}"), ("b", f"s{i % 7}"), ("c" + str(i % 5), "t"), (None, None), ("a", "x"), ("a", "z")][i % 9])
    docs = spark.createDataFrame([(i, t, *k) for i, (t, k) in enumerate(zip(texts, keys))], "doc_id long, text string, lang string, source string")
    # A third of all rows is one text: copies count once.
    docs = docs.union(spark.range(400).selectExpr("id + 5000", f"'{texts[1]}'", "'a'", "'x'"))
    got = {r.row.doc_id: r for r in rules.judged(rules.with_statistics(docs).drop("text"), least=80).collect()}
    # (a, z) has 100 rows, so it is a group; languages c0.. have too few together with none else, so all of them are judged as one.
    groups = [k if k in {("a", "x"), (None, None), ("a", "z")} else "b" if k[0] == "b" else "rest" for k in keys]
    want = brute_outliers([plain_statistics(t) for t in texts], groups)
    for i, d in enumerate(want):
        assert got[i].distance == pytest.approx(d, rel=1e-6)
        assert got[i].kept == (d <= rules.LIMIT)
    assert got[5000].kept == got[1].kept
    assert sum(d > rules.LIMIT for d in want) >= 40
    assert np.mean([got[i].kept for i in range(900) if i % 19 and i % 23]) > 0.97


def test_few_rows_are_kept_and_none_is_fine(spark):
    schema = "doc_id long, text string, lang string, source string, distance int, d2 int"
    docs = spark.createDataFrame([(i, " ".join(f"w{x * (i + 1)}" for x in range(60)), "en", None, 1, 2) for i in range(5)] + [(None, None, None, "s", 1, 2)], schema)
    got = rules.quality_rules(docs).collect()
    assert sorted(r.kept for r in got) == [False] + [True] * 5
    assert rules.quality_rules(docs.limit(0)).collect() == []


def test_rules_use_no_python_workers(spark, folder):
    plan = rules.quality_rules(spark.read.parquet(f"{folder}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_limits_of_the_chi_squared_distribution():
    assert rules.chi2_limit(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert rules.chi2_limit(0.5, 4) == pytest.approx(3.3567, abs=1e-3)
    assert rules.LIMIT == pytest.approx(25.745, abs=1e-2)
