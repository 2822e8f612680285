"""Quality rules: base limits, then robust multivariate outliers among documents of one language and source.

Native expressions only. The formulas of the estimate are kept as SQL text, which both Spark and the SQL twin read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import bind
from tidemill.llm.shared import dropped, stored
from tidemill.plans.sizing import hint_if_small, is_small, join_on

#: Base limits: words at least, percent of words in repeated windows at most.
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS, SEPARATORS = "#*$%&|<>", " \t\n\x0b\f\r"
#: Groups with fewer distinct vectors are judged with their language's other small groups, then all together.
MIN_GROUP = 200
#: Share of the vectors that the estimate is made from, as numerator and denominator.
KEPT, OF = 3, 4
#: Rounds of concentration at most.
MAX_STEPS = 12
#: Chance that a document of a normal group lies beyond the limit.
OUTSIDE = 1e-4
UNIT = 1024
#: The transformed statistics in units of 1/1024, and the standard deviation that each has at least (in the plain unit):
#: less is no evidence, and a statistic that is constant in most documents must not make the rest outliers.
VECTOR = {
    "x1": ("ln(1 + n_words)", 0.25),
    "x2": ("ln(word_chars / CAST(n_words AS DOUBLE))", 0.05),
    "x3": ("sqrt(n_symbols / CAST(word_chars AS DOUBLE))", 0.05),
    "x4": ("sqrt(n_dup_lines / CAST(n_lines AS DOUBLE))", 0.1),
    "x5": ("sqrt(n_repeat_words / CAST(n_words AS DOUBLE))", 0.1),
}
X = list(VECTOR)
P = len(X)
PAIRS = [(i, j) for i in range(1, P + 1) for j in range(1, i + 1)]
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def chi2_share(x: float, degrees: int) -> float:
    """Share of the chi-squared distribution below ``x``."""
    share, k = (math.erf(math.sqrt(x / 2)), 1) if degrees % 2 else (1 - math.exp(-x / 2), 2)
    while k < degrees:
        share -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
        k += 2
    return share


def chi2_limit(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, degrees) < share else (low, mid)
    return high


#: The spread of the inner part of a normal distribution is too small by this factor.
FACTOR = KEPT / OF / chi2_share(chi2_limit(KEPT / OF, P), P + 2)
LIMIT = chi2_limit(1 - OUTSIDE, P)


def _vector_sql(name: str) -> str:
    return f"CAST(floor({VECTOR[name][0]} * {UNIT} + CAST(0.5 AS DOUBLE)) AS BIGINT) AS {name}"


def _floor(i: int) -> float:
    return (VECTOR[f"x{i}"][1] * UNIT) ** 2


#: Start from medians and quartile ranges: centre m1.., covariance c11...
START = [f"CAST(q2_{i} AS DOUBLE) AS m{i}" for i in range(1, P + 1)] + [
    (f"greatest(CAST({_floor(i)!r} AS DOUBLE), pow((q3_{i} - q1_{i}) / CAST(1.349 AS DOUBLE), 2))" if i == j else "CAST(0 AS DOUBLE)") + f" AS c{i}{j}"
    for i, j in PAIRS
]
#: From exact integer sums of the inner part. Doubles are written as casts, else they are decimals.
MOMENTS = [f"CAST(s{i} AS DOUBLE) / n AS m{i}" for i in range(1, P + 1)] + [
    f"CAST(n * s{i}{j} - s{i} * s{j} AS DOUBLE) / CAST(n AS DOUBLE) / CAST(n AS DOUBLE) * CAST({FACTOR!r} AS DOUBLE)"
    + (f" + CAST({_floor(i)!r} AS DOUBLE)" if i == j else "") + f" AS c{i}{j}" for i, j in PAIRS
]


def _cholesky() -> list[str]:
    out = []
    for i, j in PAIRS:
        rest = f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(1, j))
        out.append((f"sqrt({rest})" if i == j else f"({rest}) / l{j}{j}") + f" AS l{i}{j}")
    return sorted(out, key=lambda e: (e[-1], e[-2]))


#: Lower triangle of the covariance's root, column by column; each line uses those above it.
ROOT = _cholesky()
#: The vector less its centre, made spherical, and its squared length.
DISTANCE = [
    f"(x{i} - m{i}" + "".join(f" - l{i}{k} * z{k}" for k in range(1, i)) + f") / l{i}{i} AS z{i}" for i in range(1, P + 1)
] + [" + ".join(f"z{i} * z{i}" for i in range(1, P + 1)) + " AS d2"]
#: Distances in steps of about a thousandth, by roots, which are exact alike everywhere.
BIN = "CAST(least(floor(sqrt(sqrt(d2)) * 4096), CAST(1e9 AS DOUBLE)) AS BIGINT) AS bin"
PARAMETERS = [f"m{i}" for i in range(1, P + 1)] + [f"l{i}{j}" for i, j in PAIRS]


def _words(text: Column) -> Column:
    plain = F.translate(text, SEPARATORS, " " * len(SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur more than once: windows sorted, so equal ones are neighbours."""

    def windows(w: Column) -> Column:
        n = F.size(w) - 2
        return F.arrays_zip(F.slice(w, 1, n).alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c"), F.sequence(F.lit(1), n).alias("at"))

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def repeated(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)))
        return F.sort_array(F.transform(twin, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda n, x: n + x)

    many = F.when(F.size(words) > 3, words)
    return F.coalesce(bind(many, lambda w: bind(F.sort_array(windows(w)), lambda s: bind(repeated(s), covered))), F.lit(0).cast("long"))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``STATISTICS`` and ``base_failed`` (user columns of these names are replaced).

    Words are split at ASCII white space. A null or empty text has none and fails. Memory of a task follows its
    longest text; nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SEPARATORS, "") != "")
    words = bind(_words(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    rows = bind(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    chars = F.length(F.translate(body, SEPARATORS, "")).cast("long")
    symbols = (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long")
    out = docs.withColumns({"__words": words, "__lines": rows, "word_chars": chars, "n_symbols": symbols})
    out = out.withColumns({
        "n_words": F.col("__words.n_words"), "n_repeat_words": F.col("__words.n_repeat_words"),
        "n_lines": F.col("__lines.n_lines"), "n_dup_lines": F.col("__lines.n_dup_lines"),
    }).drop("__words", "__lines")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def _groups(vectors: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """(keys, g): the group that rows of these keys are judged in; null if even all small groups together are too few."""
    first, *rest = keys
    n = vectors.groupBy(*keys).agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < least, F.col("n"))
    by_first = n.groupBy(first).agg(F.sum(small).alias("n_first"))
    sized = join_on(n, by_first, [first])
    few = n.groupBy(first).agg(F.sum(small).alias("n_first")).agg(F.sum(F.when(F.col("n_first") < least, F.col("n_first"))).alias("n_all"))
    named = lambda level, *c: F.struct(F.lit(level).alias("level"), *(x.alias(f"k{i}") for i, x in enumerate(c)))
    none = [F.lit(None).cast(vectors.schema[k].dataType) for k in keys]
    g = (
        F.when(F.col("n") >= least, named(1, *(F.col(k) for k in keys)))
        .when(F.col("n_first") >= least, named(2, F.col(first), *none[1:]))
        .when(F.col("n_all") >= least, named(3, *none))
    )
    return sized.withColumn("n_all", few.scalar()).select(*keys, g.alias("g"))


def _start(vectors: DataFrame) -> DataFrame:
    """Medians and quartiles of every coordinate, from counts of its values."""
    long = vectors.select("g", F.inline(F.array(*[F.struct(F.lit(i + 1).alias("c"), F.col(x).alias("v")) for i, x in enumerate(X)])))
    counts = long.groupBy("g", "c", "v").agg(F.count("*").alias("n"))
    part = Window.partitionBy("g", "c")
    reached = counts.withColumns({"upto": F.sum("n").over(part.orderBy("v")), "all": F.sum("n").over(part)})
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("v")))
    quartiles = reached.groupBy("g", "c").agg(*(at(q).alias(f"q{q}") for q in (1, 2, 3)))
    wide = [F.max(F.when(F.col("c") == i, F.col(f"q{q}"))).alias(f"q{q}_{i}") for q in (1, 2, 3) for i in range(1, P + 1)]
    return quartiles.groupBy("g").agg(*wide).selectExpr("g", *START)


def _rooted(moments: DataFrame) -> DataFrame:
    return moments.selectExpr("*", *ROOT).select("g", *PARAMETERS)


def _distances(vectors: DataFrame, parameters: DataFrame) -> DataFrame:
    """``d2`` of every vector, by the parameters of its group."""
    return vectors.join(parameters, "g").selectExpr(*vectors.columns, *DISTANCE).select(*vectors.columns, "d2")


def fit_outliers(vectors: DataFrame) -> DataFrame:
    """Minimum covariance determinant of every group ``g`` of the integer vectors ``x1..``: its ``PARAMETERS``.

    From medians and quartile ranges on, the three quarters of a group that are nearest to the centre give the next
    centre and covariance, until no group moves or ``MAX_STEPS`` are done. The border of the nearest is found by
    counting distances in narrow bins (all of the border's bin count), so no group is sorted or held by one task; sums
    are exact integers, so the result does not hang on the order of rows.
    """
    parameters = stored(_rooted(_start(vectors)), "rules")
    # One row a group: counted, and sent to all tasks if there are few; else a shuffle join, whose hot groups Spark splits.
    small = F.broadcast if is_small(parameters) else lambda table: table
    for _ in range(MAX_STEPS):
        near = _distances(vectors, small(parameters)).selectExpr("*", BIN)
        counts = near.groupBy("g", "bin").agg(F.count("*").alias("n"))
        part = Window.partitionBy("g")
        reached = counts.withColumns({"upto": F.sum("n").over(part.orderBy("bin")), "all": F.sum("n").over(part)})
        border = reached.where(F.col("upto") * OF >= F.col("all") * KEPT).groupBy("g").agg(F.min("bin").alias("border"))
        inner = near.join(small(border), "g").where("bin <= border")
        whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")) if isinstance(c, str) else F.sum(c.cast("decimal(38,0)"))
        sums = inner.groupBy("g").agg(
            F.count("*").cast("decimal(38,0)").alias("n"), *(whole(f"x{i}").alias(f"s{i}") for i in range(1, P + 1)),
            *(whole(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS),
        )
        after = stored(_rooted(sums.selectExpr("g", *MOMENTS)), "rules")
        still = parameters.exceptAll(after).isEmpty()
        dropped(parameters)
        parameters = after
        if still:
            break
    return parameters


def vectors_of(statistics: DataFrame) -> DataFrame:
    return statistics.selectExpr("*", *(_vector_sql(x) for x in X))


def judged(statistics: DataFrame, keys: Sequence[str] = ("lang", "source"), least: int = MIN_GROUP) -> DataFrame:
    """Rows of ``with_statistics`` with ``distance`` (squared, null where none was taken) and ``kept``.

    Estimates come from the distinct vectors of the documents that pass the base limits, per ``keys``; so copies count
    once, however many. Nulls are keys like any other. Groups with fewer than ``least`` distinct vectors are judged
    with the other small ones of their first key, then all together; if those are fewer too, all are kept. Base
    failures are never kept and never estimated from. The rows must be stored: they are read once a round.
    """
    keys = list(keys)
    passed = vectors_of(statistics.where(~F.col("base_failed")).select(*keys, *STATISTICS)).select(*keys, *X)
    distinct = stored(passed.distinct(), "vectors")
    groups = stored(_groups(distinct, keys, least), "groups")
    sample = stored(join_on(distinct, hint_if_small(groups), keys).where("g IS NOT NULL").select("g", *X), "sample")
    parameters = fit_outliers(sample)
    limits = hint_if_small(stored(join_on(groups, parameters, ["g"]).drop("g"), "limits"))
    columns = statistics.columns
    held = statistics.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), *keys, *STATISTICS, "base_failed")
    named = vectors_of(held.where(~F.col("base_failed"))).unionByName(held.where("base_failed").withColumns({x: F.lit(None).cast("long") for x in X}))
    out = join_on(named, limits, keys, "left").selectExpr("row", "base_failed", *DISTANCE)
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= LIMIT, F.lit(True))
    return out.select("row", F.when(~F.col("base_failed"), F.col("d2")).alias("distance"), kept.alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``distance`` and ``kept`` of every row of ``docs``.

    The texts are read once; what is stored and read again are the statistics. Rows count on their own, whatever their
    id; null texts are empty; other columns are ignored. Empty table: no rows.
    """
    narrow = docs.select("doc_id", "lang", "source", "text")
    statistics = stored(with_statistics(narrow).drop("text"), "statistics")
    return judged(statistics).select(
        "row.doc_id", *(f"row.{c}" for c in STATISTICS if c != "n_lines"), "row.base_failed", "kept",
    )


def _sql() -> str:
    cross = [f"CAST(sum(x{i} * x{j}) AS HUGEINT) AS s{i}{j}" for i, j in PAIRS]
    lines = [r"""WITH parts AS (SELECT row_number() OVER () AS place, doc_id, lang, source, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)),
    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents)""",
        """windows AS (SELECT place, unnest(range(1, len(w) - 1)) AS spot, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS three FROM parts)""",
        """twice AS (SELECT place, spot FROM windows QUALIFY count(*) OVER (PARTITION BY place, three) > 1)""",
        """covered AS (SELECT place, count(DISTINCT spot + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY place)""",
        f"""stats AS (SELECT p.place, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM parts p LEFT JOIN covered c USING (place))""",
        f"vectors AS MATERIALIZED (SELECT place, lang, source, {', '.join(_vector_sql(x) for x in X)} FROM stats WHERE NOT base_failed)",
        f"distincts AS (SELECT DISTINCT lang, source, {', '.join(X)} FROM vectors)",
        "n1 AS (SELECT lang, source, count(*) AS n FROM distincts GROUP BY ALL)",
        f"n2 AS (SELECT lang, sum(n) FILTER (n < {MIN_GROUP}) AS n_first FROM n1 GROUP BY lang)",
        f"n3 AS (SELECT sum(n_first) FILTER (n_first < {MIN_GROUP}) AS n_all FROM n2)",
        f"""groups AS MATERIALIZED (SELECT n1.lang, n1.source, CASE WHEN n >= {MIN_GROUP} THEN {{'level': 1, 'a': n1.lang, 'b': n1.source}}
  WHEN n_first >= {MIN_GROUP} THEN {{'level': 2, 'a': n1.lang, 'b': NULL}} WHEN n_all >= {MIN_GROUP} THEN {{'level': 3, 'a': NULL, 'b': NULL}} END AS g
  FROM n1 JOIN n2 ON n1.lang IS NOT DISTINCT FROM n2.lang, n3)""",
        f"""sample AS MATERIALIZED (SELECT g, {', '.join(X)} FROM distincts d JOIN groups k
  ON d.lang IS NOT DISTINCT FROM k.lang AND d.source IS NOT DISTINCT FROM k.source WHERE g IS NOT NULL)""",
        "long AS (" + " UNION ALL ".join(f"SELECT g, {i} AS c, x{i} AS v FROM sample" for i in range(1, P + 1)) + ")",
        """quartiles AS (SELECT g, c, min(v) FILTER (upto * 4 >= total) AS q1, min(v) FILTER (upto * 4 >= total * 2) AS q2, min(v) FILTER (upto * 4 >= total * 3) AS q3
  FROM (SELECT g, c, v, sum(n) OVER (PARTITION BY g, c ORDER BY v) AS upto, sum(n) OVER (PARTITION BY g, c) AS total
    FROM (SELECT g, c, v, count(*) AS n FROM long GROUP BY ALL)) GROUP BY g, c)""",
        "spread AS (SELECT g, " + ", ".join(f"max(q{q}) FILTER (c = {i}) AS q{q}_{i}" for q in (1, 2, 3) for i in range(1, P + 1)) + " FROM quartiles GROUP BY g)",
        f"fit0 AS MATERIALIZED (SELECT *, {', '.join(ROOT)} FROM (SELECT g, {', '.join(START)} FROM spread))",
    ]
    for step in range(1, MAX_STEPS + 1):
        lines += [
            f"near{step} AS MATERIALIZED (SELECT *, {BIN} FROM (SELECT s.*, {', '.join(DISTANCE)} FROM sample s JOIN fit{step - 1} USING (g)))",
            f"""border{step} AS (SELECT g, min(bin) AS border FROM (SELECT g, bin, sum(count(*)) OVER (PARTITION BY g ORDER BY bin) AS upto,
  sum(count(*)) OVER (PARTITION BY g) AS total FROM near{step} GROUP BY g, bin) WHERE upto * {OF} >= total * {KEPT} GROUP BY g)""",
            f"""fit{step} AS MATERIALIZED (SELECT *, {', '.join(ROOT)} FROM (SELECT g, {', '.join(MOMENTS)} FROM (SELECT g, CAST(count(*) AS HUGEINT) AS n,
  {', '.join(f'CAST(sum(x{i}) AS HUGEINT) AS s{i}' for i in range(1, P + 1))}, {', '.join(cross)}
  FROM near{step} JOIN border{step} USING (g) WHERE bin <= border GROUP BY g)))""",
        ]
    lines.append(f"""verdicts AS (SELECT place, d2 <= CAST({LIMIT!r} AS DOUBLE) AS inside FROM (SELECT place, {', '.join(DISTANCE)}
  FROM vectors v JOIN groups k ON v.lang IS NOT DISTINCT FROM k.lang AND v.source IS NOT DISTINCT FROM k.source JOIN fit{MAX_STEPS} USING (g)))""")
    return ",\n".join(lines) + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, TRUE) AS kept
FROM stats LEFT JOIN verdicts USING (place)"""


#: The same over a view ``documents``; all ``MAX_STEPS`` are written out (a group that stands still stays so).
SQL = _sql()
