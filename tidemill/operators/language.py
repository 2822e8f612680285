"""Language labels from character trigram profiles.

A profile is fitted on labelled texts: every trigram of each language with its
smoothed log-probability.  Texts are labelled by the language under which their
trigrams are most likely.  Texts mostly in Japanese or Chinese letters are told by
their script.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import bind
from tidemill.functions.wording import UNDETERMINED
from tidemill.plans.sizing import broadcast_if_small, dealt_if_small, hint_if_small, is_small, join_on, materialize

KANA = r"[\x{3040}-\x{30ff}]"
# Rows of a profile that every task may hold, and the share below which a trigram is rare enough for one task.
PROFILE_ROWS = 500_000
COMMON = 10_000
DENSE_LANGUAGES = 32
HAN = r"[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]"


def script_label(text: Column) -> Column:
    """ja or zh if more than half of the letters are kana or Han; Japanese if a tenth of those are kana.

    These letters take two bytes more than characters each, so most texts need no regex at all.
    """
    n = lambda pattern: F.regexp_count(text, F.lit(pattern))
    kind = lambda east: F.when(
        (east > 0) & (east * 2 > n(r"\p{L}")), F.when(n(KANA) * 10 >= east, "ja").otherwise("zh")
    )
    return F.when(F.octet_length(text) - F.length(text) >= 2, bind(n(f"{KANA}|{HAN}"), kind))


def trigrams(text: Column) -> Column:
    """All overlapping trigrams of the whole, lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), 1)


def gram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n); counts are combined before the shuffle."""
    texts = dealt_if_small(labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    grams = texts.select("lang", F.explode(trigrams(F.col("text"))).alias("gram"))
    return grams.groupBy("lang", "gram").agg(F.count("*").alias("n"))


def language_profile(counts: DataFrame) -> DataFrame:
    """(lang, gram, n, log_p, log_floor) of every trigram of each language; the counts are stored, so texts are read once.

    ``log_floor`` is the add-one smoothed log-probability of any other trigram.
    """
    counts = materialize(counts)
    totals = counts.groupBy("lang").agg((F.sum("n") + F.count("*")).alias("__total"))
    out = join_on(counts, broadcast_if_small(totals), ["lang"])
    return out.select(
        "lang", "gram", "n", F.log((F.col("n") + 1) / F.col("__total")).alias("log_p"),
        F.log(F.lit(1.0) / F.col("__total")).alias("log_floor"),
    )


def _with_gains(grams: DataFrame, table: DataFrame, gains: Sequence[str], keys: Sequence[str], limit: int) -> DataFrame:
    """Left join of ``grams`` with the ``gains`` of their trigram, and the count ``c`` of equal trigrams of a text.

    A table of few enough rows and bytes goes to every task; nothing is shuffled then. Otherwise trigrams with more
    than one in ``COMMON`` of all occurrences, which cannot be more than ``COMMON``, go to every task, and the rest
    meets its trigrams in a shuffle join, where the rows served already are dealt evenly by a salted key.
    """
    if is_small(table, limit):
        return grams.withColumn("c", F.lit(1)).join(F.broadcast(table.select("gram", *gains)), "gram", "left")
    total = table.agg(F.sum("n")).first()[0]
    common = table.where(F.col("n") * COMMON > total).select("gram", F.lit(True).alias("__served"), *gains)
    rare = table.where(F.col("n") * COMMON <= total).select(F.col("gram").alias("__key"), *(F.col(g).alias(f"__r{g}") for g in gains))
    counted = grams.groupBy(*grams.columns).agg(F.count("*").alias("c")).join(F.broadcast(common), "gram", "left")
    salt = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*keys, "gram"), F.lit(COMMON)).cast("string"))
    keyed = counted.withColumn("__salted", F.when(F.col("__served").isNull(), F.col("gram")).otherwise(salt))
    met = keyed.join(rare, F.col("__salted") == F.col("__key"), "left")
    return met.withColumns({g: F.coalesce(g, f"__r{g}") for g in gains}).drop("__served", "__salted", "__key", *(f"__r{g}" for g in gains))


def label_language(
    df: DataFrame,
    profile: DataFrame,
    id_columns: Sequence[str],
    text: str = "text",
    label: str = "label",
    limit: int = PROFILE_ROWS,
    dense: int = DENSE_LANGUAGES,
) -> DataFrame:
    """(id_columns, label) of every text; the id columns must be unique.

    The profile is evaluated once and stored with one row per trigram: its gains over the floor, by language. Texts
    are read once too: their trigrams meet the profile where they are made, and the gains are summed per text and
    language before anything is shuffled. Up to ``dense`` languages are columns, more are rows. A language that shares
    no trigram with a text can only win by its floor, so the one with the highest floor stands for all of those.
    """
    ids = list(id_columns)
    profile = materialize(profile)
    floors = materialize(profile.groupBy("lang").agg(F.min("log_floor").alias("floor")))
    texts = dealt_if_small(df.select(*ids, F.col(text).alias("__text")))
    made = texts.select(*ids, script_label(F.col("__text")).alias("__script"), trigrams(F.col("__text")).alias("__grams"))
    # A text without trigrams keeps a row.
    grams = made.select(*ids, "__script", F.size("__grams").alias("__size"), F.explode_outer("__grams").alias("gram"))
    known = floors.orderBy("lang").limit(dense + 1).collect()
    guesses = _dense if len(known) <= dense else _sparse
    won = guesses(grams, profile, floors, known, [*ids, "__script", "__size"], limit)
    guess = F.when(F.col("__size") > 0, F.col("__guess"))
    return won.select(*ids, F.coalesce("__script", guess, F.lit(UNDETERMINED)).alias(label))


def _gain() -> Column:
    return F.col("log_p") - F.col("log_floor")


def _dense(grams, profile, floors, known, keys, limit):
    """Few languages: one column of gains for each, one aggregate."""
    names = [f"__g{i}" for i in range(len(known))]
    mine = [F.sum(F.when(F.col("lang").eqNullSafe(F.lit(r["lang"])), _gain())).alias(g) for g, r in zip(names, known)]
    table = materialize(profile.groupBy("gram").agg(F.sum("n").alias("n"), *mine))
    gains = _with_gains(grams, table, names, keys, limit)
    sums = gains.groupBy(*keys).agg(*(F.sum(F.col("c") * F.col(g)).alias(g) for g in names))
    cost = lambda g, r: -(F.coalesce(g, F.lit(0.0)) + F.col("__size") * F.lit(r["floor"]))
    costs = [F.struct(cost(g, r).alias("cost"), F.lit(r["lang"]).cast("string").alias("lang")) for g, r in zip(names, known)]
    # Lowest cost, then first in code order.
    guess = F.array_min(F.array(*costs))["lang"] if costs else F.lit(None).cast("string")
    return sums.select(*keys, guess.alias("__guess"))


def _sparse(grams, profile, floors, known, keys, limit):
    """Many languages: the gains of a trigram are an array, and languages are rows until the last aggregate."""
    gain = F.struct(F.col("lang").alias("__lang"), _gain().alias("gain"))
    table = materialize(profile.groupBy("gram").agg(F.sum("n").alias("n"), F.collect_list(gain).alias("gains")))
    best = floors.orderBy(F.desc("floor"), "lang").first()
    gains = _with_gains(grams, table, ["gains"], keys, limit)
    scores = gains.select(*keys, "c", F.inline_outer("gains")).groupBy(*keys, "__lang").agg(
        F.sum(F.col("c") * F.col("gain")).alias("gain")
    )
    scores = join_on(scores, hint_if_small(floors.withColumnRenamed("lang", "__lang")), ["__lang"], "left")
    cost = -(F.col("gain") + F.col("__size") * F.col("floor"))
    # Rows without a gain are texts that met no trigram of any language.
    met = F.min(F.when(F.col("gain").isNotNull(), F.struct(cost.alias("cost"), F.col("__lang").alias("lang"))))
    unmet = F.struct((F.col("__size") * F.lit(-best["floor"])).alias("cost"), F.lit(best["lang"]).alias("lang"))
    won = scores.groupBy(*keys).agg(met.alias("__met"))
    return won.select(*keys, F.least(F.coalesce("__met", unmet), unmet)["lang"].alias("__guess"))
