"""Completions table: parsed columns, rewards and advantages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import parsing as parse
from tidemill.functions import rewards as rw
from tidemill.functions import wording as w
from tidemill.functions.exact import cut, joined
from tidemill.functions.text import count_of
from tidemill.plans.sizing import PLAIN_LIMIT, broadcast_if_small, join_on, largest_group

# Generations of one sample that are scored together in one task.
GROUP_ROWS = 1024


def normalize_content(df: DataFrame, column: str = "content") -> DataFrame:
    """Message lists, single messages and plain values all become one text column."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        text = parse.message_content(F.col(column))
    elif isinstance(kind, T.StructType):
        text = F.coalesce(F.col(column)["content"], F.lit(""))
    else:
        text = parse.plain_content(F.col(column))
    return df.withColumn(column, text)


def parse_completions(
    df: DataFrame,
    content: str = "content",
    horizon: int = 96,
    header_min: int = 90,
    list_min: int = 90,
    list_max: int = 100,
    preview_chars: int = 500,
) -> DataFrame:
    """Add point values, forecast sequence, format flags, text statistics and preview."""
    text = F.col(content)
    return df.withColumns(
        {
            "first_value": parse.first_value(text),
            "last_value": parse.last_value(text),
            "sequence": parse.forecast_sequence(text, horizon, header_min, list_min, list_max),
            "has_think_tags": parse.has_think_tags(text),
            "has_result_header": parse.has_result_header(text),
            "n_chars": F.length(text),
            "n_commas": F.regexp_count(text, F.lit(",")),
            "response_preview": parse.preview(text, preview_chars),
        }
    )


def text_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_chars`` and ``<column>_commas`` for each text column."""
    stats = {}
    for c in columns:
        stats[f"{c}_chars"] = F.length(c)
        stats[f"{c}_commas"] = F.regexp_count(F.col(c), F.lit(","))
    return df.withColumns(stats)


def parse_report(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts and shares of parsed sequences and format flags."""
    share = lambda flag: F.avg(flag.cast("double"))
    ok = F.size("sequence") > 0
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("n_total"),
        F.count_if(ok).alias("n_valid"),
        share(ok).alias("success_rate"),
        share(F.col("has_think_tags")).alias("think_rate"),
        share(F.col("has_result_header")).alias("header_rate"),
    )


def join_truth(
    completions: DataFrame,
    samples: DataFrame,
    on: str = "sample_id",
    generation: str = "generation_id",
    columns: Sequence[str] = ("true_value",),
    limit: int = PLAIN_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """Left join of completions to one row per sample; a sample with several rows is an error.

    If some sample has more than ``limit`` completions, they are spread over blocks
    of consecutive generations and the sample is copied to each of its blocks.
    ``largest`` is the size of the largest sample if it is known.
    """
    once = samples.groupBy(on).agg(F.count("*").alias("__rows"), *[F.first(c).alias(c) for c in columns])
    several = F.raise_error(F.concat(F.lit("several rows for sample "), F.col(on).cast("string")))
    truth = once.select(on, *[F.when(F.col("__rows") == 1, F.col(c)).otherwise(several).alias(c) for c in columns])
    if (largest_group(completions, [on]) if largest is None else largest) <= limit:
        return join_on(completions, truth, [on], "left")
    blocks = completions.withColumn("__block", F.floor(F.col(generation) / GROUP_ROWS))
    used = blocks.groupBy(on, "__block").agg(F.lit(1).alias("__used")).drop("__used")
    copies = join_on(used, truth, [on], "inner")
    return join_on(blocks, copies, [on, "__block"], "left").drop("__block")


def score_completions(
    df: DataFrame,
    functions: Sequence[str] | None = None,
    weights: Mapping[str, float] | None = None,
    content: str = "content",
    truth: str = "true_value",
    lang: str = "lang",
    start_tag: str | None = w.THINK_OPEN,
    end_tag: str | None = w.THINK_CLOSE,
    answer_from: str = "first",
) -> DataFrame:
    """Add one column per reward function and their (weighted) sum ``reward``."""
    names = list(functions or rw.REWARDS)
    unknown = [n for n in names if n not in rw.REWARDS]
    if unknown:
        raise ValueError(f"unknown reward functions: {unknown}")
    optional = lambda c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    text = F.col(content)
    # Helper columns, so that no regex runs twice per completion.
    work = df.withColumn("__numbers", parse.all_numbers(text))
    found = rw.answer(text, F.col("__numbers"), answer_from)
    work = work.withColumn("__ratio", F.try_divide(found, optional(truth, "double").cast("double")))
    counts = {"__starts": start_tag, "__ends": end_tag}
    work = work.withColumns({c: count_of(text, tag) for c, tag in counts.items() if tag})
    given = rw.RewardInput(
        text, optional(truth, "double"), optional(lang, "string"), F.col("__numbers"), F.col("__ratio"),
        F.col("__starts") if start_tag else None, F.col("__ends") if end_tag else None,
    )
    scored = work.withColumns({n: rw.REWARDS[n](given) for n in names})
    return scored.select(*df.columns, *names, weighted_sum(names, weights).alias("reward"))


def weighted_sum(names: Sequence[str], weights: Mapping[str, float] | None = None) -> Column:
    """Sum of the columns, each times its weight (1 if not given)."""
    total = F.lit(0.0)
    for n in names:
        total = total + F.col(n) * float((weights or {}).get(n, 1.0))
    return total


def reward_report(scored: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, function, mean, min, max) of reward columns."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"avg{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("function"), F.col(f"avg{i}").alias("mean"),
            F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    return scored.groupBy(*keys).agg(*aggs).select(*keys, F.inline(F.array(*rows)))


def group_advantage(
    df: DataFrame,
    reward: str = "reward",
    on: str = "sample_id",
    generation: str = "generation_id",
    normalize: bool = True,
    whiten: bool = True,
    eps: float = 1e-4,
    limit: int = PLAIN_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """``advantage``: reward centred and scaled within the generations of a sample.

    Samples with at most ``limit`` generations (``largest``, if it is known) are one
    window group.  Otherwise sums are taken per block of consecutive generations,
    merged per sample, and joined back by block, so that no task sees a whole
    oversized group.  Sums are exact, so both plans give the same bits.
    """
    x, mean = F.col(reward).cast("double"), F.col("__mean")
    center = mean if normalize else F.lit(0.0)
    spread = F.col("__std") + eps if whiten else F.lit(1.0)
    advantage = (x - center) / spread
    odd = F.isnan(x) | (F.abs(x) == float("inf"))
    squares = (x - mean) * (x - mean)
    names = lambda values, stem: {f"{stem}{i}": c for i, c in enumerate(values)}
    total = lambda stem: joined([F.col(f"{stem}{i}") for i in range(3)])
    n = F.col("__n")
    mean_of = F.when(F.col("__odd") > 0, F.lit(float("nan"))).otherwise(F.try_divide(total("__s"), n))
    # A single generation has no spread.
    std_of = F.when(F.col("__odd") > 0, F.lit(float("nan"))).when(n > 1, F.sqrt(total("__q") / (n - 1))).otherwise(0.0)
    if (largest_group(df, [on]) if largest is None else largest) <= limit:
        group = Window.partitionBy(on)
        sums = {"__n": F.count(x).over(group), "__odd": F.count_if(odd).over(group), **names([F.sum(c).over(group) for c in cut(x)], "__s")}
        work = df.withColumns(sums).withColumn("__mean", mean_of)
        work = work.withColumns(names([F.sum(c).over(group) for c in cut(squares)], "__q")).withColumn("__std", std_of)
        return work.withColumn("advantage", advantage).select(*df.columns, "advantage")

    blocks = df.withColumn("__block", F.floor(F.col(generation) / GROUP_ROWS))
    part = [on, "__block"]
    sample = Window.partitionBy(on)
    merged = lambda stem: {f"{stem}{i}": F.sum(f"{stem}{i}").over(sample) for i in range(3)}
    aliased = lambda values, stem: [F.sum(c).alias(f"{stem}{i}") for i, c in enumerate(values)]
    parts = blocks.groupBy(*part).agg(F.count(x).alias("__n"), F.count_if(odd).alias("__odd"), *aliased(cut(x), "__s"))
    means = parts.withColumns({"__n": F.sum("__n").over(sample), "__odd": F.sum("__odd").over(sample), **merged("__s")})
    means = means.select(*part, "__n", "__odd", mean_of.alias("__mean"))
    met = join_on(blocks, broadcast_if_small(means), part, "left")
    spreads = met.groupBy(*part, "__n", "__odd", "__mean").agg(*aliased(cut(squares), "__q")).withColumns(merged("__q"))
    stats = spreads.select(*part, "__mean", std_of.alias("__std"))
    out = join_on(blocks, broadcast_if_small(stats), part, "left")
    return out.withColumn("advantage", advantage).select(*df.columns, "advantage")
