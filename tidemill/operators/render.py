"""Windows to prompt/response samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import prompts as p
from tidemill.functions.text import fmt4, time_text
from tidemill.operators.windows import strided_windows
from tidemill.plans.sizing import materialize


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "string"


def build_samples(
    df: DataFrame,
    length: int,
    horizon: int,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    stride: int | None = None,
    template: str = "default",
    timestamp: str = "ts",
    value: str = "value",
    context: str | None = None,
    **options,
) -> DataFrame:
    """(keys, start, ordinal, instruction, output, input_values, target_values).

    The text of a row is made once and then cut into windows like its value.  A context column that does not exist is ignored.
    """
    p.check_template(template)
    is_text = _is_text(df, timestamp)

    def piece(make):
        return lambda row: make(template, time_text(row[timestamp], is_text), fmt4(row[value]))

    context = context if context in df.columns else None
    cut = strided_windows(
        df, length, horizon, order_by, keys, stride,
        columns=[value],
        first=[context] if context else [],
        extra=[timestamp],
        derived={"asked": piece(p.prompt_piece), "told": piece(p.response_piece)},
        **options,
    )
    shown = F.col(context) if context else None
    return cut.select(
        *keys, "start", "ordinal",
        p.prompt(template, F.col("input_asked"), horizon, shown).alias("instruction"),
        p.response(template, F.col("target_told")).alias("output"),
        F.col(f"input_{value}").cast("array<double>").alias("input_values"),
        F.col(f"target_{value}").cast("array<double>").alias("target_values"),
    )


def compare_templates(
    df: DataFrame,
    templates: Sequence[str],
    length: int,
    horizon: int,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    stride: int | None = None,
    timestamp: str = "ts",
    value: str = "value",
    context: str | None = None,
    **options,
) -> DataFrame:
    """(keys, start, template, prompt, response): each window under several templates."""
    for t in templates:
        p.check_template(t)
    is_text = _is_text(df, timestamp)

    def piece(make, template):
        return lambda row: make(template, time_text(row[timestamp], is_text), fmt4(row[value]))

    derived = {}
    for t in templates:
        derived |= {f"asked_{t}": piece(p.prompt_piece, t), f"told_{t}": piece(p.response_piece, t)}
    context = context if context in df.columns else None
    cut = strided_windows(
        df, length, horizon, order_by, keys, stride, columns=[value],
        first=[context] if context else [], extra=[timestamp], derived=derived, **options,
    )
    shown = F.col(context) if context else None
    rows = [
        F.struct(
            F.lit(t).alias("template"),
            p.prompt(t, F.col(f"input_asked_{t}"), horizon, shown).alias("prompt"),
            p.response(t, F.col(f"target_told_{t}")).alias("response"),
        )
        for t in templates
    ]
    return cut.select(*keys, "start", F.inline(F.array(*rows)))


def reformat_samples(samples: DataFrame, layout: str, horizon: int = 96) -> DataFrame:
    """Rewrite instruction and output of stored samples from their value arrays.

    ``simple`` has no think block, ``improved`` is the few-shot layout with one.
    """
    if layout not in ("simple", "improved"):
        raise ValueError(f"unknown layout: {layout}")
    asked, told = (p.value_texts(F.col(c)) for c in ("input_values", "target_values"))
    thought = layout == "improved"
    instruction = p.numeric_prompt(F.size("input_values"), F.array_join(asked, ", "), horizon, thought)
    output = p.response("numeric_only", told) if thought else p.result_list(F.size("target_values"), F.array_join(told, ", "))
    return samples.withColumns({"instruction": instruction, "output": output})


def header_prompts(df: DataFrame, length: int, order_by: Sequence[str], keys: Sequence[str] = (), timestamp: str = "ts", value: str = "value", **options) -> DataFrame:
    """(keys, index, timestamp, actual, prompt): one-step prompts with header tokens."""
    is_text = _is_text(df, timestamp)
    asked = lambda row: p.prompt_piece("default", time_text(row[timestamp], is_text), fmt4(row[value]))
    cut = strided_windows(
        df, length, 1, order_by, keys, 1, columns=[timestamp, value], derived={"asked": asked}, **options
    )
    return cut.select(
        *keys,
        (F.col("start") + length).alias("index"),
        F.col(f"target_{timestamp}")[0].alias("timestamp"),
        F.col(f"target_{value}")[0].cast("double").alias("actual"),
        p.header_prompt(F.col("input_asked")).alias("prompt"),
    )


def training_records(samples: DataFrame, keep: Sequence[str] = (), chat: bool = False) -> DataFrame:
    """(keep, prompt, response, true_value); ``chat`` adds the message list."""
    extra = [p.chat_messages(F.col("instruction")).alias("messages")] if chat else []
    return samples.select(
        *keep,
        F.col("instruction").alias("prompt"),
        F.col("output").alias("response"),
        F.get("target_values", F.lit(0)).alias("true_value"),
        *extra,
    )


def drop_long_prompts(df: DataFrame, quantile: float = 0.9, length: str | None = None, prompt: str = "prompt") -> DataFrame:
    """Keep prompts no longer than the (truncated) length quantile of all prompts.

    ``length`` names a token-count column; without it characters are counted.  The
    exact quantile holds one counter per distinct length, so it stays small.  The
    prompts are made and measured once: they are stored with their length, the
    quantile reads that column alone, and the long ones are left out on reading.
    """
    told = materialize(df.withColumn("__size", F.col(length) if length else F.length(prompt)))
    limit = told.agg(F.floor(F.percentile("__size", F.lit(quantile))).alias("limit"))
    return told.where(F.col("__size") <= limit.scalar()).drop("__size")
