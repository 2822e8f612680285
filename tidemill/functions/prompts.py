"""Prompt and response texts as column expressions.

A template turns each row into a short piece of text and joins the pieces of a
window.  Pieces can be made once per row, before windows are cut, so that a value
is formatted once and not once per window it appears in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions import wording as w
from tidemill.functions.text import fmt4, pyrepr

TEMPLATES = ("default", "conversational", "numeric_only", "reasoning")
_NUMBERED = ("conversational", "reasoning")


def check_template(template: str) -> str:
    if template not in TEMPLATES:
        raise ValueError(f"unknown template: {template}")
    return template


def prompt_piece(template: str, ts: Column, value_text: Column) -> Column:
    """Text of one input row."""
    check_template(template)
    if template == "numeric_only":
        return value_text
    if template == "default":
        return F.concat(F.lit(w.TIME_LABEL), ts, F.lit(w.VALUE_LABEL), value_text)
    label = w.NUMBERED_TIME_LABEL if template == "reasoning" else ""
    return F.concat(F.lit(label), ts, F.lit(": "), value_text)


def response_piece(template: str, ts: Column, value_text: Column) -> Column:
    """Text of one target row."""
    check_template(template)
    if template == "numeric_only":
        return value_text
    return F.concat(F.lit(w.TIME_LABEL), ts, F.lit(w.FORECAST_LABEL), value_text)


def prompt(template: str, pieces: Column, horizon: int, context: Column | None = None) -> Column:
    """Prompt of a window from the pieces of its input rows."""
    check_template(template)
    if template == "numeric_only":
        return numeric_prompt(F.size(pieces), F.array_join(pieces, ", "), horizon)
    if template in _NUMBERED:
        pieces = F.transform(pieces, lambda p, i: F.concat((i + 1).cast("string"), F.lit(". "), p))
    # Every line ends with a newline; an empty window has no line at all.
    body = F.when(F.size(pieces) > 0, F.concat(F.array_join(pieces, "\n"), F.lit("\n"))).otherwise(F.lit(""))

    def with_context(before: str, after: str) -> list[Column]:
        if context is None:
            return []
        shown = F.concat(F.lit(before), context.cast("string"), F.lit(after))
        return [F.when(F.coalesce(context.cast("string"), F.lit("")) != "", shown).otherwise(F.lit(""))]

    if template == "default":
        parts = [
            F.lit(w.DEFAULT_INTRO), *with_context(w.CONTEXT_LABEL, "\n\n"),
            F.lit(w.DEFAULT_DATA_HEADING), body, F.lit(w.DEFAULT_QUESTION.format(horizon=horizon)),
        ]
    elif template == "conversational":
        parts = [*with_context("", "\n"), F.lit(w.CONVERSATIONAL_HEADING), body, F.lit(w.CONVERSATIONAL_QUESTION)]
    else:
        parts = [
            F.lit(w.REASONING_INTRO), *with_context(w.CONTEXT_LABEL, "\n\n"),
            F.lit(w.REASONING_HEADING), body, F.lit(w.REASONING_QUESTION.format(horizon=horizon)),
        ]
    return F.concat(*parts)


def response(template: str, pieces: Column) -> Column:
    """Expected answer of a window from the pieces of its target rows."""
    check_template(template)
    if template == "numeric_only":
        return F.concat(F.lit(w.RESPONSE_THOUGHT), result_list(F.size(pieces), F.array_join(pieces, ", ")))
    return F.array_join(pieces, "\n")


def result_list(length: Column, listed: Column) -> Column:
    before, after = w.RESULT_HEADER.split("{length}")
    return F.concat(F.lit(before), length.cast("string"), F.lit(after), listed)


def numeric_prompt(length: Column, listed: Column, horizon: int, thought: bool = True) -> Column:
    """Few-shot prompt over a comma list; ``thought=False`` leaves the think tags out."""
    before, after = w.NUMERIC_SERIES_LABEL.split("{length}")
    intro = w.NUMERIC_INTRO + (w.NUMERIC_EXAMPLE_THOUGHT if thought else "") + w.NUMERIC_EXAMPLE_ANSWER + before
    request = (w.NUMERIC_REQUEST if thought else w.SIMPLE_REQUEST).format(horizon=horizon)
    return F.concat(F.lit(intro), length.cast("string"), F.lit(after), listed, F.lit(request))


def value_texts(values: Column) -> Column:
    """Array of doubles as an array of four-decimal texts."""
    return F.transform(values, fmt4)


def header_prompt(pieces: Column) -> Column:
    """One-step default prompt wrapped in literal header tokens."""
    return F.concat(F.lit(w.HEADER_OPEN), prompt("default", pieces, 1), F.lit(w.HEADER_CLOSE))


def list_prompt(values: Column) -> Column:
    """Prompt that shows the values as a bracketed list at full precision."""
    listed = F.array_join(F.transform(values, pyrepr), ", ")
    return F.concat(F.lit(w.LIST_INTRO + "["), listed, F.lit("]" + w.LIST_STEPS))


def chat_messages(user: Column, system: Column | str = w.SYSTEM_PROMPT) -> Column:
    """System and user message of one sample."""
    system = F.lit(system) if isinstance(system, str) else system

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", system), message("user", user))
