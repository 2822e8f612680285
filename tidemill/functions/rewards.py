"""Reward functions over completion content, as columns.

A reward function takes ``RewardInput`` and returns a double column.  The column may
also come from a pandas UDF; the registry does not care.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions import wording as w
from tidemill.functions.parsing import last_value
from tidemill.functions.text import to_number


@dataclass(frozen=True)
class RewardInput:
    """What a reward function may use.

    ``numbers`` (all numbers of the content), ``ratio`` (answer / truth) and the tag
    counts are columns computed once per completion; a tag that is not set has none.
    """

    content: Column
    truth: Column
    lang: Column
    numbers: Column
    ratio: Column
    start_count: Column | None
    end_count: Column | None


RewardFunction = Callable[[RewardInput], Column]


def answer(content: Column, numbers: Column, answer_from: str = "first") -> Column:
    """The number a completion answers with.

    ``first`` is the first number anywhere in the text, reasoning included;
    ``final`` is the last explicit value outside the reasoning.
    """
    if answer_from == "first":
        return to_number(F.get(numbers, F.lit(0)))
    if answer_from == "final":
        return last_value(content)
    raise ValueError(f"unknown answer_from: {answer_from}")


def match_format_exactly(r: RewardInput) -> Column:
    """3 if the end tag occurs exactly once."""
    if r.end_count is None:
        return F.lit(0.0)
    return F.when(r.end_count == 1, 3.0).otherwise(0.0)


def match_format_approximately(r: RewardInput) -> Column:
    """Per configured tag: 0.5 if it occurs exactly once, else -1."""
    score = F.lit(0.0)
    for count in (r.start_count, r.end_count):
        if count is not None:
            score = score + F.when(count == 1, 0.5).otherwise(-1.0)
    return score


def check_answer(r: RewardInput) -> Column:
    """Closeness of the answer to the truth; no answer or a truth of zero has no ratio."""
    return (
        F.when(r.truth.isNull(), 0.0)
        .when(r.ratio.isNull(), -4.5)
        .when(r.ratio.between(0.9, 1.1), 5.0)
        .when(r.ratio.between(0.7, 1.3), 1.5)
        .otherwise(-1.5)
    )


def check_numbers(r: RewardInput) -> Column:
    """3.5 if the text holds any number, else -1.5."""
    return F.when(F.size(r.numbers) > 0, 3.5).otherwise(-1.5)


def language_reward(r: RewardInput) -> Column:
    """Reward of the language label of the text; an empty text is undetermined."""
    lang = F.when(r.content == "", F.lit(w.UNDETERMINED)).otherwise(r.lang)
    score = None
    for code, value in w.LANGUAGE_REWARDS.items():
        score = F.when(lang == code, value) if score is None else score.when(lang == code, value)
    return score.otherwise(w.OTHER_LANGUAGE_REWARD)


REWARDS: dict[str, RewardFunction] = {
    "match_format_exactly": match_format_exactly,
    "match_format_approximately": match_format_approximately,
    "check_answer": check_answer,
    "check_numbers": check_numbers,
    "format_and_language_reward_func": language_reward,
}


def register_reward(name: str, function: RewardFunction) -> None:
    """Add a reward function, or replace the one of that name."""
    REWARDS[name] = function


def special_tags(tokens: list[str]) -> dict[str, str | None]:
    """Pick the tags out of a vocabulary's special tokens; the last match wins."""
    found: dict[str, str | None] = dict.fromkeys(("start_tag", "end_tag", "user", "assistant"))
    for token in tokens:
        if "think" in token:
            found["end_tag" if "/" in token else "start_tag"] = token
        elif "user" in token:
            found["user"] = token
        elif "assistant" in token:
            found["assistant"] = token
    return found
