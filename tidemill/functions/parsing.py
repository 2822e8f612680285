"""Completion text to turns, numbers, sequences and flags (native regex only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions import wording as w
from tidemill.functions.text import bind, python_regex, strip, to_number


def message_content(messages: Column) -> Column:
    """Content of the first chat message; an empty list reads as its printed form."""
    first = F.coalesce(F.get(messages, F.lit(0)).getField("content"), F.lit(""))
    return F.when(F.size(messages) == 0, F.lit("[]")).otherwise(first)


def plain_content(content: Column) -> Column:
    """Text of a plain completion value; missing reads as empty."""
    return F.coalesce(content.cast("string"), F.lit(""))


def last_turn_plain(text: Column) -> Column:
    """What follows the last ``assistant``, trimmed."""
    return strip(F.substring_index(text, w.ASSISTANT_WORD, -1))


def last_turn_marked(text: Column) -> Column:
    """What follows the last turn mark, without end marks; text without marks as it is."""
    turn = strip(F.substring_index(text, w.TURN_OPEN, -1))
    turn = strip(F.replace(turn, F.lit(w.TURN_CLOSE), F.lit("")))
    return F.when(F.contains(text, F.lit(w.TURN_OPEN)), turn).otherwise(text)


def without_thought(text: Column) -> Column:
    """Each think block becomes one space; unpaired tags stay."""
    return F.regexp_replace(text, "(?s)" + w.THINK_OPEN + ".*?" + w.THINK_CLOSE, " ")


def first_value(text: Column) -> Column:
    """First match of the most explicit pattern that matches; NULL without a number."""
    return F.coalesce(*[to_number(F.regexp_extract(text, python_regex(p), 1)) for p in w.FIRST_VALUE_PATTERNS])


def last_value(text: Column) -> Column:
    """Last match of the most explicit pattern, outside think blocks."""
    def latest(spoken: Column) -> Column:
        return F.coalesce(
            *[
                to_number(F.try_element_at(F.regexp_extract_all(spoken, F.lit(python_regex(p)), 1), F.lit(-1)))
                for p in w.LAST_VALUE_PATTERNS
            ]
        )

    return bind(without_thought(text), latest)


def all_numbers(text: Column, pattern: str = w.ANY_NUMBER_PATTERN) -> Column:
    """Every number in the text, in order, as text."""
    return F.regexp_extract_all(text, F.lit(python_regex(pattern)), 0)


def leading_numbers(text: Column, n: int = 10, pattern: str = w.INSTRUCTION_NUMBER_PATTERN) -> Column:
    """The first ``n`` numbers of the text as doubles."""
    return F.transform(F.slice(all_numbers(text, pattern), 1, n), to_number)


def forecast_sequence(
    text: Column, horizon: int = 96, header_min: int = 90, list_min: int = 90, list_max: int = 100
) -> Column:
    """Numbers of a forecast outside think blocks, at most ``horizon`` of them.

    The list after the first result header counts if every token is a number and
    there are at least ``header_min``.  Else the first comma list of ``list_min`` to
    ``list_max`` unsigned numbers counts.  Else the array is empty.
    """
    complete = lambda numbers: ~F.exists(numbers, lambda x: x.isNull())

    def after_header(spoken: Column) -> Column:
        listed = F.regexp_extract(spoken, python_regex(w.RESULT_PATTERN), 2)
        tokens = F.transform(F.split(F.replace(listed, F.lit(" "), F.lit("")), ","), strip)
        numbers = F.transform(F.filter(tokens, lambda t: t != ""), to_number)
        return bind(numbers, lambda n: F.when((F.size(n) >= header_min) & complete(n), n))

    def first_list(spoken: Column) -> Column:
        lists = F.transform(
            F.regexp_extract_all(spoken, F.lit(python_regex(w.LIST_PATTERN)), 1),
            lambda match: F.transform(F.split(match, ","), lambda t: to_number(strip(t))),
        )
        fitting = F.filter(lists, lambda n: F.size(n).between(list_min, list_max) & complete(n))
        return F.get(fitting, F.lit(0))

    chosen = bind(without_thought(text), lambda spoken: F.coalesce(after_header(spoken), first_list(spoken)))
    return F.coalesce(F.slice(chosen, 1, horizon), F.array().cast("array<double>"))


def has_think_tags(text: Column) -> Column:
    return F.contains(text, F.lit(w.THINK_OPEN)) & F.contains(text, F.lit(w.THINK_CLOSE))


def has_result_header(text: Column) -> Column:
    return F.contains(text, F.lit(w.RESULT_MARK))


def preview(text: Column, n: int = 500) -> Column:
    return F.left(text, F.lit(n))
