"""Queries that render windows into samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import KEYS, ORDER, SCALED, SERIES, TEXT_TIME, TEXT_VALUE, joined, series, table, windows_sql
from tidemill.functions import prompts, wording as w
from tidemill.operators import render, scale, windows
from tidemill.plans import jobs

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NL = "chr(10)"
LINE = f"'時刻: ' || {TEXT_TIME} || ', 値: ' || {TEXT_VALUE}"
TOLD = f"'時刻: ' || {TEXT_TIME} || ', 予測値: ' || {TEXT_VALUE}"
COLON = f"{TEXT_TIME} || ': ' || {TEXT_VALUE}"


def lines(name: str) -> str:
    return f"array_to_string({name}, {NL})"


def numbered(name: str, label: str = "") -> str:
    return f"array_to_string(list_transform({name}, lambda x, i: CAST(i AS VARCHAR) || {q('. ' + label)} || x), {NL})"


def default_sql(horizon: int, pieces: str = "a_in", context: str = "''") -> str:
    return f"{q(w.DEFAULT_INTRO)} || {context} || {q(w.DEFAULT_DATA_HEADING)} || {lines(pieces)} || {NL} || {q(w.DEFAULT_QUESTION.format(horizon=horizon))}"


def conversational_sql() -> str:
    return f"{q(w.CONVERSATIONAL_HEADING)} || {numbered('c_in')} || {NL} || {q(w.CONVERSATIONAL_QUESTION)}"


def reasoning_sql(horizon: int) -> str:
    return f"{q(w.REASONING_INTRO)} || {q(w.REASONING_HEADING)} || {numbered('c_in', w.NUMBERED_TIME_LABEL)} || {NL} || {q(w.REASONING_QUESTION.format(horizon=horizon))}"


def numeric_sql(length: int, horizon: int, thought: bool = True) -> str:
    intro = w.NUMERIC_INTRO + (w.NUMERIC_EXAMPLE_THOUGHT if thought else "") + w.NUMERIC_EXAMPLE_ANSWER
    intro += w.NUMERIC_SERIES_LABEL.format(length=length)
    request = (w.NUMERIC_REQUEST if thought else w.SIMPLE_REQUEST).format(horizon=horizon)
    return f"{q(intro)} || array_to_string(v_in, ', ') || {q(request)}"


def numeric_answer_sql(horizon: int, thought: bool = True) -> str:
    head = (w.RESPONSE_THOUGHT if thought else "") + w.RESULT_HEADER.format(length=horizon)
    return f"{q(head)} || array_to_string(v_out, ', ')"


def _scaled(spark, d):
    return scale.scale(series(spark, d), "minmax", ["value"], KEYS)


def _samples(spark, d, template, length=10, horizon=2, stride=None):
    return render.build_samples(_scaled(spark, d), length, horizon, ORDER, KEYS, stride, template)


_LISTS = dict(a=LINE, t=TOLD, c=COLON, v=TEXT_VALUE)


def _sample_sql(prompt: str, answer: str, length=10, horizon=2, stride=1, ordinal="start"):
    return f"""SELECT k, start, {prompt} AS instruction, {answer} AS output
FROM ({windows_sql(length, horizon, stride, SCALED, **_LISTS)})"""


def _text(samples):
    return samples.select("k", "start", "instruction", "output")


@query(_sample_sql(default_sql(2), lines("t_out")))
def samples_default(spark, d):
    return _text(_samples(spark, d, "default"))


@query(_sample_sql(conversational_sql(), lines("t_out")))
def samples_conversational(spark, d):
    return _text(_samples(spark, d, "conversational"))


@query(_sample_sql(numeric_sql(48, 24), numeric_answer_sql(24), 48, 24, 12))
def samples_numeric(spark, d):
    return _text(_samples(spark, d, "numeric_only", 48, 24))


@query(_sample_sql(reasoning_sql(2), lines("t_out")))
def samples_reasoning(spark, d):
    return _text(_samples(spark, d, "reasoning"))


_CONTEXT = "SELECT event_type AS k, ts, event_id AS id, value, 'user ' || user_id AS context FROM events"


@query(f"""SELECT k, start, {default_sql(4, context=q(w.CONTEXT_LABEL) + " || context || chr(10) || chr(10)")} AS instruction, {lines('t_out')} AS output
FROM ({windows_sql(6, 4, 2, _CONTEXT, a=LINE, t=TOLD)})""")
def samples_with_context(spark, d):
    events = table(spark, d, "events").select(
        F.col("event_type").alias("k"), "ts", F.col("event_id").alias("id"), "value",
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("context"),
    )
    return _text(render.build_samples(events, 6, 4, ORDER, KEYS, context="context"))


@query(f"""SELECT k, start, {default_sql(1)} AS instruction, {lines('t_out')} AS output, v_in[1] AS first_value, v_out[1] AS target,
  CASE WHEN start < floor(count(*) OVER (PARTITION BY k) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split
FROM ({windows_sql(10, 1, 1, SCALED, a=LINE, t=TOLD, v=TEXT_VALUE)})""")
def dataset_build(spark, d):
    from tidemill.functions.text import fmt4

    built = jobs.build_dataset(_scaled(spark, d), 10, 1, ORDER, KEYS)
    return built.select(
        "k", "start", "instruction", "output", fmt4(F.col("input_values")[0]).alias("first_value"),
        fmt4(F.col("target_values")[0]).alias("target"), "split",
    )


@query(_sample_sql(numeric_sql(48, 96, thought=False), numeric_answer_sql(24, thought=False), 48, 24, 12))
def reformat_simple(spark, d):
    return _text(render.reformat_samples(_samples(spark, d, "numeric_only", 48, 24), "simple"))


@query(_sample_sql(numeric_sql(48, 96), numeric_answer_sql(24), 48, 24, 12))
def reformat_improved(spark, d):
    return _text(render.reformat_samples(_samples(spark, d, "numeric_only", 48, 24), "improved"))


@query(f"""SELECT k, start, i AS turn, CASE i WHEN 0 THEN 'system' ELSE 'user' END AS role,
  CASE i WHEN 0 THEN {q(w.SYSTEM_PROMPT)} ELSE prompt END AS content
FROM (SELECT k, start, {reasoning_sql(2)} AS prompt FROM ({windows_sql(10, 2, 1, SCALED, **_LISTS)})), (VALUES (0), (1)) t(i)""")
def chat_messages(spark, d):
    samples = _samples(spark, d, "reasoning")
    messages = samples.select("k", "start", prompts.chat_messages(F.col("instruction")).alias("m"))
    turns = messages.select("k", "start", F.posexplode("m").alias("turn", "message"))
    return turns.select("k", "start", "turn", "message.role", "message.content")


@query(f"""SELECT k, CAST(start + 10 AS BIGINT) AS index, actual[1] AS actual,
  {q(w.HEADER_OPEN)} || {default_sql(1)} || {q(w.HEADER_CLOSE)} AS prompt
FROM ({windows_sql(10, 1, 1, SERIES, a=LINE, actual='value')
       .replace('list(value) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS actual_in, ', '')
       .replace('AS actual_out', 'AS actual')})""")
def header_prompts(spark, d):
    return render.header_prompts(series(spark, d), 10, ORDER, KEYS).drop("timestamp")


@query(f"""SELECT k, start, {q(w.LIST_INTRO + '[')} || array_to_string(r_in, ', ') || {q(']' + w.LIST_STEPS)} AS prompt
FROM ({windows_sql(10, 1, 1, SERIES, r="CAST(value AS VARCHAR)")})""")
def list_prompts(spark, d):
    cut = windows.strided_windows(series(spark, d), 10, 1, ORDER, KEYS, 1, ["value"])
    return cut.select("k", "start", prompts.list_prompt(F.col("input_value")).alias("prompt"))


@query(f"""SELECT k, start, {reasoning_sql(2)} AS prompt, {lines('t_out')} AS response, v_out[1] AS true_value
FROM ({windows_sql(10, 2, 1, SCALED, **_LISTS)})""")
def training_records(spark, d):
    from tidemill.functions.text import fmt4

    records = render.training_records(_samples(spark, d, "reasoning"), ["k", "start"])
    return records.withColumn("true_value", fmt4(F.col("true_value")))


@query("""SELECT doc_id, length(text) AS n FROM documents
WHERE length(text) <= (SELECT floor(quantile_cont(length(text), 0.9)) FROM documents)""")
def drop_long_prompts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    return render.drop_long_prompts(docs).select("doc_id", F.length("prompt").cast("long").alias("n"))


_TEMPLATE_ROWS = windows_sql(5, 1, 1, SCALED, **_LISTS)


@query(f"""SELECT k, start, 'default' AS template, {default_sql(1)} AS prompt, {lines('t_out')} AS response FROM ({_TEMPLATE_ROWS})
UNION ALL SELECT k, start, 'conversational', {conversational_sql()}, {lines('t_out')} FROM ({_TEMPLATE_ROWS})
UNION ALL SELECT k, start, 'numeric_only', {numeric_sql(5, 1)}, {numeric_answer_sql(1)} FROM ({_TEMPLATE_ROWS})
UNION ALL SELECT k, start, 'reasoning', {reasoning_sql(1)}, {lines('t_out')} FROM ({_TEMPLATE_ROWS})""")
def template_compare(spark, d):
    return render.compare_templates(_scaled(spark, d), prompts.TEMPLATES, 5, 1, ORDER, KEYS)
