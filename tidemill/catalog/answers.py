"""Queries that parse and score completions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import COMPLETIONS, SEQUENCES, TRUTHS, completions, r6, rounded, sequences, table, truths
from tidemill.functions import parsing as parse, rewards, wording as w
from tidemill.operators import completions as ops, language
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


THINK = f"regexp_replace(content, '(?s)<think>.*?</think>', ' ', 'g')"
FIRST = "coalesce(" + ", ".join(
    f"try_cast(nullif(regexp_extract(content, {q(p)}, 1), '') AS DOUBLE)" for p in w.FIRST_VALUE_PATTERNS
) + ")"
LAST = "coalesce(" + ", ".join(
    f"try_cast(regexp_extract_all(spoken, {q(p)}, 1)[-1] AS DOUBLE)" for p in w.LAST_VALUE_PATTERNS
) + ")"
NUMBERS = f"regexp_extract_all(content, {q(w.ANY_NUMBER_PATTERN)})"
STRIP = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
COUNT = lambda tag: f"((length(content) - length(replace(content, '{tag}', ''))) // {len(tag)})"

# ---- parsing --------------------------------------------------------------

_CHAT = """SELECT conv_id, turn, '<|im_start|>user' || chr(10) || 'hello<|im_end|>' || chr(10) || '<|im_start|>' || role || chr(10)
  || text || '<|im_end|>' || chr(10) AS content FROM conversations"""


def _chat(spark, d):
    nl = F.lit("\n")
    content = F.concat(
        F.lit("<|im_start|>user\nhello<|im_end|>\n<|im_start|>"), F.col("role"), nl, F.col("text"), F.lit("<|im_end|>\n")
    )
    return table(spark, d, "conversations").select("conv_id", "turn", content.alias("content"))


@query(f"""SELECT conv_id, turn, {STRIP("string_split(content, 'assistant')[-1]")} AS plain,
  CASE WHEN contains(content, '<|im_start|>assistant')
    THEN {STRIP("replace(" + STRIP("string_split(content, '<|im_start|>assistant')[-1]") + ", '<|im_end|>', '')")}
    ELSE content END AS marked FROM ({_CHAT})""")
def assistant_turn(spark, d):
    text = F.col("content")
    return _chat(spark, d).select(
        "conv_id", "turn", parse.last_turn_plain(text).alias("plain"), parse.last_turn_marked(text).alias("marked")
    )


@query("SELECT conv_id, turn, coalesce(text, '') AS content FROM conversations")
def content_forms(spark, d):
    """Message lists normalised to text."""
    message = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("content")))
    turns = table(spark, d, "conversations").select("conv_id", "turn", message.alias("content"))
    return ops.normalize_content(turns)


@query(f"SELECT sample_id, generation_id, {THINK} AS spoken FROM ({COMPLETIONS})")
def strip_thought(spark, d):
    return completions(spark, d).select("sample_id", "generation_id", parse.without_thought(F.col("content")).alias("spoken"))


@query(f"SELECT sample_id, generation_id, {FIRST} AS value FROM ({COMPLETIONS})")
def point_first(spark, d):
    return completions(spark, d).select("sample_id", "generation_id", parse.first_value(F.col("content")).alias("value"))


@query(f"SELECT sample_id, generation_id, {LAST} AS value FROM (SELECT *, {THINK} AS spoken FROM ({COMPLETIONS}))")
def point_last(spark, d):
    return completions(spark, d).select("sample_id", "generation_id", parse.last_value(F.col("content")).alias("value"))


@query(f"""SELECT doc_id, {FIRST} AS first_value, {LAST} AS last_value
FROM (SELECT *, {THINK} AS spoken FROM (SELECT doc_id, text AS content FROM documents))""")
def point_values_in_documents(spark, d):
    text = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", parse.first_value(text).alias("first_value"), parse.last_value(text).alias("last_value")
    )


@query(f"""SELECT sample_idx, len(parsed) AS n, array_to_string(list_transform(parsed, lambda x: printf('%.4f', x)), ', ') AS numbers
FROM ({SEQUENCES})""")
def sequence_parse(spark, d):
    from tidemill.catalog.base import joined

    parsed = sequences(spark, d).withColumn("s", parse.forecast_sequence(F.col("content"), 64, 60, 60, 70))
    return parsed.select("sample_idx", F.size("s").cast("long").alias("n"), joined(F.col("s")).alias("numbers"))


@query(f"""SELECT doc_id, len(numbers) AS n, array_to_string(numbers, ' ') AS numbers,
  array_to_string(list_transform(first_ten, lambda x: printf('%.4f', x)), ', ') AS first_ten FROM (
  SELECT doc_id, {NUMBERS} AS numbers,
    list_transform(regexp_extract_all(content, {q(w.INSTRUCTION_NUMBER_PATTERN)})[1:10], lambda x: try_cast(x AS DOUBLE)) AS first_ten
  FROM (SELECT doc_id, text AS content FROM documents))""")
def number_list(spark, d):
    from tidemill.catalog.base import joined

    docs = table(spark, d, "documents").withColumn("a", parse.all_numbers(F.col("text")))
    return docs.select(
        "doc_id", F.size("a").cast("long").alias("n"), F.array_join("a", " ").alias("numbers"),
        joined(parse.leading_numbers(F.col("text"))).alias("first_ten"),
    )


@query(f"""SELECT sample_id, generation_id, CAST(contains(content, '<think>') AND contains(content, '</think>') AS INTEGER) AS has_think_tags,
  CAST(contains(content, '予測結果') AS INTEGER) AS has_result_header FROM ({COMPLETIONS})""")
def format_flags(spark, d):
    text = F.col("content")
    return completions(spark, d).select(
        "sample_id", "generation_id",
        parse.has_think_tags(text).cast("int").alias("has_think_tags"),
        parse.has_result_header(text).cast("int").alias("has_result_header"),
    )


@query("""SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, ',', '')) AS n_commas,
  left(text, 500) AS response_preview FROM documents""")
def text_stats(spark, d):
    parsed = ops.parse_completions(table(spark, d, "documents").select("doc_id", "text"), "text")
    return parsed.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.col("n_commas").cast("long").alias("n_commas"), "response_preview"
    )


@query(f"""SELECT sample_idx, length(content) AS content_chars, length(content) - length(replace(content, ',', '')) AS content_commas,
  length(output) AS output_chars, length(output) - length(replace(output, ',', '')) AS output_commas
FROM (SELECT *, '予測結果（64点）:' || chr(10) || array_to_string(list_transform(target_values, lambda x: printf('%.4f', x)), ', ') AS output
  FROM ({SEQUENCES}))""")
def response_statistics(spark, d):
    stats = ops.text_statistics(sequences(spark, d), ["content", "output"])
    names = ["content_chars", "content_commas", "output_chars", "output_commas"]
    return stats.select("sample_idx", *[F.col(n).cast("long").alias(n) for n in names])


@query(f"""SELECT label, count(*) AS n_total, count(*) FILTER (WHERE len(parsed) > 0) AS n_valid,
  round(avg(CAST(len(parsed) > 0 AS DOUBLE)), 6) AS success_rate,
  round(avg(CAST(contains(content, '<think>') AND contains(content, '</think>') AS DOUBLE)), 6) AS think_rate,
  round(avg(CAST(contains(content, '予測結果') AS DOUBLE)), 6) AS header_rate FROM ({SEQUENCES}) GROUP BY label""")
def parse_rate(spark, d):
    parsed = ops.parse_completions(sequences(spark, d), "content", 64, 60, 60, 70)
    return rounded(ops.parse_report(parsed, ["label"]), "success_rate", "think_rate", "header_rate")


# ---- rewards --------------------------------------------------------------

EXACT = f"CASE WHEN {COUNT('</think>')} = 1 THEN 3.0 ELSE 0.0 END"
APPROX = f"(CASE WHEN {COUNT('<think>')} = 1 THEN 0.5 ELSE -1.0 END + CASE WHEN {COUNT('</think>')} = 1 THEN 0.5 ELSE -1.0 END)"
ANSWER = f"""CASE WHEN true_value IS NULL THEN 0.0 WHEN len({NUMBERS}) = 0 OR true_value = 0 THEN -4.5
  WHEN CAST({NUMBERS}[1] AS DOUBLE) / true_value BETWEEN CAST(0.9 AS DOUBLE) AND CAST(1.1 AS DOUBLE) THEN 5.0
  WHEN CAST({NUMBERS}[1] AS DOUBLE) / true_value BETWEEN CAST(0.7 AS DOUBLE) AND CAST(1.3 AS DOUBLE) THEN 1.5 ELSE -1.5 END"""
ANY = f"CASE WHEN len({NUMBERS}) > 0 THEN 3.5 ELSE -1.5 END"
LANGUAGE = "CASE WHEN content = '' THEN -5.0 WHEN lang = 'ja' THEN 5.0 WHEN lang IN ('en', 'zh') THEN -3.0 ELSE -5.0 END"
WITH_TRUTH = f"(SELECT c.*, t.true_value FROM ({COMPLETIONS}) c LEFT JOIN ({TRUTHS}) t USING (sample_id))"
NAMES = list(rewards.REWARDS)
SCORED = f"""(SELECT sample_id, generation_id, CAST({EXACT} AS DOUBLE) AS match_format_exactly,
  CAST({APPROX} AS DOUBLE) AS match_format_approximately, CAST({ANSWER} AS DOUBLE) AS check_answer,
  CAST({ANY} AS DOUBLE) AS check_numbers, CAST({LANGUAGE} AS DOUBLE) AS format_and_language_reward_func FROM {WITH_TRUTH})"""
TOTAL = " + ".join(NAMES)


def _scored(spark, d, **options):
    return ops.score_completions(ops.join_truth(completions(spark, d), truths(spark, d)), **options)


def _one(name):
    return lambda spark, d: _scored(spark, d, functions=[name]).select("sample_id", "generation_id", name)


for _key, _name in (
    ("reward_exact", "match_format_exactly"),
    ("reward_approx", "match_format_approximately"),
    ("reward_answer", "check_answer"),
    ("reward_numbers", "check_numbers"),
    ("reward_language", "format_and_language_reward_func"),
):
    QUERIES[_key] = _one(_name)
    SQL[_key] = f"SELECT sample_id, generation_id, {_name} FROM {SCORED}"


@query(f"""SELECT sample_id, generation_id, CAST(CASE WHEN true_value IS NULL THEN 0.0 WHEN answer IS NULL OR true_value = 0 THEN -4.5
  WHEN answer / true_value BETWEEN CAST(0.9 AS DOUBLE) AND CAST(1.1 AS DOUBLE) THEN 5.0
  WHEN answer / true_value BETWEEN CAST(0.7 AS DOUBLE) AND CAST(1.3 AS DOUBLE) THEN 1.5 ELSE -1.5 END AS DOUBLE) AS check_answer
FROM (SELECT *, {LAST} AS answer FROM (SELECT *, {THINK} AS spoken FROM {WITH_TRUTH}))""")
def reward_final_answer(spark, d):
    scored = _scored(spark, d, functions=["check_answer"], answer_from="final")
    return scored.select("sample_id", "generation_id", "check_answer")


@query("""SELECT doc_id, CAST(CASE WHEN text = '' THEN -5.0 WHEN lang = 'ja' THEN 5.0 WHEN lang IN ('en', 'zh') THEN -3.0 ELSE -5.0 END AS DOUBLE)
  AS format_and_language_reward_func FROM documents""")
def reward_document_language(spark, d):
    scored = ops.score_completions(table(spark, d, "documents"), ["format_and_language_reward_func"], content="text")
    return scored.select("doc_id", "format_and_language_reward_func")


@query(f"SELECT sample_id, generation_id, {TOTAL} AS reward FROM {SCORED}")
def reward_total(spark, d):
    return _scored(spark, d).select("sample_id", "generation_id", "reward")


_WEIGHTS = {
    "match_format_exactly": 0.2, "match_format_approximately": 0.2, "check_answer": 0.6,
    "check_numbers": 0.0, "format_and_language_reward_func": 0.2,
}


@query(f"SELECT sample_id, generation_id, round({' + '.join(f'{n} * CAST({v} AS DOUBLE)' for n, v in _WEIGHTS.items())}, 6) AS reward FROM {SCORED}")
def reward_weighted(spark, d):
    return rounded(_scored(spark, d, weights=_WEIGHTS).select("sample_id", "generation_id", "reward"), "reward")


@query("\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"function\", round(avg({n}), 6) AS mean, min({n}) AS min, max({n}) AS max FROM {SCORED}" for n in NAMES
))
def reward_report(spark, d):
    return rounded(ops.reward_report(_scored(spark, d), NAMES), "mean")


@query(f"""SELECT sample_id, generation_id, round((reward - avg(reward) OVER g) / (coalesce(stddev_samp(reward) OVER g, 0) + 1e-4), 6) AS advantage
FROM (SELECT sample_id, generation_id, {TOTAL} AS reward FROM {SCORED}) WINDOW g AS (PARTITION BY sample_id)""")
def group_advantage(spark, d):
    scored = ops.group_advantage(_scored(spark, d))
    return rounded(scored.select("sample_id", "generation_id", "advantage"), "advantage")


@query("""SELECT doc_id, generation_id, round((r - avg(r) OVER g) / (coalesce(stddev_samp(r) OVER g, 0) + 1e-4), 6) AS advantage
FROM (SELECT source AS doc_id, doc_id AS generation_id, CAST(length(text) AS DOUBLE) AS r FROM documents) WINDOW g AS (PARTITION BY doc_id)""")
def large_group_advantage(spark, d):
    """Few, big groups take the blockwise plan; the reward is the text length."""
    docs = table(spark, d, "documents").select(
        F.col("source").alias("doc_id"), F.col("doc_id").alias("generation_id"), F.length("text").cast("double").alias("reward")
    )
    out = ops.group_advantage(docs, on="doc_id", limit=0)
    return rounded(out.select("doc_id", "generation_id", "advantage"), "advantage")


# ---- language -------------------------------------------------------------

GRAMS = """SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
FROM (SELECT doc_id, lang, string_split(lower(text), '') AS c FROM documents)"""
COUNTS = f"SELECT lang, gram, count(*) AS n FROM ({GRAMS}) GROUP BY lang, gram"
PROFILE = f"""SELECT lang, gram, n, ln((n + 1) / (sum(n) OVER l + count(*) OVER l)) AS log_p, ln(1.0 / (sum(n) OVER l + count(*) OVER l)) AS log_floor
FROM ({COUNTS}) WINDOW l AS (PARTITION BY lang)"""


@query(COUNTS)
def lang_gram_counts(spark, d):
    return language.gram_counts(table(spark, d, "documents"))


@query(f"SELECT lang, gram, n, round(log_p, 6) AS log_p, round(log_floor, 6) AS log_floor FROM ({PROFILE})")
def lang_profile(spark, d):
    profile = language.language_profile(language.gram_counts(table(spark, d, "documents")))
    return rounded(profile, "log_p", "log_floor")


@query(f"""WITH profile AS ({PROFILE}), floors AS (SELECT lang AS cand, min(log_floor) AS f FROM profile GROUP BY lang),
scores AS (SELECT g.doc_id, f.cand, sum(coalesce(p.log_p, f.f)) AS s FROM ({GRAMS}) g CROSS JOIN floors f
  LEFT JOIN profile p ON p.lang = f.cand AND p.gram = g.gram GROUP BY 1, 2),
best AS (SELECT doc_id, cand AS guess FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, cand) = 1)
SELECT d.lang, coalesce(b.guess, 'und') AS label, count(*) AS n FROM documents d LEFT JOIN best b USING (doc_id) GROUP BY 1, 2""")
def lang_labels(spark, d):
    """Labels of all documents against their given language."""
    docs = table(spark, d, "documents")
    profile = language.language_profile(language.gram_counts(docs))
    labels = language.label_language(docs, profile, ["doc_id", "lang"])
    return labels.groupBy("lang", "label").agg(F.count("*").alias("n"))


@query(f"""SELECT sample_id, generation_id, true_value, round({TOTAL}, 6) AS reward FROM (SELECT s.*, t.true_value FROM {SCORED} s LEFT JOIN ({TRUTHS}) t USING (sample_id))""")
def score_job(spark, d):
    scored = jobs.score(completions(spark, d), truths(spark, d), advantage=False)
    return rounded(scored.select("sample_id", "generation_id", "true_value", "reward"), "reward")


LABELLED = rf"""WITH profile AS MATERIALIZED ({PROFILE}), floors AS (SELECT lang AS cand, min(log_floor) AS f FROM profile GROUP BY lang),
told AS (SELECT sample_id, generation_id, content FROM ({COMPLETIONS})),
grams AS (SELECT sample_id, generation_id, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS gram
  FROM (SELECT *, string_split(lower(content), '') AS c FROM told)),
scores AS (SELECT g.sample_id, g.generation_id, f.cand, sum(coalesce(p.log_p, f.f)) AS s FROM grams g CROSS JOIN floors f
  LEFT JOIN profile p ON p.lang = f.cand AND p.gram = g.gram GROUP BY 1, 2, 3),
best AS (SELECT sample_id, generation_id, cand FROM scores
  QUALIFY row_number() OVER (PARTITION BY sample_id, generation_id ORDER BY s DESC, cand) = 1),
letters AS (SELECT *, length(regexp_replace(content, '[^\x{{3040}}-\x{{30ff}}]', '', 'g')) AS kana,
  length(regexp_replace(content, '[^\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}]', '', 'g')) AS han,
  length(regexp_replace(content, '[^\p{{L}}]', '', 'g')) AS letters FROM told)
SELECT t.sample_id, t.generation_id, CASE WHEN (kana + han) * 2 > letters THEN CASE WHEN kana * 10 >= kana + han THEN 'ja' ELSE 'zh' END
  ELSE coalesce(b.cand, 'und') END AS lang FROM letters t LEFT JOIN best b USING (sample_id, generation_id)"""


@query(f"""SELECT sample_id, generation_id, lang, CASE lang WHEN 'ja' THEN 5.0 WHEN 'en' THEN -3.0 WHEN 'zh' THEN -3.0 ELSE -5.0 END AS reward
FROM ({LABELLED})""".replace("5.0 WHEN", "CAST(5.0 AS DOUBLE) WHEN"))
def score_unlabelled(spark, d):
    """Completions without a language column, labelled by a profile of the documents."""
    profile = language.language_profile(language.gram_counts(table(spark, d, "documents")))
    told = completions(spark, d).drop("lang")
    scored = jobs.score(told, truths(spark, d), advantage=False, profile=profile, functions=["format_and_language_reward_func"])
    return scored.select("sample_id", "generation_id", "lang", "reward")
