import pytest
from pyspark.sql import functions as F

from tidemill.functions import parsing, rewards
from tidemill.operators import completions, language
from tidemill.plans import jobs

CASES = [
    ("<think>x</think>予測値: 10.5", 10.0, 3.0, 1.0, 5.0, 3.5),
    ("x</think>12", 10.0, 3.0, -0.5, 1.5, 3.5),
    ("<think>a</think></think>20", 10.0, 0.0, -0.5, -1.5, 3.5),
    ("わかりません", 10.0, 0.0, -2.0, -4.5, -1.5),
    ("5", 0.0, 0.0, -2.0, -4.5, 3.5),
    ("5", None, 0.0, -2.0, 0.0, 3.5),
    ("ステップ1 予測値: 10", 10.0, 0.0, -2.0, -1.5, 3.5),
    ("", 10.0, 0.0, -2.0, -4.5, -1.5),
    ("9", 10.0, 0.0, -2.0, 5.0, 3.5),
    ("11", 10.0, 0.0, -2.0, 5.0, 3.5),
    ("7", 10.0, 0.0, -2.0, 1.5, 3.5),
    ("13", 10.0, 0.0, -2.0, 1.5, 3.5),
    ("5", float("nan"), 0.0, -2.0, -1.5, 3.5),
]


def test_reward_cases(spark):
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i INT, content STRING, true_value DOUBLE")
    names = ["match_format_exactly", "match_format_approximately", "check_answer", "check_numbers"]
    rows = completions.score_completions(df, names).orderBy("i").select(*names).collect()
    assert [tuple(r) for r in rows] == [c[2:] for c in CASES]


def test_unset_tags_contribute_nothing(spark):
    df = spark.createDataFrame([("</think>",)], "content STRING")
    row = completions.score_completions(df, start_tag=None, end_tag=None).first()
    assert row.match_format_exactly == 0.0 and row.match_format_approximately == 0.0
    row = completions.score_completions(df, start_tag=None).first()
    assert row.match_format_exactly == 3.0 and row.match_format_approximately == 0.5


@pytest.mark.parametrize("lang, score", [("ja", 5.0), ("en", -3.0), ("zh", -3.0), ("fr", -5.0), (None, -5.0)])
def test_language_reward(spark, lang, score):
    df = spark.createDataFrame([("text", lang)], "content STRING, lang STRING")
    assert completions.score_completions(df).first().format_and_language_reward_func == score


def test_registered_pandas_udf_is_summed(spark):
    import pandas as pd

    @F.pandas_udf("double")
    def brevity(content: pd.Series) -> pd.Series:
        return -content.str.len().astype(float)

    rewards.register_reward("brevity", lambda r: brevity(r.content))
    try:
        df = spark.createDataFrame([("abcd",)], "content STRING")
        row = completions.score_completions(df, ["check_numbers", "brevity"], {"brevity": 0.5}).first()
        assert row.reward == -1.5 - 2.0
    finally:
        del rewards.REWARDS["brevity"]
    with pytest.raises(ValueError):
        completions.score_completions(df, ["brevity"])


def test_special_tags_last_match_wins():
    found = rewards.special_tags(["<think>", "</think>", "<|user|>", "<|assistant|>", "<thinking>"])
    assert found == {"start_tag": "<thinking>", "end_tag": "</think>", "user": "<|user|>", "assistant": "<|assistant|>"}


VALUES = [
    ("予測値: 1.5 または 予測値: 2.5", 1.5, 2.5),
    ("予測値：3.5", 3.5, 3.5),
    ("<think>予測値: 9</think> 次の値: 4", 9.0, 4.0),
    ("答えは 7 か 8", 7.0, 8.0),
    ("なし", None, None),
    ("予測値: １２", 12.0, 12.0),
    ("予測: 5 予測: 6", 5.0, 6.0),
]


def test_point_values(spark):
    df = spark.createDataFrame([(i, v[0]) for i, v in enumerate(VALUES)], "i INT, t STRING").orderBy("i")
    rows = df.select(parsing.first_value(F.col("t")), parsing.last_value(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [v[1:] for v in VALUES]


def listed(n, sep=", "):
    return sep.join(f"{i}.5" for i in range(n))


SEQUENCES = [
    (f"予測結果（96点）:\n{listed(96)}", 96),
    (f"予測結果（120点）:\n{listed(120)}", 96),
    (f"予測結果（89点）:\n{listed(89)}", 0),
    (f"値 {listed(95)} です", 95),
    (f"値 {listed(101)} です", 0),
    (f"<think>{listed(96)}</think> 以上", 0),
    (f"予測結果(96点)\n```\n{listed(96)}\n```", 96),
    # A line break inside the headed list joins two tokens; the list pattern still reads it.
    (f"予測結果（96点）:\n{listed(48)}\n{listed(48)}", 0),
    (f"予測結果（96点）:\n-1.0, {listed(95)}", 96),
    (f"前 1, 2, 3 後 {listed(90, ' , ')}", 90),
    (f"{listed(20000)}", 0),
    ("", 0),
]


def test_forecast_sequence(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SEQUENCES)], "i INT, t STRING").orderBy("i")
    rows = df.select(F.size(parsing.forecast_sequence(F.col("t")))).collect()
    assert [r[0] for r in rows] == [s[1] for s in SEQUENCES]


def test_turns(spark):
    texts = [
        "user\nhi\nassistant\n 10 ",
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n 5 <|im_end|>\n",
        "none",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").orderBy("i")
    rows = df.select(parsing.last_turn_plain(F.col("t")), parsing.last_turn_marked(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["10", "5 <|im_end|>", "none"]
    assert [r[1] for r in rows] == [texts[0], "5", "none"]


def test_content_forms(spark):
    lists = spark.createDataFrame(
        [([("assistant", "a"), ("x", "b")],), ([],)], "content ARRAY<STRUCT<role: STRING, content: STRING>>"
    )
    assert [r[0] for r in completions.normalize_content(lists).collect()] == ["a", "[]"]
    single = spark.createDataFrame([(("assistant", "a"),)], "content STRUCT<role: STRING, content: STRING>")
    assert completions.normalize_content(single).first()[0] == "a"
    plain = spark.createDataFrame([(5,)], "content INT")
    assert completions.normalize_content(plain).first()[0] == "5"


def test_numbers_touching_dashes(spark):
    df = spark.createDataFrame([("2024-01-01",)], "t STRING")
    assert df.select(parsing.all_numbers(F.col("t"))).first()[0] == ["2024", "-01", "-01"]


@pytest.fixture
def generations(spark):
    """One sample has most of the generations."""
    rows = [(1, g, float(g % 7)) for g in range(5000)] + [(s, g, float(s * g)) for s in range(2, 50) for g in range(4)]
    rows += [(99, 0, 3.0)]
    return spark.createDataFrame(rows, "sample_id LONG, generation_id INT, reward DOUBLE")


def test_blockwise_advantage_equals_window(generations):
    key = ["sample_id", "generation_id"]
    one = completions.group_advantage(generations).orderBy(*key).collect()
    two = completions.group_advantage(generations, limit=0).orderBy(*key).collect()
    assert [r.advantage for r in two] == pytest.approx([r.advantage for r in one], abs=1e-9)
    assert one[-1].advantage == 0.0


def test_spread_truth_join_equals_plain(spark, generations):
    truth = spark.createDataFrame([(s, s * 1.5) for s in range(1, 40)], "sample_id LONG, true_value DOUBLE")
    one = completions.join_truth(generations, truth)
    two = completions.join_truth(generations, truth, limit=0)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert one.count() == generations.count()


def test_language_labels(spark):
    texts = [
        ("en", "the cat and the dog are in the house with the other animals"),
        ("fr", "le chat et le chien sont dans la maison avec les autres animaux"),
        ("de", "die katze und der hund sind mit den anderen tieren in dem haus"),
    ]
    train = spark.createDataFrame(texts, "lang STRING, text STRING")
    profile = language.language_profile(language.gram_counts(train))
    asked = [
        (1, "the other house", "en"), (2, "les chiens dans la maison", "fr"), (3, "der hund und die katze", "de"),
        (4, "これは日本語です", "ja"), (5, "这是中文", "zh"), (6, "", "und"), (7, "ab", "und"),
    ]
    df = spark.createDataFrame([a[:2] for a in asked], "id INT, text STRING")
    rows = language.label_language(df, profile, ["id"]).orderBy("id").collect()
    assert [r.label for r in rows] == [a[2] for a in asked]


def test_score_job(spark):
    truth = spark.createDataFrame([(1, 10.0), (2, 0.0)], "sample_id LONG, true_value DOUBLE")
    told = spark.createDataFrame(
        [(1, 0, "<think>a</think>10"), (1, 1, "なし"), (2, 0, "5"), (3, 0, "5")],
        "sample_id LONG, generation_id INT, content STRING",
    )
    train = spark.createDataFrame([("en", "think and other words")], "lang STRING, text STRING")
    profile = language.language_profile(language.gram_counts(train))
    rows = jobs.score(told, truth, profile=profile).orderBy("sample_id", "generation_id").collect()
    assert [r.format_and_language_reward_func for r in rows] == [-3.0, 5.0, -5.0, -5.0]
    with pytest.raises(Exception, match="language profile"):
        jobs.score(told, truth).collect()
    assert [r.check_answer for r in rows] == [5.0, -4.5, -4.5, 0.0]
    assert rows[0].advantage == pytest.approx(-rows[1].advantage) and rows[2].advantage == 0.0
