"""Texts, tags and patterns that samples and parsers must share.

Nothing here is logic.  The prompts are read by a model and the answers by the
parsers, so every character counts.
"""

# Prompt texts.
DEFAULT_INTRO = "以下の時系列データの次の値を予測してください。\n\n"
CONTEXT_LABEL = "コンテキスト: "
DEFAULT_DATA_HEADING = "過去のデータ:\n"
DEFAULT_QUESTION = "\n次の{horizon}ステップの予測値を教えてください。"

CONVERSATIONAL_HEADING = "以下は時系列データです:\n"
CONVERSATIONAL_QUESTION = "\nこのトレンドから、次の値を予測してください。"

REASONING_INTRO = (
    "あなたは時系列データの予測を専門とするAIアシスタントです。"
    "以下のデータを分析し、論理的な推論プロセスを示して次の値を予測してください。\n\n"
)
REASONING_HEADING = "時系列データ:\n"
REASONING_QUESTION = (
    "\n<think>\n"
    "ステップ1: データのトレンドやパターンを分析してください。\n"
    "ステップ2: 増加傾向か減少傾向かを判断してください。\n"
    "ステップ3: 過去の変化率から次の値を推論してください。\n"
    "</think>\n\n"
    "上記の分析を基に、次の{horizon}ステップの予測値を論理的根拠とともに教えてください。"
)

NUMERIC_INTRO = (
    "あなたは時系列予測の専門家です。以下の形式に厳密に従って予測を行ってください。\n\n"
    "## 出力形式の例\n\n"
    "入力: 0.3188, 0.3076, 0.3090, 0.3118\n"
    "出力:\n"
)
NUMERIC_EXAMPLE_THOUGHT = "<think>\n[自由に推論してください]\n</think>\n\n"
NUMERIC_EXAMPLE_ANSWER = (
    "予測結果（4点）:\n"
    "0.3100, 0.3085, 0.3095, 0.3110\n\n"
    "---\n\n"
    "## あなたのタスク\n\n"
)
NUMERIC_SERIES_LABEL = "入力系列({length}点): "
NUMERIC_REQUEST = (
    "\n\n必ず上記の形式に従い、<think>タグで自由に分析を行った後、\n"
    "「予測結果（{horizon}点）:」に続けてカンマ区切りの数値列のみを\n"
    "{horizon}個出力してください。"
)
SIMPLE_REQUEST = (
    "\n\n「予測結果（{horizon}点）:」に続けてカンマ区切りの数値列を"
    "{horizon}個出力してください。"
)

# Per-row pieces of prompts and responses.
TIME_LABEL = "時刻: "
NUMBERED_TIME_LABEL = "時刻 "
VALUE_LABEL = ", 値: "
FORECAST_LABEL = ", 予測値: "

# Responses.
RESPONSE_THOUGHT = "<think>\n[推論プロセス]\n</think>\n\n"
RESULT_HEADER = "予測結果（{length}点）:\n"

# Chat messages and inference prompts.
SYSTEM_PROMPT = (
    "あなたは時系列データを分析し、未来の値を予測する専門家です。"
    "与えられたデータから傾向やパターンを見つけ出し、日本語で推論過程を説明してください。"
)
HEADER_OPEN = "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n"
HEADER_CLOSE = "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
LIST_INTRO = "以下の時系列データの次の値を予測してください:\n\nデータ: "
LIST_STEPS = (
    "\n\nステップ:\n"
    "1. データの傾向を分析\n"
    "2. パターンを特定\n"
    "3. 次の値を予測\n"
    "4. 予測根拠を説明"
)

# Tags and markers looked for in completions.
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
RESULT_MARK = "予測結果"
ASSISTANT_WORD = "assistant"
TURN_OPEN = "<|im_start|>assistant"
TURN_CLOSE = "<|im_end|>"

# Number patterns, most explicit first.
FIRST_VALUE_PATTERNS = (
    r"予測値:\s*([-+]?\d*\.?\d+)",
    r"値:\s*([-+]?\d*\.?\d+)",
    r"([-+]?\d+\.\d+)",
    r"([-+]?\d+)",
)
LAST_VALUE_PATTERNS = (
    r"予測値[:：]\s*([-+]?\d+\.?\d*)",
    r"次の値[:：]\s*([-+]?\d+\.?\d*)",
    r"予測[:：]\s*([-+]?\d+\.?\d*)",
    r"([-+]?\d+\.?\d*)",
)
RESULT_PATTERN = r"予測結果[（\(](\d+)点[）\)][:：]?\s*(?:```\s*)?([\d.,\s-]+)"
# The list pattern repeats a group; possessive repeats match the same text and
# keep the Java matcher from recursing once per number on very long lists.
LIST_PATTERN = r"([\d.]++(?:\s*+,\s*+[\d.]++)++)"
ANY_NUMBER_PATTERN = r"[-+]?\d*\.?\d+"
INSTRUCTION_NUMBER_PATTERN = r"[-+]?\d*\.\d+|\d+"

# Reward per language, and for every other language.
LANGUAGE_REWARDS = {"ja": 5.0, "en": -3.0, "zh": -3.0}
OTHER_LANGUAGE_REWARD = -5.0
UNDETERMINED = "und"

# Layout of the transformer-temperature series.
ETT_COLUMNS = ("date", "HUFL", "HULL", "MUFL", "MULL", "LUFL", "LULL", "OT")
ETT_ROW_COUNTS = (17520, 69680, 70080)
ROWS_PER_MONTH = 730
