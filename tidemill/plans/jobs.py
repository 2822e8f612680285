"""End-to-end jobs, each a chain of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import parsing as parse
from tidemill.functions.wording import UNDETERMINED
from tidemill.operators import clean, completions, language, metrics, render, scale, split
from tidemill.operators.index import series_index
from tidemill.operators.windows import default_stride, window_counts
from tidemill.plans.sizing import PERCENTILE_LIMIT, attach, join_on, largest_group, materialize
from tidemill.sources import io


def preprocess(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    timestamp: str = "timestamp",
    columns: Sequence[str] = ("value",),
    method: str = "minmax_guarded",
    strict: bool = True,
    **options,
) -> DataFrame:
    """Fill, drop copies, add calendar features, scale: in this order."""
    if method not in ("minmax_guarded", "standard_guarded"):
        raise ValueError(f"unknown scaling method: {method}")
    out = clean.clean(df, order_by, keys, **options)
    out = clean.calendar_features(out, timestamp, strict)
    return scale.scale(out, method, columns, keys) if columns else out


def preprocess_csv(spark: SparkSession, source: str, target: str, schema: str = io.SERIES_SCHEMA, **options) -> DataFrame:
    """Read, :func:`preprocess`, write; returns the written table."""
    df = io.read_series_csv(spark, source, schema)
    timestamp = options.setdefault("timestamp", df.columns[0])
    options.setdefault("order_by", [timestamp])
    out = preprocess(df, **options)
    io.write_csv(out, target)
    return spark.read.schema(out.schema).option("header", True).csv(target)


def scale_and_split(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    columns: Sequence[str] = ("OT",),
    method: str = "minmax",
    fit_on: str = "all",
    train_months: int = 12,
    val_months: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """(scaled rows with ``split``, parameter table) of a multivariate series.

    By default the parameters see the whole series, test rows included.
    """
    indexed = split.month_split(series_index(df, order_by, keys), "pos", train_months, val_months)
    params = scale.fit_scaler(indexed, method, columns, keys, fit_on)
    return scale.apply_scaler(indexed, params, columns, keys), params


def write_scaled_split(scaled: DataFrame, params: DataFrame, folder: str, name: str) -> None:
    io.write_split(scaled.drop("pos"), f"{folder}/{name}", "csv")
    io.write_scaler(params, f"{folder}/{name}_scaler")


def build_dataset(
    df: DataFrame,
    length: int,
    horizon: int,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    stride: int | None = None,
    train_ratio: float = 0.8,
    purge: bool = False,
    **options,
) -> DataFrame:
    """Samples with their train/val split; sample counts follow from row counts."""
    samples = render.build_samples(df, length, horizon, order_by, keys, stride, **options)
    sizes = window_counts(df, length, horizon, stride, keys)
    step = default_stride(horizon) if stride is None else stride
    return split.ratio_split(samples, train_ratio, keys=keys, purge=purge, window=length + horizon, sizes=sizes, stride=step)


def training_set(samples: DataFrame, keep: Sequence[str] = (), chat: bool = True, drop_long: bool = True, length: str | None = None) -> DataFrame:
    """Training records without the longest prompts."""
    kept = [*keep, length] if length else list(keep)
    records = render.training_records(samples, kept, chat)
    return render.drop_long_prompts(records, length=length) if drop_long else records


def score(completion_table: DataFrame, samples: DataFrame, advantage: bool = True, profile: DataFrame | None = None, **options) -> DataFrame:
    """Completions with truth, rewards and group-relative advantage.

    Without a language column the contents are labelled: by a trigram ``profile``,
    or by their script alone, which raises on contents it cannot tell.
    """
    told = completions.normalize_content(completion_table)
    lang, names = options.get("lang", "lang"), options.get("functions")
    if lang not in told.columns and (names is None or "format_and_language_reward_func" in names):
        told = label_contents(told, profile, lang)
    # Truths are one row per sample, so the join leaves the group sizes as they are.
    largest = largest_group(completion_table, ["sample_id"])
    joined = completions.join_truth(told, samples, largest=largest)
    scored = completions.score_completions(joined, **options)
    return completions.group_advantage(scored, largest=largest) if advantage else scored


def label_contents(told: DataFrame, profile: DataFrame | None = None, label: str = "lang") -> DataFrame:
    """Completions with the language of their content."""
    ids = ["sample_id", "generation_id"]
    if profile is not None:
        return join_on(told, language.label_language(told, profile, ids, "content", label), ids, "left")
    text = F.col("content")
    none = F.when(text.isNull() | ~text.rlike(r"\p{L}"), F.lit(UNDETERMINED))
    unknown = F.raise_error(F.lit("contents without a language column need a language profile")).cast("string")
    return told.withColumn(label, F.coalesce(language.script_label(text), none, unknown))


def forecast_frame(rolling: DataFrame, completion_table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rolling windows with the value parsed from their completion (NULL if none)."""
    responses = completion_table.select(*on, F.col("content").alias("response"))
    out = join_on(rolling, responses, on, "left")
    return out.withColumn("predicted", parse.first_value(F.col("response")))


def forecast_report(rolling: DataFrame, completion_table: DataFrame, on: Sequence[str], keys: Sequence[str] = (), **options) -> dict[str, DataFrame]:
    """Windows and their completions to parsed forecasts and the reports of :func:`evaluate`, in one job."""
    return evaluate(forecast_frame(rolling, completion_table, on), keys, on, **options)


def evaluate(
    predictions: DataFrame, keys: Sequence[str] = (), id_columns: Sequence[str] = ("index",), bins: int = 30,
    strategy: str = "auto", plain_limit: int = PERCENTILE_LIMIT,
) -> dict[str, DataFrame]:
    """Metrics, error histogram, box summary, report sample and actual range.

    The predictions are evaluated once and stored. One aggregate gives metrics, range and the bounds of the errors;
    one more gives, by bin, the counts of the histogram and the parts of the box, which are merged from there.
    """
    keys = list(keys)
    told = materialize(predictions)
    actual, predicted = F.col("actual").cast("double"), F.col("predicted").cast("double")
    ok = metrics.known(actual) & metrics.known(predicted)
    pairs = told.select(*keys, actual.alias("__y"), predicted.alias("__p"), F.when(ok, predicted - actual).alias("__e"))
    truth = F.when(metrics.known(F.col("__y")), F.col("__y"))
    summary = materialize(pairs.groupBy(*keys).agg(
        *metrics.metric_sums(F.col("__y"), F.col("__p")), *metrics.error_bounds(F.min("__e"), F.max("__e")),
        F.min(truth).alias("actual_min"), F.max(truth).alias("actual_max"),
    ))
    bounds = summary.select(*keys, "__lo", "__hi")
    errors = pairs.select(*keys, "__e")
    quartiles = materialize(metrics.error_quartiles(errors, keys, strategy, plain_limit))
    limits = ["__lo", "__hi", "q1", "median", "q3"]
    met = attach(errors, bounds, keys, stored=True)
    met = attach(met, quartiles, keys, stored=True).groupBy(*keys, *limits, metrics.error_bin(bins).alias("bin"))
    parts = materialize(met.agg(F.count("__e").alias("n"), *metrics.box_parts()))
    box = parts.groupBy(*keys, "q1", "median", "q3").agg(
        F.min("whisker_low").alias("whisker_low"), F.max("whisker_high").alias("whisker_high"), F.sum("n_outliers").alias("n_outliers"),
    )
    return {
        "metrics": metrics.metric_rows(summary, keys, "evaluator"),
        "histogram": metrics.histogram_rows(bounds, parts.where("bin IS NOT NULL").select(*keys, "bin", "n"), bins, keys),
        "box": metrics.box_rows(box, keys),
        "sample": split.report_sample(told, id_columns),
        "range": summary.select(*keys, "actual_min", "actual_max"),
    }


def evaluation_table(reports: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """The numbers of :func:`evaluate` in one table: (keys, report, name, bin, value)."""
    out = None
    for report in ("metrics", "range", "box", "histogram"):
        df = reports[report]
        names = [c for c in df.columns if c not in (*keys, "bin")]
        place = F.col("bin") if "bin" in df.columns else F.lit(None).cast("int")
        entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names])
        long = df.select(*keys, F.lit(report).alias("report"), place.alias("bin"), F.inline(entries))
        out = long if out is None else out.unionByName(long)
    return out


def write_evaluation(reports: dict[str, DataFrame], folder: str) -> None:
    for name, report in reports.items():
        io.write_csv(report, f"{folder}/{name}")
