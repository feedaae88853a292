"""Scoring outputs and their display tables (M8-M13, J2, J3, J7, W8, W9,
F9-F11, F14, D3, O2, O5, S6, S7).

A forecast table is long and flat: (keys..., origin_date, horizon,
target_date, predicted, [candidate]). Nested documents are built only at the
JSON sink, one per series, with at most ``horizons`` entries each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions import scalar as S
from seriesforge.spec import SeriesSpec

# Interval defaults when metrics are missing.
DEFAULT_MAE = 5.0
DEFAULT_RMSE = 5.5


def last_rows(df: DataFrame, spec: SeriesSpec, n: int = 1) -> DataFrame:
    """O2: the last ``n`` rows of each series by date."""
    w = (Window.partitionBy(*spec.key_cols) if spec.keys else Window.partitionBy()).orderBy(F.desc(spec.time))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def latest_row(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The latest row per series as one aggregate (``max_by``)."""
    from seriesforge.operators.ingest import keep_last
    return keep_last(df, list(spec.key_cols) if spec.keys else [], spec.time)


def date_forecast(preds: DataFrame, origin_col: str = "date", as_of=None) -> DataFrame:
    """Target date = origin + h (or as_of + h - 1), prediction
    rounded to 2 decimals."""
    td = (F.date_add(F.col(origin_col), F.col("horizon")) if as_of is None
          else F.date_add(F.lit(as_of).cast("date"), F.col("horizon") - 1))
    return preds.withColumn("target_date", td).withColumn("predicted", F.round("y_pred", 2))


def attach_context(fc: DataFrame, registry: DataFrame | None = None, exog: DataFrame | None = None,
                   horizon_keys: list[str] | None = None) -> DataFrame:
    """Left lookups of metrics by horizon and of exogenous values by
    target date; missing entries stay NULL."""
    out = fc
    if registry is not None:
        hk = horizon_keys or ["horizon"]
        out = out.join(registry, hk, "left")
    if exog is not None:
        out = out.join(exog.withColumnRenamed("date", "target_date"), "target_date", "left")
    return out


# The longest forecasts that the views allow.
MAX_DAYS, MAX_DAYS_LONG = 7, 16


def first_days(fc: DataFrame, days: int, most: int = MAX_DAYS) -> DataFrame:
    """The forecast limited to its first ``days`` horizons, 1 to ``most``."""
    if not isinstance(days, int) or not 1 <= days <= most:
        raise ValueError(f"days must be within 1..{most}")
    return fc.where(F.col("horizon") <= days)


def next_day(fc: DataFrame, mae_col: str = "mae") -> DataFrame:
    """Horizon 1 with predicted -/+ MAE (default 5.0)."""
    lo, hi = S.interval_bounds("predicted", mae_col, DEFAULT_MAE)
    return fc.where(F.col("horizon") == 1).select("*", lo.alias("lower"), hi.alias("upper"))


def intervals(fc: DataFrame, mae_col: str = "mae") -> DataFrame:
    """D3: 68 % and 95 % bands as -/+ 1.0 and 1.96 MAE."""
    l68, u68 = S.interval_bounds("predicted", mae_col, DEFAULT_MAE, 1.0)
    l95, u95 = S.interval_bounds("predicted", mae_col, DEFAULT_MAE, 1.96)
    return fc.select("*", l68.alias("lower_68"), u68.alias("upper_68"), l95.alias("lower_95"), u95.alias("upper_95"))


def display_rows(doc_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows keyed 'day_<n>' sorted numerically, non-numeric or
    missing predictions dropped."""
    day = F.regexp_extract(F.col("day_key"), r"^day_(\d+)$", 1)
    r = doc_rows.where(F.col("day_key").startswith("day_") & (day != ""))
    r = r.select(*keys, day.cast("int").alias("day"), "day_key", "target_date",
                 F.col("predicted").try_cast("double").alias("prediction"))
    return r.where(F.col("prediction").isNotNull()).orderBy(*keys, "day")


def change_columns(fc: DataFrame, keys: list[str], last_value_col: str = "last_value") -> DataFrame:
    """Change % from the previous horizon's forecast (the first from
    the last known value, NULL when the base is <= 0) and from the last known
    value (0 when missing or 0)."""
    w = Window.partitionBy(*keys).orderBy("horizon") if keys else Window.orderBy("horizon")
    prev = F.coalesce(F.lag("predicted").over(w), F.col(last_value_col))
    return fc.select("*", S.pct_change_positive_base("predicted", prev).alias("change_pct"),
                     S.pct_change_or_zero("predicted", last_value_col).alias("change_vs_last_pct"))


def spread_confidence(preds: DataFrame, keys: list[str]) -> DataFrame:
    """per (keys, horizon) sample std of the candidates' predictions and
    the high/medium/low bucket."""
    g = preds.groupBy(*keys, "horizon").agg(F.stddev_samp("y_pred").alias("spread"),
                                            F.count(F.lit(1)).alias("n_candidates"))
    return g.withColumn("confidence", S.confidence_bucket("spread"))


def history_and_forecast(hist: DataFrame, fc: DataFrame, spec: SeriesSpec, days: int = 90,
                         rmse_col: str = "rmse") -> DataFrame:
    """Last ``days`` actual rows ∪ forecast rows, with kind,
    weekend flag and the -/+ RMSE band (default 5.5) on forecasts."""
    h = last_rows(hist, spec, days).select(*spec.key_cols, F.col(spec.time).alias("date"),
                                           F.col(spec.value).cast("double").alias("value"),
                                           F.lit("actual").alias("kind"),
                                           F.lit(None).cast("double").alias("lower"),
                                           F.lit(None).cast("double").alias("upper"))
    lo, hi = S.interval_bounds("predicted", rmse_col, DEFAULT_RMSE)
    f = fc.select(*spec.key_cols, F.col("target_date").alias("date"), F.col("predicted").alias("value"),
                  F.lit("forecast").alias("kind"), lo.alias("lower"), hi.alias("upper"))
    u = h.unionByName(f)
    return u.withColumn("is_weekend", S.is_weekend("date"))


def forecast_document(fc: DataFrame, last: DataFrame, keys: list[str],
                      metric_cols: list[str] = ("rmse", "mae", "mape", "r2"),
                      weather_cols: list[str] = (), generated_at=None) -> DataFrame:
    """One JSON document per series:
    {[generated_at,] last_known: {date, consumption}, predictions: {day_h: {date,
    predicted, metrics[, weather]}}}. ``last`` holds (keys..., last_date,
    last_value); ``weather_cols`` are the exogenous values of the forecast day."""
    entry = F.struct(F.concat(F.lit("day_"), F.col("horizon").cast("string")).alias("k"),
                     F.struct(F.date_format("target_date", "yyyy-MM-dd").alias("date"),
                              F.col("predicted").alias("predicted"),
                              F.struct(*[F.col(c).alias(c.upper()) for c in metric_cols]).alias("metrics"),
                              *([F.struct(*weather_cols).alias("weather")] if weather_cols else [])
                              ).alias("v"))
    m = fc.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("predictions"))
    d = m.join(last, keys)
    made = [] if generated_at is None else [generated_at.cast("string").alias("generated_at")]
    doc = F.struct(*made, F.struct(F.date_format("last_date", "yyyy-MM-dd").alias("date"),
                            F.col("last_value").alias("consumption")).alias("last_known"),
                   F.col("predictions"))
    return d.select(*keys, F.to_json(doc).alias("document"))


def parse_forecast_document(docs: DataFrame, keys: list[str], doc_col: str = "document") -> DataFrame:
    """S7 read side / F17: document -> flat rows (keys, day_key, date, predicted)."""
    schema = ("struct<last_known: struct<date: string, consumption: double>, "
              "predictions: map<string, struct<date: string, predicted: string, "
              "metrics: map<string, double>>>>")
    p = docs.select(*keys, F.from_json(doc_col, schema).alias("d"))
    e = p.select(*keys, F.col("d.last_known.date").alias("last_date"),
                 F.explode("d.predictions").alias("day_key", "v"))
    return e.select(*keys, "last_date", "day_key", S.tolerant_date(F.col("v.date")).alias("target_date"),
                    F.col("v.predicted").alias("predicted"), F.col("v.metrics").alias("metrics"))
