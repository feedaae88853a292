"""Baselines, metrics and model competition on prediction tables
(A24, D1-D7, W11, M5, M6, M14).

A prediction table is long: (keys..., date, horizon, candidate, y_true,
y_pred). Metrics are plain aggregates (partial per task), so pooling millions
of series costs one small shuffle of per-task partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions import scalar as S
from seriesforge.operators.features import guarded_rolling, series_window
from seriesforge.spec import SeriesSpec

# Baseline candidates in competition order.
BASELINES = ["persistence", "seasonal_naive_7", "moving_average_7"]


def baseline_predictions(df: DataFrame, spec: SeriesSpec, horizons: int = 7,
                         candidates: list[str] = BASELINES, require_truth: bool = True) -> DataFrame:
    """For each origin row t and h = 1..H: persistence y_t, seasonal
    naive y_{t+h-7} (row positions), 7-row mean of y_{t-6..t} (guarded).
    ``target_date`` is the date of the h-th next row. Rows without a
    prediction (and, by default, without a truth) are dropped."""
    w = series_window(spec)
    y = F.col(spec.value)
    # window columns first (one Window node), generator in a second projection
    wide = df.select(*spec.key_cols, spec.time, y.alias("__y"),
                     guarded_rolling(y, 7, w, "avg", lo=-6, hi=0).alias("__ma7"),
                     *[F.lead(y, h).over(w).alias(f"__l{h}") for h in range(1, horizons + 1)],
                     *[F.lead(spec.time, h).over(w).alias(f"__d{h}") for h in range(1, horizons + 1)],
                     *[F.lag(y, k).over(w).alias(f"__g{k}") for k in range(1, 7)])
    items = []
    for h in range(1, horizons + 1):
        preds = {"persistence": F.col("__y"),
                 "seasonal_naive_7": F.col("__y") if h % 7 == 0 else F.col(f"__g{7 - h % 7}"),
                 "moving_average_7": F.col("__ma7")}
        for c in candidates:
            items.append(F.struct(F.lit(h).alias("horizon"), F.lit(c).alias("candidate"),
                                  F.col(f"__d{h}").alias("target_date"),
                                  F.col(f"__l{h}").cast("double").alias("y_true"),
                                  preds[c].cast("double").alias("y_pred")))
    long = wide.select(*spec.key_cols, spec.time, F.inline(F.array(*items)))
    cond = F.col("y_pred").isNotNull()
    if require_truth:
        cond &= F.col("y_true").isNotNull()
    return long.where(cond)


def baseline_forecast(df: DataFrame, spec: SeriesSpec, horizons: int = 7,
                      candidates: list[str] = BASELINES) -> DataFrame:
    """M8 with baselines: predictions made at the last row of each series.
    Only the last 7 rows per series are read into the window (O2)."""
    from seriesforge.operators.forecast import last_rows
    tail = last_rows(df, spec, 7)
    p = baseline_predictions(tail, spec, horizons, candidates, require_truth=False)
    mx = Window.partitionBy(*spec.key_cols) if spec.keys else Window.partitionBy()
    p = p.withColumn("__mx", F.max(spec.time).over(mx)).where(F.col(spec.time) == F.col("__mx")).drop("__mx")
    return p.drop("target_date", "y_true").withColumnRenamed(spec.time, "origin_date")


def metrics(preds: DataFrame, by: list[str]) -> DataFrame:
    """RMSE, MAE, MAPE % (T17), R2 = 1 - SSE / (n * var_pop(y))."""
    e = F.col("y_true") - F.col("y_pred")
    g = preds.groupBy(*by)
    r = g.agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("__mse"), F.avg(F.abs(e)).alias("mae"),
              (F.avg(S.mape_term("y_true", "y_pred")) * F.lit(100.0)).alias("mape"),
              F.sum(e * e).alias("__sse"), F.var_pop("y_true").alias("__vp"))
    return r.select(*by, "n", F.sqrt("__mse").alias("rmse"), "mae", "mape",
                    (F.lit(1.0) - F.try_divide(F.col("__sse"), F.col("n") * F.col("__vp"))).alias("r2"))


def pick_winner(m: DataFrame, by: list[str], order: list[str] = BASELINES,
                metric: str = "rmse") -> DataFrame:
    """Lowest metric per group, ties go to the earlier candidate."""
    pos = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("candidate"))
    w = Window.partitionBy(*by).orderBy(F.col(metric), pos)
    return m.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def promote(new: DataFrame, registry: DataFrame, on: list[str], allow_first: bool = True,
            metric: str = "rmse") -> DataFrame:
    """Per horizon, promote the new model when no entry exists
    (first registration) or when its metric is strictly lower. Returns the
    decision table (on..., old_rmse, new_rmse, promoted, action)."""
    old = registry.select(*on, F.col(metric).alias("old_rmse"))
    j = new.select(*on, F.col(metric).alias("new_rmse"), *[c for c in new.columns
                                                             if c not in (*on, metric)]).join(old, on, "left")
    first = F.col("old_rmse").isNull()
    prom = (first & F.lit(allow_first)) | (~first & (F.col("new_rmse") < F.col("old_rmse")))
    return j.select("*", prom.cast("int").alias("promoted"),
                    F.when(first & F.lit(allow_first), "promoted_first")
                    .when(first, "rejected_unknown")
                    .when(prom, "promoted").otherwise("rejected").alias("action"))


def apply_promotions(registry: DataFrame, decisions: DataFrame, on: list[str],
                     carry: list[str]) -> DataFrame:
    """M6: the next registry version: promoted rows replace or add entries."""
    newrows = decisions.where("promoted = 1").select(*on, F.col("new_rmse").alias("rmse"), *carry)
    kept = registry.join(newrows.select(*on), on, "left_anti")
    return kept.unionByName(newrows, allowMissingColumns=True)


def missing_horizons(registry: DataFrame, groups: DataFrame, horizons: int = 7,
                     group_cols: list[str] | None = None) -> DataFrame:
    """Horizons 1..H without a production entry, per group."""
    group_cols = group_cols or []
    want = groups.select(*group_cols, F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("horizon"))
    return want.join(registry.select(*group_cols, "horizon"), [*group_cols, "horizon"], "left_anti")


def season_of(date_col) -> F.Column:
    m = F.month(date_col)
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").otherwise("autumn"))


def day_group(date_col) -> F.Column:
    d = F.weekday(date_col)
    return F.when(d <= 3, "mon-thu").when(d == 4, "fri").when(d == 5, "sat").otherwise("sun")


def error_reduction(m: DataFrame, by: list[str], baseline: str = "persistence",
                    metric: str = "mape") -> DataFrame:
    """(baseline - model) / baseline * 100 per group."""
    b = m.where(F.col("candidate") == baseline).select(*by, F.col(metric).alias("__b"))
    j = m.join(b, by, "left")
    return j.select(*by, "candidate", F.col(metric).alias(metric), F.col("__b").alias(f"baseline_{metric}"),
                    F.try_divide(F.col("__b") - F.col(metric), F.col("__b")).alias("__r")) \
        .withColumn("reduction_pct", F.col("__r") * F.lit(100.0)).drop("__r")


def residual_profile(preds: DataFrame, by: list[str]) -> DataFrame:
    """Mean error, skewness, excess kurtosis, Jarque-Bera of residuals."""
    e = (F.col("y_true") - F.col("y_pred"))
    r = preds.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(e).alias("mean_error"),
                               F.skewness(e).alias("skewness"), F.kurtosis(e).alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0)
    return r.select("*", jb.alias("jarque_bera"), F.exp(-jb / 2.0).alias("jb_pvalue"))


def expanding_folds(preds: DataFrame, time_col: str = "date", first_val_year: int | None = None) -> DataFrame:
    """fold = validation year Y (training would use years < Y); returns
    preds restricted to each fold's validation year with a ``fold`` column.
    Every row lands in exactly one fold (its own year), so this is a filter,
    not a fan-out."""
    y = F.year(time_col)
    p = preds.withColumn("fold", y)
    if first_val_year is not None:
        p = p.where(F.col("fold") >= first_val_year)
    return p


def fold_summary(fold_metrics: DataFrame, by: list[str], metric: str = "rmse") -> DataFrame:
    """Mean / sample std / min / max of a metric over folds."""
    v = F.col(metric)
    return fold_metrics.groupBy(*by).agg(F.count(v).alias("n_folds"), F.avg(v).alias(f"{metric}_mean"),
                                         F.stddev_samp(v).alias(f"{metric}_std"),
                                         F.min(v).alias(f"{metric}_min"), F.max(v).alias(f"{metric}_max"))
