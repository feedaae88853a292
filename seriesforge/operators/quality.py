"""Data-quality operators.

Per-column statistics are computed in one aggregation pass and then unpivoted
(``stack``), so a table with k columns costs one scan, not k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.calendar import date_spine
from seriesforge.spec import SeriesSpec


def _stack(cols: list[str], value_exprs: list[str], names=("column", "value")) -> str:
    pairs = ", ".join(f"'{c}', {e}" for c, e in zip(cols, value_exprs))
    return f"stack({len(cols)}, {pairs}) as ({names[0]}, {names[1]})"


def null_report(df: DataFrame, top: int | None = 20, only_missing: bool = True) -> DataFrame:
    """(column, null_count, null_pct) sorted by count desc, name asc."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__c{i}") for i, c in enumerate(cols)])
    long = agg.selectExpr("__n", _stack(cols, [f"__c{i}" for i in range(len(cols))],
                                        ("column", "null_count")))
    long = long.select("column", "null_count",
                       F.try_divide(F.col("null_count") * F.lit(100.0), F.col("__n")).alias("null_pct"))
    if only_missing:
        long = long.where(F.col("null_count") > 0)
    long = long.orderBy(F.desc("null_count"), F.asc("column"))
    return long.limit(top) if top else long


def date_span(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """A10: per series first/last date, span in days, row count."""
    g = df.groupBy(*spec.key_cols) if spec.keys else df
    return g.agg(F.min(spec.time).alias("first_date"), F.max(spec.time).alias("last_date"),
                 F.datediff(F.max(spec.time), F.min(spec.time)).alias("span_days"),
                 F.count(F.lit(1)).alias("n_rows"))


def median_impute(df: DataFrame, spec: SeriesSpec, columns: list[str]) -> DataFrame:
    """NULL -> median of the column within the series. The window is
    per series (bounded by its number of days), never global."""
    p = Window.partitionBy(*spec.key_cols) if spec.keys else Window.partitionBy()
    return df.select(*[F.coalesce(F.col(c).cast("double"),
                                  F.percentile(F.col(c).cast("double"), 0.5).over(p)).alias(c)
                       if c in columns else F.col(c) for c in df.columns])


def completeness(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Q3: per series expected days (first..last), present days, missing days,
    % complete, duplicate keys."""
    k, t = spec.key_cols, spec.time
    per_day = df.groupBy(*k, t).agg(F.count(F.lit(1)).alias("__c"))
    g = per_day.groupBy(*k) if k else per_day
    return g.agg(F.min(t).alias("first_date"), F.max(t).alias("last_date"),
                 (F.datediff(F.max(t), F.min(t)) + 1).cast("long").alias("expected_days"),
                 F.count(F.lit(1)).alias("present_days"),
                 F.count_if(F.col("__c") > 1).alias("duplicate_keys")) \
        .withColumn("missing_days", F.col("expected_days") - F.col("present_days")) \
        .withColumn("pct_complete", F.col("present_days") * F.lit(100.0) / F.col("expected_days"))


def missing_days(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Q3: the calendar days absent inside each series' span (spine anti-join)."""
    k, t = spec.key_cols, spec.time
    bounds = (df.groupBy(*k) if k else df).agg(F.min(t).alias("start"), F.max(t).alias("end"))
    spine = date_spine(bounds, out=t)
    return spine.join(df.select(*k, t).distinct(), [*k, t], "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q3: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def forward_fill(df: DataFrame, spec: SeriesSpec, columns: list[str] | None = None) -> DataFrame:
    """Q4: complete each series to a daily spine and carry the last seen value
    forward (``filled`` = 1 on inserted days)."""
    k, t = spec.key_cols, spec.time
    columns = columns or [c for c in df.columns if c not in (*k, t)]
    bounds = (df.groupBy(*k) if k else df).agg(F.min(t).alias("start"), F.max(t).alias("end"))
    spine = date_spine(bounds, out=t)
    j = spine.join(df.withColumn("__present", F.lit(1)), [*k, t], "left")
    w = (Window.partitionBy(*k) if k else Window.partitionBy()).orderBy(t) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select(*k, t, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in columns],
                    F.when(F.col("__present").isNull(), 1).otherwise(0).alias("filled"))


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """``df`` with the columns of ``one``, an aggregate of one row: an equi-join on a
    constant key, that row being sent to the tasks. Nothing runs before the result does."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(one.withColumn("__one", F.lit(1))), "__one").drop("__one")
