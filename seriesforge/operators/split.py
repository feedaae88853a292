"""Time windows, train/test splits and scaling.

The split cuts on *dates*: the distinct dates are a calendar-sized table (at
most 366 rows per year), ranked once; the cut date joins back to the data as
a one-row table. For one series this equals the reference's positional row
cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.spec import SeriesSpec


def trailing_window(df: DataFrame, spec: SeriesSpec, days: int = 5475) -> DataFrame:
    """Per series keep date >= max(date) - days."""
    p = Window.partitionBy(*spec.key_cols) if spec.keys else Window.partitionBy()
    return (df.withColumn("__mx", F.max(spec.time).over(p))
            .where(F.col(spec.time) >= F.date_sub("__mx", days)).drop("__mx"))


def date_positions(df: DataFrame, time_col: str = "date", train_frac: float = 0.8) -> DataFrame:
    """(date, is_train) for every distinct date; the first
    int(frac * n) dates train. Calendar-sized, joined back on the date."""
    d = df.select(time_col).distinct()
    r = d.select(time_col, F.row_number().over(Window.orderBy(time_col)).alias("__pos"),
                 F.count(F.lit(1)).over(Window.partitionBy()).alias("__n"))
    ntr = F.floor(F.col("__n") * F.lit(float(train_frac)))
    return r.select(time_col, (F.col("__pos") <= ntr).cast("int").alias("is_train"))


def label_split(df: DataFrame, time_col: str = "date", train_frac: float = 0.8) -> DataFrame:
    """Adds ``is_train`` (1/0) by an equi-join on the date."""
    return df.join(date_positions(df, time_col, train_frac), time_col)


def time_split(df: DataFrame, time_col: str = "date", train_frac: float = 0.8):
    """(train, test) DataFrames."""
    lab = label_split(df, time_col, train_frac)
    return (lab.where("is_train = 1").drop("is_train"), lab.where("is_train = 0").drop("is_train"))


def fit_scaler(train: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """population mean and std per column (per group when ``keys``)."""
    keys = keys or []
    g = train.groupBy(*keys) if keys else train
    return g.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__mu") for c in columns],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__sd") for c in columns])


def apply_scaler(df: DataFrame, stats: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """(x - mu) / sd, a zero sd divides by 1 (as scikit-learn does)."""
    keys = keys or []
    if keys:
        j = df.join(stats, keys)
        mu = {c: F.col(f"{c}__mu") for c in columns}
        sd = {c: F.col(f"{c}__sd") for c in columns}
    else:
        # a global scaler is 2 numbers per column: model parameters, kept as literals
        row = stats.first()
        j = df
        mu = {c: F.lit(row[f"{c}__mu"]) for c in columns}
        sd = {c: F.lit(row[f"{c}__sd"]) for c in columns}

    def z(c):
        return ((F.col(c).cast("double") - mu[c]) /
                F.when((sd[c] == 0) | sd[c].isNull(), F.lit(1.0)).otherwise(sd[c])).alias(c)
    return j.select(*[z(c) if c in columns else F.col(c) for c in df.columns])
