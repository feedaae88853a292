"""Feature derivation.

All windowed columns share one (keys, date) window spec, so the whole feature
step is one exchange on the series keys and one sort, whatever the number of
lags. Shifts are by row position (T5), rolling statistics need ``w`` non-null
values in the ``w`` previous rows (T3), targets come from the raw value and
lags from the clipped one (T14).

Scale note: the step runs on the daily panel, i.e. after the raw rows were
reduced by a partial aggregation to one row per (series, day). A series holds
at most one row per calendar day, so even a series that owned a third of the
raw rows is a few thousand rows here - the window never sees raw skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions import scalar as S
from seriesforge.functions.calendar import holiday_flags
from seriesforge.operators import ranks
from seriesforge.spec import SeriesSpec

# Feature parameters of the reference configuration.
LAGS = [1, 2, 3, 7, 14, 30]
ROLLING_MEAN_WINDOWS = [3, 7, 14, 30]
ROLLING_STD_WINDOWS = [7, 30]
DIFFS = [7, 30]
HORIZONS = 7
TARGET_PREFIX = "target_next_day_"
# Weather feature aliases (new name, source column).
WEATHER_ALIASES = [
    ("temp", "temperature_2m_mean"),
    ("humidity", "relative_humidity_2m_mean"),
    ("rain_amount", "precipitation_sum"),
    ("wind_speed", "wind_speed_10m_mean"),
    ("solar_radiation", "shortwave_radiation_sum"),
]


def series_window(spec: SeriesSpec):
    if not spec.keys:
        if not spec.single_series:
            raise ValueError("un-keyed window needs single_series=True")
        return Window.orderBy(spec.time)
    return Window.partitionBy(*spec.key_cols).orderBy(spec.time)


def guarded_rolling(c: Column | str, w: int, wspec, fn: str = "avg",
                    lo: int | None = None, hi: int = -1) -> Column:
    """Rolling statistic over rows [lo, hi] (default the ``w`` previous rows)
    that is NULL unless all ``w`` rows hold a value (pandas ``min_periods=w``)."""
    c = S.col(c)
    lo = -w if lo is None else lo
    f = wspec.rowsBetween(lo, hi)
    n = F.count(c).over(f)
    if fn == "avg":
        # exact (decimal) or double sum, one division: order-independent for
        # decimal inputs, identical to avg() for double inputs.
        val = F.sum(c).over(f).cast("double") / F.lit(float(w))
    else:
        val = {"std": F.stddev_samp, "sum": F.sum}[fn](c).over(f)
    return F.when(n == F.lit(w), val)


def centred_rolling_mean(c, w: int, wspec) -> Column:
    """Pandas ``rolling(w, center=True).mean()``: rows
    [-(w//2), (w-1)//2] with all w present."""
    return guarded_rolling(c, w, wspec, "avg", lo=-(w // 2), hi=(w - 1) // 2)


def target_columns(horizons: int = HORIZONS) -> list[str]:
    return [f"{TARGET_PREFIX}{h}" for h in range(1, horizons + 1)]


def split_features_targets(df: DataFrame, prefix: str = TARGET_PREFIX):
    """(feature columns, target columns) by name prefix."""
    t = [c for c in df.columns if c.startswith(prefix)]
    return [c for c in df.columns if c not in t], t


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    num = ("double", "float", "integer", "long", "short", "byte", "decimal")
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in num and f.name not in set(exclude)]


def build_features(base: DataFrame, spec: SeriesSpec, *, training: bool = True,
                   horizons: int = HORIZONS, lags=LAGS, mean_windows=ROLLING_MEAN_WINDOWS,
                   std_windows=ROLLING_STD_WINDOWS, diffs=DIFFS, calendar: DataFrame | None = None,
                   holidays: bool = True, fill_means: bool = True) -> DataFrame:
    """The reference feature table, per series.

    ``training=True`` adds ``target_next_day_1..h`` and keeps only rows with
    all targets (P5); ``False`` keeps every row (production table).
    ``calendar`` may be any (date, name) holiday table.
    """
    keys, t, y = spec.key_cols, spec.time, spec.value
    w = series_window(spec)
    targets = target_columns(horizons) if training else []

    # Targets from the raw value, before clipping.
    cols = [F.col(c) for c in base.columns]
    cols += [F.lead(y, h).over(w).alias(f"{TARGET_PREFIX}{h}") for h in range(1, horizons + 1)] \
        if training else []
    df = base.select(*cols)

    # Clip numeric columns at 0, except keys, time and targets.
    skip = set(keys) | {t} | set(targets)
    to_clip = set(numeric_columns(df, skip))
    df = df.select(*[S.clip_lower(c, 0).alias(c) if c in to_clip else F.col(c) for c in df.columns])

    v = F.col(y)
    feats: list[Column] = []
    feats += [F.lag(v, k).over(w).alias(f"consumption_lag_{k}") for k in lags]
    feats += [guarded_rolling(v, n, w, "avg").alias(f"rolling_mean_{n}") for n in mean_windows]
    feats += [guarded_rolling(v, n, w, "std").alias(f"rolling_std_{n}") for n in std_windows]
    feats += [(v - F.lag(v, n).over(w)).alias(f"trend_{n}days") for n in diffs]

    present = set(df.columns)
    has_weather = all(src in present for _, src in WEATHER_ALIASES)
    if has_weather:
        temp = F.col("temperature_2m_mean")
        rain_flag = S.flag_gt("precipitation_sum", 1.0)
        feats += [temp.alias("temp"), F.lag(temp, 1).over(w).alias("temp_lag_1"),
                  (temp * temp).alias("temp_squared"),
                  F.col("relative_humidity_2m_mean").alias("humidity"),
                  F.col("precipitation_sum").alias("rain_amount"),
                  rain_flag.alias("rain_flag"),
                  F.col("wind_speed_10m_mean").alias("wind_speed"),
                  F.col("shortwave_radiation_sum").alias("solar_radiation"),
                  (temp * rain_flag).alias("temp_x_rain"),
                  (temp * F.col("relative_humidity_2m_mean")).alias("temp_x_humidity"),
                  (temp * F.col("wind_speed_10m_mean")).alias("temp_x_wind")]

    wd = S.weekday0(t)
    mo = F.month(t)
    feats += [wd.alias("weekday"), mo.alias("month"), S.is_weekend(t).alias("is_weekend"),
              S.cyclic_sin(wd, 7).alias("weekday_sin"), S.cyclic_cos(wd, 7).alias("weekday_cos"),
              S.cyclic_sin(mo, 12).alias("month_sin"), S.cyclic_cos(mo, 12).alias("month_cos")]
    df = df.select("*", *feats)

    if holidays:
        df = holiday_flags(df, t, calendar)

    if training:  # P5
        df = df.dropna(how="any", subset=targets)
    if fill_means:
        df = fill_with_means(df, spec, exclude=set(keys) | {t})
    return df


def fill_with_means(df: DataFrame, spec: SeriesSpec, exclude=(), columns=None) -> DataFrame:
    """NULL -> mean of the column within the series (rows present now).

    An unordered window over the series keys reuses the partitioning of the
    feature window, so this adds no exchange.
    """
    cols = set(columns or [f.name for f in df.schema.fields
                           if f.dataType.typeName() in ("double", "float", "decimal")
                           and f.name not in set(exclude)])
    part = ", ".join(f"`{k}`" for k in spec.key_cols)
    over = f"OVER (PARTITION BY {part})" if part else "OVER ()"
    # one selectExpr: a single call into the JVM for all columns
    return df.selectExpr(*[
        f"coalesce(CAST(`{c}` AS DOUBLE), CAST(sum(`{c}`) {over} AS DOUBLE) / count(`{c}`) {over}) AS `{c}`"
        if c in cols else f"`{c}`" for c in df.columns])


def _lag_columns(spec: SeriesSpec, w, lags, leads, mean_windows, std_windows, diffs) -> list[Column]:
    v = F.col(spec.value)
    return [*[F.lag(v, k).over(w).alias(f"lag_{k}") for k in lags],
            *[F.lead(v, h).over(w).alias(f"{TARGET_PREFIX}{h}") for h in leads],
            *[guarded_rolling(v, n, w, "avg").alias(f"rolling_mean_{n}") for n in mean_windows],
            *[guarded_rolling(v, n, w, "std").alias(f"rolling_std_{n}") for n in std_windows],
            *[(v - F.lag(v, n).over(w)).alias(f"trend_{n}days") for n in diffs]]


def lag_features(df: DataFrame, spec: SeriesSpec, lags=LAGS, leads=range(1, HORIZONS + 1),
                 mean_windows=ROLLING_MEAN_WINDOWS, std_windows=ROLLING_STD_WINDOWS,
                 diffs=DIFFS) -> DataFrame:
    """W1-W5 on the bare value column (no clipping, no fill)."""
    return df.select("*", *_lag_columns(spec, series_window(spec), lags, leads, mean_windows, std_windows, diffs))


def lag_features_in_buckets(df: DataFrame, spec: SeriesSpec, bucket_rows: int = 100_000, lags=LAGS,
                            leads=range(1, HORIZONS + 1), mean_windows=ROLLING_MEAN_WINDOWS,
                            std_windows=ROLLING_STD_WINDOWS, diffs=DIFFS) -> DataFrame:
    """W1-W5 for series longer than a task should sort (sub-daily grain): the rows
    of :func:`lag_features`, but windows run over buckets of ``bucket_rows``
    consecutive rows and the few rows around them that the shifts reach. Rows are
    numbered by range partitions, so no window holds a whole series, and
    an un-keyed series is spread as well."""
    back, ahead = max([0, *lags, *mean_windows, *std_windows, *diffs]), max([0, *leads])
    if bucket_rows < max(1, back, ahead):
        raise ValueError("a bucket must hold as many rows as the longest shift")
    rows = ranks.row_positions(df, spec.key_cols, [spec.time], "__position")
    home = F.floor(F.col("__position") / F.lit(bucket_rows)).cast("long")
    place = F.col("__position") % F.lit(bucket_rows)
    # the last rows also go before the next bucket, the first ones behind the bucket before
    copies = F.array_compact(F.array(home, F.when(place >= bucket_rows - back, home + 1), F.when((place < ahead) & (home > 0), home - 1)))
    rows = rows.select("*", home.alias("__home"), F.explode(copies).alias("__bucket"))
    w = Window.partitionBy(*spec.key_cols, "__bucket").orderBy("__position")
    out = rows.select("*", *_lag_columns(spec, w, lags, leads, mean_windows, std_windows, diffs))
    return out.where("__home = __bucket").drop("__position", "__home", "__bucket")


def moving_averages(df: DataFrame, spec: SeriesSpec, windows=(30, 365)) -> DataFrame:
    """Centred moving averages (guarded)."""
    w = series_window(spec)
    return df.select("*", *[centred_rolling_mean(spec.value, n, w).alias(f"ma_{n}")
                            for n in windows])
