"""Named queries over the shared tables, one per operator row of the survey,
each paired with DuckDB SQL that computes the same answer.

A query is ``fn(spark, sf_dir) -> DataFrame``; its output goes through
:func:`out` (doubles rounded, ints widened) and its SQL rounds alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.scalar import round_doubles
from seriesforge.plans import oracle_views as V
from seriesforge.session import cut_lineage
from seriesforge.sources import tables as T
from seriesforge.spec import SeriesSpec

QUERIES: dict = {}
ORACLE: dict = {}
PANEL = SeriesSpec(("series_id",), "date", "y")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def out(df: DataFrame, scale: int = 4, coarse=()) -> DataFrame:
    """Oracle boundary: doubles rounded to ``scale`` (2 for ``coarse``
    columns: sample/population spreads whose last digits depend on the
    summation order), ints widened to bigint."""
    return round_doubles(df, scale, {c: 2 for c in coarse})


# --------------------------------------------------------------------------
# Lags, leads, guarded rolling mean/std, differences per series
# --------------------------------------------------------------------------
from seriesforge.operators import features as FE  # noqa: E402
from seriesforge.operators import ranks as RK  # noqa: E402

_W = "OVER (PARTITION BY series_id ORDER BY date)"
STD_COLS = [f"rolling_std_{w}" for w in FE.ROLLING_STD_WINDOWS]


def _lag_sql(src: str = "daily_panel") -> str:
    cols = ["series_id", "date", V.r("y", "y")]
    cols += [V.r(f"lag(y, {k}) {_W}", f"lag_{k}") for k in FE.LAGS]
    cols += [V.r(f"lead(y, {h}) {_W}", f"target_next_day_{h}") for h in range(1, 8)]
    cols += [V.r(V.guarded("avg", "y", w), f"rolling_mean_{w}") for w in FE.ROLLING_MEAN_WINDOWS]
    cols += [V.r(V.guarded("stddev_samp", "y", w), f"rolling_std_{w}", 2) for w in FE.ROLLING_STD_WINDOWS]
    cols += [V.r(f"y - lag(y, {n}) {_W}", f"trend_{n}days") for n in FE.DIFFS]
    return ",\n  ".join(cols) + f"\nFROM {src}"


@query("w1_w5_lag_rolling_features", V.with_(V.DAILY_PANEL_X) + "SELECT " + _lag_sql())
def q_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(FE.lag_features(T.daily_panel(spark, sf_dir, exact=True), PANEL), coarse=STD_COLS)


@query("w1_w5_lags_of_long_series", V.with_(V.SPARSE_PANEL_X) + "SELECT " + _lag_sql("sparse_panel"))
def q_bucket_lags(spark, sf_dir):
    """W1-W5 on the gappy panel by buckets of 365 rows with the rows around them."""
    return out(FE.lag_features_in_buckets(T.sparse_panel(spark, sf_dir, exact=True), PANEL, bucket_rows=365), coarse=STD_COLS)


@query("w_sparse_panel_lags", V.with_(V.SPARSE_PANEL_X) + "SELECT " + _lag_sql("sparse_panel"))
def q_sparse_lags(spark, sf_dir):
    """T5 on a gappy panel: shifts are by row position, not by calendar."""
    return out(FE.lag_features(T.sparse_panel(spark, sf_dir, exact=True), PANEL), coarse=STD_COLS)


# --------------------------------------------------------------------------
# Full feature table (flagship): J1 + W1-W6 + P8 + F3-F8 + J4/J5 + P5 + A23
# --------------------------------------------------------------------------
from seriesforge.sources.tables import WEATHER_COLUMNS  # noqa: E402

_INT_FEATS = ["rain_flag", "weekday", "month", "is_weekend", "is_holiday", "is_bridge_day"]


def _features_sql(training: bool, rounded: bool = True) -> str:
    wc = WEATHER_COLUMNS
    base = ("base AS (SELECT p.series_id, p.date, p.y, " + ", ".join(f"e.{c}" for c in wc) +
            " FROM daily_panel p JOIN exog_daily e USING (date))")
    tg = [f"target_next_day_{h}" for h in range(1, 8)] if training else []
    t1 = "t1 AS (SELECT *" + "".join(f", lead(y, {h}) {_W} AS target_next_day_{h}" for h in range(1, 8)
                                     if training) + " FROM base)"
    clip = ", ".join(f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}" for c in ["y"] + wc)
    t2 = f"t2 AS (SELECT series_id, date, {clip}" + "".join(f", {t}" for t in tg) + " FROM t1)"
    f = []
    f += [f"lag(y, {k}) {_W} AS consumption_lag_{k}" for k in FE.LAGS]
    f += [f"{V.guarded('avg', 'y', n)} AS rolling_mean_{n}" for n in FE.ROLLING_MEAN_WINDOWS]
    f += [f"{V.guarded('stddev_samp', 'y', n)} AS rolling_std_{n}" for n in FE.ROLLING_STD_WINDOWS]
    f += [f"y - lag(y, {n}) {_W} AS trend_{n}days" for n in FE.DIFFS]
    rf = "CAST(coalesce(precipitation_sum > 1, false) AS INTEGER)"
    f += ["temperature_2m_mean AS temp", f"lag(temperature_2m_mean, 1) {_W} AS temp_lag_1",
          "temperature_2m_mean * temperature_2m_mean AS temp_squared",
          "relative_humidity_2m_mean AS humidity", "precipitation_sum AS rain_amount",
          f"{rf} AS rain_flag", "wind_speed_10m_mean AS wind_speed",
          "shortwave_radiation_sum AS solar_radiation", f"temperature_2m_mean * {rf} AS temp_x_rain",
          "temperature_2m_mean * relative_humidity_2m_mean AS temp_x_humidity",
          "temperature_2m_mean * wind_speed_10m_mean AS temp_x_wind"]
    wd = "(isodow(date) - 1)"
    f += [f"{wd} AS weekday", "month(date) AS month", f"CAST({wd} >= 5 AS INTEGER) AS is_weekend",
          f"sin(6.283185307179586 * {wd} / 7.0) AS weekday_sin",
          f"cos(6.283185307179586 * {wd} / 7.0) AS weekday_cos",
          "sin(6.283185307179586 * month(date) / 12.0) AS month_sin",
          "cos(6.283185307179586 * month(date) / 12.0) AS month_cos"]
    t3 = "t3 AS (SELECT *, " + ", ".join(f) + " FROM t2)"
    t4 = ("t4 AS (SELECT t3.*, coalesce(c.is_holiday, 0) AS is_holiday, "
          "coalesce(c.is_bridge_day, 0) AS is_bridge_day FROM t3 LEFT JOIN cal_flags c USING (date))")
    t5 = "t5 AS (SELECT * FROM t4" + (" WHERE " + " AND ".join(f"{t} IS NOT NULL" for t in tg) if tg else "") + ")"
    frac = (["y"] + wc + tg + [f"consumption_lag_{k}" for k in FE.LAGS] +
            [f"rolling_mean_{n}" for n in FE.ROLLING_MEAN_WINDOWS] +
            [f"rolling_std_{n}" for n in FE.ROLLING_STD_WINDOWS] + [f"trend_{n}days" for n in FE.DIFFS] +
            ["temp", "temp_lag_1", "temp_squared", "humidity", "rain_amount", "wind_speed", "solar_radiation",
             "temp_x_rain", "temp_x_humidity", "temp_x_wind", "weekday_sin", "weekday_cos", "month_sin", "month_cos"])
    p = "OVER (PARTITION BY series_id)"
    sel = ["series_id", "date"]
    filled = {c: f"coalesce(CAST({c} AS DOUBLE), CAST(sum({c}) {p} AS DOUBLE) / count({c}) {p})" for c in frac}
    sel += [V.r(x, c, 2 if c.startswith("rolling_std") else 4) if rounded else f"{x} AS {c}" for c, x in filled.items()]
    sel += [f"CAST({c} AS BIGINT) AS {c}" for c in _INT_FEATS]
    return (V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, base, V.holidays_sql("base"), t1, t2, t3, t4, t5)
            + "SELECT " + ", ".join(sel) + " FROM t5")


def stored_base(spark, sf_dir):
    """The base panel, computed once: training goes over its rows many times, and
    each time would read all orders and all of lineitem again."""
    return cut_lineage(T.base_panel(spark, sf_dir, exact=True))


def features_table(spark, sf_dir, training=True, base=None):
    base = T.base_panel(spark, sf_dir, exact=True) if base is None else base
    return FE.build_features(base, PANEL, training=training)


@query("features_train", _features_sql(True))
def q_features_train(spark, sf_dir):
    """Flagship: the training feature table of every series."""
    return out(features_table(spark, sf_dir, True), coarse=STD_COLS)


@query("features_production", _features_sql(False))
def q_features_production(spark, sf_dir):
    """Production feature table: no targets, every row kept."""
    return out(features_table(spark, sf_dir, False), coarse=STD_COLS)


# --------------------------------------------------------------------------
# Scans, landing, dedupe, pivot, incremental ingest
# --------------------------------------------------------------------------
from seriesforge.operators import ingest as IN  # noqa: E402

# The five series types of the raw long table after F1.
RAW_TYPES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]
UPSERT_CUT = "1998-06-30"
AS_OF = "2001-08-02"


@query("s1_parquet_scan", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderpriority, "
       + V.r("o_totalprice", "o_totalprice") + " FROM orders")
def q_scan(spark, sf_dir):
    """Typed scan, NaN -> NULL, only the projected columns are read."""
    o = T.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    return out(o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                        "o_orderpriority", "o_totalprice"))


@query("s2_i1_high_water_mark", V.with_(V.RAW_LONG) +
       "SELECT type, max(date_query) AS last_date FROM raw_long GROUP BY type")
def q_high_water(spark, sf_dir):
    """S2 + I1: last stored date per type, reading one column (plus key)."""
    return IN.high_water_mark(T.raw_long(spark, sf_dir), "date_query", ["type"], "2010-01-01")


def _row_payloads(raw: DataFrame) -> DataFrame:
    """One JSON array per raw row: the observation (type upper-cased, value as
    a JSON number) plus an object without a type that landing must skip."""
    item = F.struct(F.upper("type").alias("type"), F.col("daily_accumulation").alias("daily_Accumulation"))
    junk = F.struct(F.lit(None).cast("string").alias("type"), F.lit(1.0).alias("daily_Accumulation"))
    return raw.select("date_query", "ingest_seq", F.to_json(F.array(item, junk)).alias("payload"))


@query("s3_row_json_landing", V.with_(V.RAW_LONG) +
       "SELECT date_query, type, " + V.r("daily_accumulation", "daily_accumulation") + ", ingest_seq FROM raw_long")
def q_row_json(spark, sf_dir):
    """S3: JSON arrays of {type, daily_Accumulation} -> long rows."""
    return out(IN.land_row_json(_row_payloads(T.raw_long(spark, sf_dir))))


def _columnar_payloads(exog: DataFrame) -> DataFrame:
    """One {"daily": {"time": [...], <var>: [...]}} document per month (at
    most 31 entries: a calendar bound, not a data bound)."""
    wc = WEATHER_COLUMNS
    g = (exog.groupBy(F.date_format("date", "yyyy-MM").alias("month"))
         .agg(F.array_sort(F.collect_list(F.struct("date", *wc))).alias("rows")))
    def field(c):
        return lambda r: r[c]
    daily = F.struct(F.transform("rows", lambda r: F.date_format(r["date"], "yyyy-MM-dd")).alias("time"),
                     *[F.transform("rows", field(c)).alias(c) for c in wc])
    return g.select("month", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))


@query("s4_columnar_json_landing", V.with_(V.EXOG_DAILY) + "SELECT date, " +
       ", ".join(V.r(c, c) for c in WEATHER_COLUMNS) + " FROM exog_daily")
def q_columnar_json(spark, sf_dir):
    """Columnar JSON documents -> one row per day."""
    docs = _columnar_payloads(T.exog_daily(spark, sf_dir))
    return out(IN.land_columnar_json(docs, WEATHER_COLUMNS))


@query("w10_u2_keep_last", V.with_(V.RAW_LONG) +
       "SELECT date_query, type, " + V.r("arg_max(daily_accumulation, ingest_seq)", "daily_accumulation") +
       ", max(ingest_seq) AS ingest_seq FROM raw_long GROUP BY date_query, type")
def q_keep_last(spark, sf_dir):
    """Latest row per (date, type) by ingest sequence."""
    return out(IN.keep_last(T.raw_long(spark, sf_dir), ["date_query", "type"], "ingest_seq"))


def _pivot_sql(cols_wanted=None) -> str:
    norm = [t.replace(" ", "_") for t in RAW_TYPES]
    wanted = cols_wanted or norm
    piv = ", ".join(V.r(f"max(CASE WHEN type = '{n}' THEN value END)", f'"{n}"') for n in norm if n in wanted)
    return (V.with_(V.RAW_LONG, """dedup AS (
  SELECT date_query AS date, replace(lower(type), ' ', '_') AS type,
         arg_max(daily_accumulation, ingest_seq) AS value
  FROM raw_long WHERE date_query IS NOT NULL AND type IS NOT NULL AND daily_accumulation IS NOT NULL
  GROUP BY 1, 2)""") + f"SELECT date, {piv} FROM dedup GROUP BY date")


@query("a1_pivot_wide", _pivot_sql())
def q_pivot(spark, sf_dir):
    """Long -> wide with a fixed value list."""
    return out(IN.pivot_wide(T.raw_long(spark, sf_dir), RAW_TYPES))


@query("p1_select_available", _pivot_sql(["1-urgent", "3-medium", "5-low"]))
def q_select_available(spark, sf_dir):
    """Keep the expected columns that exist (one expected column is
    absent and only reported), the target is required."""
    wide = IN.pivot_wide(T.raw_long(spark, sf_dir), RAW_TYPES)
    sel, missing = IN.select_available(wide, ["1-urgent", "3-medium", "9-absent", "5-low"],
                                       required=["1-urgent"])
    assert missing == ["9-absent"]
    return out(sel)


def _upsert_parts(spark, sf_dir):
    raw = T.raw_long(spark, sf_dir)
    old = raw.where(F.col("date_query") < F.lit(UPSERT_CUT).cast("date"))
    new = (raw.where(F.col("date_query") >= F.date_sub(F.lit(UPSERT_CUT).cast("date"), 30))
           .select("date_query", "type",
                   F.round(F.col("daily_accumulation").cast("decimal(18,2)") * F.lit(1.01).cast("decimal(3,2)"),
                           2).cast("double").alias("daily_accumulation"),
                   (F.col("ingest_seq") + F.lit(10 ** 12)).alias("ingest_seq")))
    return old, new


_UPSERT_SQL = V.with_(V.RAW_LONG, f"""old AS (SELECT * FROM raw_long WHERE date_query < DATE '{UPSERT_CUT}')""",
                      f"""new AS (SELECT date_query, type, CAST(round(CAST(daily_accumulation AS DECIMAL(18,2)) * 1.01, 2) AS DOUBLE) AS daily_accumulation,
  ingest_seq + 1000000000000 AS ingest_seq FROM raw_long WHERE date_query >= DATE '{UPSERT_CUT}' - INTERVAL 30 DAY)""",
                      "u AS (SELECT * FROM old UNION ALL SELECT * FROM new)")


@query("i3_u1_upsert", _UPSERT_SQL + "SELECT date_query, type, " +
       V.r("arg_max(daily_accumulation, ingest_seq)", "daily_accumulation") +
       ", max(ingest_seq) AS ingest_seq FROM u GROUP BY date_query, type")
def q_upsert(spark, sf_dir):
    """Old union new batch (30 overlapping days, revised values), the
    latest record per key wins."""
    old, new = _upsert_parts(spark, sf_dir)
    return out(IN.upsert(old, new, ["date_query", "type"], "ingest_seq"))


@query("i3_stored_upsert", _UPSERT_SQL + "SELECT date_query, type, " +
       V.r("arg_max(daily_accumulation, ingest_seq)", "daily_accumulation") +
       ", max(ingest_seq) AS ingest_seq FROM u GROUP BY date_query, type")
def q_stored_upsert(spark, sf_dir):
    """I3/U1 on the stored table: two collections into a new month-partitioned
    folder below the shared checkpoint folder, read back."""
    import uuid
    from seriesforge.session import checkpoint_dir
    from seriesforge.sources import store
    path = store.join(checkpoint_dir(spark), f"raw-{uuid.uuid4().hex}")
    for part in _upsert_parts(spark, sf_dir):
        IN.upsert_partitions(spark, path, part, ["date_query", "type"], "ingest_seq")
    return out(spark.read.parquet(path).drop("month"))


@query("i2_delta_after_mark", V.with_(V.RAW_LONG, f"old AS (SELECT * FROM raw_long WHERE date_query < DATE '{UPSERT_CUT}')")
       + "SELECT date_query, type, " + V.r("daily_accumulation", "daily_accumulation") + ", ingest_seq FROM raw_long "
       f"WHERE date_query > (SELECT max(date_query) FROM old) AND date_query <= DATE '{AS_OF}'")
def q_delta(spark, sf_dir):
    """Rows after the stored high-water mark, up to the end date. The mark
    is a scalar subquery, so no join is planned."""
    raw = T.raw_long(spark, sf_dir)
    old = raw.where(F.col("date_query") < F.lit(UPSERT_CUT).cast("date"))
    mark = old.agg(F.max("date_query")).scalar()
    return out(IN.delta_after(raw, "date_query", mark, F.lit(AS_OF).cast("date")))


@query("i4_freshness", V.with_(V.RAW_LONG, V.EXOG_DAILY) + f"""
SELECT stage, last_date, CAST(DATE '{AS_OF}' - INTERVAL 1 DAY AS DATE) AS expected,
       CAST(coalesce(last_date <> CAST(DATE '{AS_OF}' - INTERVAL 1 DAY AS DATE), true) AS BIGINT) AS stale
FROM (SELECT 'raw' AS stage, max(date_query) AS last_date FROM raw_long
      UNION ALL SELECT 'exogenous', max(date) FROM exog_daily)""")
def q_freshness(spark, sf_dir):
    """I4: is the last stored date of each stage the day before ``as_of``."""
    raw = T.raw_long(spark, sf_dir).withColumnRenamed("date_query", "date")
    return out(IN.freshness({"raw": raw, "exogenous": T.exog_daily(spark, sf_dir)}, "date", AS_OF))


@query("j1_base_join", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY) + "SELECT p.series_id, p.date, " + V.r("p.y", "y") + ", " +
       ", ".join(V.r(f"e.{c}", c) for c in WEATHER_COLUMNS) + " FROM daily_panel p JOIN exog_daily e USING (date)")
def q_base_join(spark, sf_dir):
    """Panel inner-joined with the per-date exogenous table."""
    return out(T.base_panel(spark, sf_dir, exact=True))


@query("d8_hourly_to_daily", V.with_(V.HOURLY) + "SELECT CAST(hour_ts AS DATE) AS date, "
       "CAST(sum(n_events) AS BIGINT) AS n_events, " + V.r("sum(CAST(value_sum AS DECIMAL(18,2)))", "value_sum") +
       " FROM hourly GROUP BY 1")
def q_hourly_daily(spark, sf_dir):
    """Hourly readings summed to days."""
    h = T.hourly(spark, sf_dir)
    return out(h.groupBy(F.to_date("hour_ts").alias("date"))
               .agg(F.sum("n_events").alias("n_events"),
                    F.sum(F.col("value_sum").cast("decimal(18,2)")).alias("value_sum")))


# --------------------------------------------------------------------------
# Calendar, scalar functions
# --------------------------------------------------------------------------
from seriesforge.functions import calendar as CAL  # noqa: E402
from seriesforge.functions import scalar as S  # noqa: E402


@query("c1_holiday_calendar", V.with_(V.DAILY_PANEL_X, V.holidays_sql("daily_panel")) + "SELECT date, name FROM holidays")
def q_holidays(spark, sf_dir):
    """National holidays for the data's years (plus one on each side)."""
    return CAL.holiday_calendar(CAL.years_of(T.daily_panel(spark, sf_dir), "date"))


@query("j4_j5_holiday_flags", V.with_(V.DAILY_SINGLE_X, V.holidays_sql("daily_single")) +
       "SELECT d.date, CAST(coalesce(c.is_holiday, 0) AS BIGINT) AS is_holiday, "
       "CAST(coalesce(c.is_bridge_day, 0) AS BIGINT) AS is_bridge_day FROM daily_single d LEFT JOIN cal_flags c USING (date)")
def q_holiday_flags(spark, sf_dir):
    """Holiday and bridge-day flags by one broadcast lookup."""
    d = T.daily_single(spark, sf_dir, exact=True)
    return out(CAL.holiday_flags(d, "date").select("date", "is_holiday", "is_bridge_day"))


@query("c2_date_spine", V.with_(V.DAILY_PANEL_X) +
       "SELECT series_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date "
       "FROM daily_panel GROUP BY series_id")
def q_spine(spark, sf_dir):
    """Inclusive daily spine per series."""
    p = T.daily_panel(spark, sf_dir)
    b = p.groupBy("series_id").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return CAL.date_spine(b)


_WD = "(isodow(date) - 1)"


@query("f3_f5_calendar_parts", V.with_(V.DAILY_SINGLE_X) + f"""SELECT date, CAST(year(date) AS BIGINT) AS year,
  CAST(month(date) AS BIGINT) AS month, CAST({_WD} AS BIGINT) AS weekday, dayname(date) AS day_name,
  CAST({_WD} >= 5 AS BIGINT) AS is_weekend,
  {V.r(f"sin(6.283185307179586 * {_WD} / 7.0)", "weekday_sin")}, {V.r(f"cos(6.283185307179586 * {_WD} / 7.0)", "weekday_cos")},
  {V.r("sin(6.283185307179586 * month(date) / 12.0)", "month_sin")}, {V.r("cos(6.283185307179586 * month(date) / 12.0)", "month_cos")}
FROM daily_single""")
def q_calendar_parts(spark, sf_dir):
    """F3/F4/F5 (T8: Monday = 0)."""
    d = T.daily_single(spark, sf_dir)
    wd = S.weekday0("date")
    return out(d.select("date", F.year("date").alias("year"), F.month("date").alias("month"), wd.alias("weekday"),
                        S.day_name("date").alias("day_name"), S.is_weekend("date").alias("is_weekend"),
                        S.cyclic_sin(wd, 7).alias("weekday_sin"), S.cyclic_cos(wd, 7).alias("weekday_cos"),
                        S.cyclic_sin(F.month("date"), 12).alias("month_sin"),
                        S.cyclic_cos(F.month("date"), 12).alias("month_cos")))


@query("f7_f8_f12_p8_exog_scalars", V.with_(V.EXOG_DAILY) + f"""SELECT date,
  CAST(coalesce(precipitation_sum > 1, false) AS BIGINT) AS rain_flag,
  CASE WHEN coalesce(precipitation_sum, 0) > 5 THEN 'Rain' WHEN coalesce(precipitation_sum, 0) > 0 THEN 'Clouds' ELSE 'Clear' END AS condition,
  {V.r("temperature_2m_mean * temperature_2m_mean", "temp_squared")},
  {V.r("temperature_2m_mean * CAST(coalesce(precipitation_sum > 1, false) AS INTEGER)", "temp_x_rain")},
  {V.r("temperature_2m_mean * relative_humidity_2m_mean", "temp_x_humidity")},
  {V.r("temperature_2m_mean * wind_speed_10m_mean", "temp_x_wind")},
  {V.r("CASE WHEN temperature_2m_min - 5.0 < 0 THEN 0 ELSE temperature_2m_min - 5.0 END", "clipped_min")}
FROM exog_daily""")
def q_exog_scalars(spark, sf_dir):
    """F7 products, F8 rain flag (T9), F12 condition text, P8 clip."""
    e = T.exog_daily(spark, sf_dir)
    t = F.col("temperature_2m_mean")
    rf = S.flag_gt("precipitation_sum", 1.0)
    return out(e.select("date", rf.alias("rain_flag"), S.weather_condition("precipitation_sum").alias("condition"),
                        (t * t).alias("temp_squared"), (t * rf).alias("temp_x_rain"),
                        (t * F.col("relative_humidity_2m_mean")).alias("temp_x_humidity"),
                        (t * F.col("wind_speed_10m_mean")).alias("temp_x_wind"),
                        S.clip_lower(F.col("temperature_2m_min") - F.lit(5.0), 0).alias("clipped_min")))


@query("f16_f17_time_and_json", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
  strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_text,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_time_json(spark, sf_dir):
    """F16 ISO text -> timestamp -> hour; F17 JSON field extraction."""
    e = T.read_table(spark, sf_dir, "events", ["event_id", "ts", "props"])
    txt = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = F.to_timestamp_ntz(txt, F.lit("yyyy-MM-dd HH:mm:ss"))
    return e.select("event_id", txt.alias("ts_text"),
                    F.date_format(F.date_trunc("hour", parsed), "yyyy-MM-dd HH:mm:ss").alias("hour_text"),
                    F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("w7_centred_moving_averages", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, date, " + V.r("y", "y") + ", " +
       V.r(V.guarded("avg", "y", 30, lo=-15, hi=14), "ma_30") + ", " +
       V.r(V.guarded("avg", "y", 365, lo=-182, hi=182), "ma_365") + " FROM daily_panel")
def q_moving_avg(spark, sf_dir):
    """Centred 30- and 365-row means (all rows present), per series."""
    return out(FE.moving_averages(T.daily_panel(spark, sf_dir, exact=True), PANEL))


# --------------------------------------------------------------------------
# Profiling (per series)
# --------------------------------------------------------------------------
from seriesforge.operators import profile as PR  # noqa: E402
from seriesforge.operators import quality as QU  # noqa: E402


def _panel(spark, sf_dir):
    return T.daily_panel(spark, sf_dir, exact=True)


def _mean_sql(expr: str, cond: str | None = None) -> str:
    f = f" FILTER (WHERE {cond})" if cond else ""
    return f"CAST(sum({expr}){f} AS DOUBLE) / count({expr}){f}"


@query("a2_year_month_pivot", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, CAST(year(date) AS BIGINT) AS year, " +
       ", ".join(V.r(_mean_sql("y", f"month(date) = {m}"), f"m{m:02d}") for m in range(1, 13)) +
       " FROM daily_panel GROUP BY 1, 2")
def q_year_month(spark, sf_dir):
    """A2: year x month mean."""
    return out(PR.year_month_pivot(_panel(spark, sf_dir), PANEL))


@query("a3_yearly_stats", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, CAST(year(date) AS BIGINT) AS year, " +
       V.r(_mean_sql("y"), "mean") + ", " + V.r("stddev_samp(y)", "std", 2) + ", " + V.r("min(y)", "min") + ", " +
       V.r("max(y)", "max") + ", count(y) AS count FROM daily_panel GROUP BY 1, 2")
def q_yearly(spark, sf_dir):
    """A3"""
    return out(PR.yearly_stats(_panel(spark, sf_dir), PANEL), coarse=["std"])


@query("a4_monthly_means", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, CAST(month(date) AS BIGINT) AS month, " +
       V.r(_mean_sql("y"), "mean") + " FROM daily_panel GROUP BY 1, 2 ORDER BY series_id, mean DESC")
def q_monthly(spark, sf_dir):
    """A4"""
    return out(PR.monthly_means(_panel(spark, sf_dir), PANEL))


@query("a5_weekday_profile", V.with_(V.DAILY_PANEL_X) + f"SELECT series_id, CAST({_WD} AS BIGINT) AS weekday, "
       "dayname(date) AS day_name, " + V.r(_mean_sql("y"), "mean") + ", " + V.r("stddev_samp(y)", "std", 2) +
       ", count(y) AS count FROM daily_panel GROUP BY 1, 2, 3")
def q_weekday(spark, sf_dir):
    """A5: Monday first."""
    return out(PR.weekday_profile(_panel(spark, sf_dir), PANEL), coarse=["std"])


@query("a6_weekend_effect", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, " +
       V.r(_mean_sql("y", f"{_WD} < 5"), "weekday_mean") + ", " + V.r(_mean_sql("y", f"{_WD} >= 5"), "weekend_mean") +
       ", " + V.r(f"({_mean_sql('y', f'{_WD} < 5')} - {_mean_sql('y', f'{_WD} >= 5')}) / ({_mean_sql('y', f'{_WD} < 5')}) * 100.0",
                  "weekend_reduction_pct") + " FROM daily_panel GROUP BY 1")
def q_weekend(spark, sf_dir):
    """A6"""
    return out(PR.weekend_effect(_panel(spark, sf_dir), PANEL))


@query("a7_scalar_profile", V.with_(V.DAILY_PANEL_X, """s AS (SELECT series_id,
  CAST(sum(y) AS DOUBLE) / count(y) AS mean, quantile_cont(CAST(y AS DOUBLE), 0.5) AS median,
  stddev_samp(y) AS std, CAST(min(y) AS DOUBLE) AS min, CAST(max(y) AS DOUBLE) AS max, count(y) AS count
  FROM daily_panel GROUP BY 1)""") + "SELECT series_id, " + ", ".join(
    [V.r("mean", "mean"), V.r("median", "median"), V.r("std", "std", 2), V.r("min", "min"), V.r("max", "max"),
     "count", V.r("max - min", "range"), V.r("std / mean * 100.0", "cv_pct"), V.r("min / mean - 1.0", "min_rel"),
     V.r("max / mean - 1.0", "max_rel")]) + " FROM s")
def q_scalar_profile(spark, sf_dir):
    """One aggregation per series."""
    return out(PR.scalar_profile(_panel(spark, sf_dir), PANEL), coarse=["std"])


_DESCRIBE_COLS = ["y"] + WEATHER_COLUMNS


@query("a8_describe", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, "b AS (SELECT p.series_id, p.date, p.y, e.* EXCLUDE (date) "
       "FROM daily_panel p JOIN exog_daily e USING (date))",
       "l AS (" + " UNION ALL ".join(f"SELECT series_id, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value, "
                                     f"CAST({c} AS DECIMAL(38,10)) AS dvalue FROM b" for c in _DESCRIBE_COLS) + ")") +
       'SELECT series_id, "column", count(value) AS count, ' + ", ".join(
           [V.r("CAST(sum(dvalue) AS DOUBLE) / count(dvalue)", "mean"), V.r("stddev_samp(value)", "std", 2), V.r("min(value)", "min"),
            V.r("quantile_cont(value, 0.25)", "p25"), V.r("quantile_cont(value, 0.5)", "p50"),
            V.r("quantile_cont(value, 0.75)", "p75"), V.r("max(value)", "max")]) + ' FROM l GROUP BY 1, 2')
def q_describe(spark, sf_dir):
    """describe() of the numeric columns of the base table, per series."""
    return out(PR.describe(T.base_panel(spark, sf_dir, exact=True), PANEL, _DESCRIBE_COLS), coarse=["std"])


def _lag_table(spark, sf_dir):
    return FE.lag_features(_panel(spark, sf_dir), PANEL)


_LAG_COLS = (["series_id", "date", "y"] + [f"lag_{k}" for k in FE.LAGS] + [f"target_next_day_{h}" for h in range(1, 8)]
             + [f"rolling_mean_{w}" for w in FE.ROLLING_MEAN_WINDOWS] + [f"rolling_std_{w}" for w in FE.ROLLING_STD_WINDOWS]
             + [f"trend_{n}days" for n in FE.DIFFS])
def _raw_lag_sql() -> str:
    cols = ["series_id", "date", "y"]
    cols += [f"lag(y, {k}) {_W} AS lag_{k}" for k in FE.LAGS]
    cols += [f"lead(y, {h}) {_W} AS target_next_day_{h}" for h in range(1, 8)]
    cols += [f"{V.guarded('avg', 'y', w)} AS rolling_mean_{w}" for w in FE.ROLLING_MEAN_WINDOWS]
    cols += [f"{V.guarded('stddev_samp', 'y', w)} AS rolling_std_{w}" for w in FE.ROLLING_STD_WINDOWS]
    cols += [f"y - lag(y, {n}) {_W} AS trend_{n}days" for n in FE.DIFFS]
    return ", ".join(cols) + " FROM daily_panel"


_LAG_CTE = "lf AS (SELECT " + _raw_lag_sql() + ")"


@query("a9_q1_null_report", V.with_(V.DAILY_PANEL_X, _LAG_CTE, "n AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS n FROM lf"
    for c in _LAG_COLS) + ")") + 'SELECT "column", null_count, ' + V.r("null_count * 100.0 / n", "null_pct") +
    ' FROM n WHERE null_count > 0 ORDER BY null_count DESC, "column" LIMIT 20')
def q_null_report(spark, sf_dir):
    """Null count and % per column, top 20."""
    return out(QU.null_report(_lag_table(spark, sf_dir), 20))


@query("a10_date_span", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, min(date) AS first_date, max(date) AS last_date, "
       "CAST(datediff('day', min(date), max(date)) AS BIGINT) AS span_days, count(*) AS n_rows FROM daily_panel GROUP BY 1")
def q_date_span(spark, sf_dir):
    """A10"""
    return out(QU.date_span(_panel(spark, sf_dir), PANEL))


@query("a11_iqr_outliers", V.with_(V.DAILY_PANEL_X, """q AS (SELECT series_id, count(y) AS n,
  quantile_cont(CAST(y AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(y AS DOUBLE), 0.75) AS q3 FROM daily_panel GROUP BY 1)""",
  "b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)",
  """c AS (SELECT b.*, count(*) FILTER (WHERE CAST(p.y AS DOUBLE) < b.lower_bound) AS n_low,
  count(*) FILTER (WHERE CAST(p.y AS DOUBLE) > b.upper_bound) AS n_high FROM b JOIN daily_panel p USING (series_id)
  GROUP BY ALL)""") + "SELECT series_id, n, " + ", ".join(V.r(c, c) for c in ["q1", "q3", "iqr", "lower_bound", "upper_bound"])
    + ", n_low, n_high, n_low + n_high AS n_outliers, " + V.r("n_low * 100.0 / n", "pct_low") + ", " +
    V.r("n_high * 100.0 / n", "pct_high") + ", " + V.r("(n_low + n_high) * 100.0 / n", "pct_outliers") + " FROM c")
def q_iqr(spark, sf_dir):
    """A11"""
    return out(PR.iqr_outliers(_panel(spark, sf_dir), PANEL))


@query("a12_zscore_outliers", V.with_(V.DAILY_PANEL_X, """z AS (SELECT series_id,
  abs(CAST(y AS DOUBLE) - avg(CAST(y AS DOUBLE)) OVER (PARTITION BY series_id)) / stddev_pop(CAST(y AS DOUBLE)) OVER (PARTITION BY series_id) AS z
  FROM daily_panel)""") + "SELECT series_id, count(*) AS n, count(*) FILTER (WHERE z > 3.0) AS n_outliers, " +
    V.r("count(*) FILTER (WHERE z > 3.0) * 100.0 / count(*)", "pct_outliers") + " FROM z GROUP BY 1")
def q_zscore(spark, sf_dir):
    """A12 (population std)."""
    return out(PR.zscore_outliers(_panel(spark, sf_dir), PANEL))


_MOMENTS = """m AS (SELECT series_id, count(x) AS n, avg(x) AS mu FROM src GROUP BY 1),
c AS (SELECT s.series_id, m.n, avg((x - mu) * (x - mu)) AS m2, avg((x - mu) * (x - mu) * (x - mu)) AS m3,
  avg((x - mu) * (x - mu) * (x - mu) * (x - mu)) AS m4 FROM src s JOIN m USING (series_id) GROUP BY 1, 2),
k AS (SELECT series_id, n, m3 / pow(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3.0 AS kurtosis FROM c),
j AS (SELECT *, n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4.0) AS jb FROM k)"""


@query("a13_a21_shape_normality", V.with_(V.DAILY_PANEL_X, "src AS (SELECT series_id, CAST(y AS DOUBLE) AS x FROM daily_panel)",
                                           _MOMENTS) + """SELECT series_id, n, """ +
       V.r("skewness", "skewness") + ", " + V.r("kurtosis", "kurtosis") + """,
  CASE WHEN abs(skewness) < 0.5 THEN 'Fairly symmetric' WHEN skewness > 0 THEN 'Right-skewed' ELSE 'Left-skewed' END AS skew_label,
  CASE WHEN abs(kurtosis) < 0.5 THEN 'Normal tails' WHEN kurtosis > 0 THEN 'Heavy tails' ELSE 'Light tails' END AS kurtosis_label, """
       + V.r("jb", "jarque_bera") + ", " + V.r("exp(-jb / 2.0)", "jb_pvalue") +
       ", CAST(exp(-jb / 2.0) >= 0.05 AS BIGINT) AS is_normal FROM j")
def q_shape(spark, sf_dir):
    """A13 + A21 (Jarque-Bera on the whole series, no sampling)."""
    return out(PR.shape(_panel(spark, sf_dir), PANEL))


_BASE_X = "b AS (SELECT p.series_id, p.date, p.y, e.* EXCLUDE (date) FROM daily_panel p JOIN exog_daily e USING (date))"


@query("a14_f13_target_correlations", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X, "r AS (" + " UNION ALL ".join(
    f"SELECT series_id, '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(y AS DOUBLE)) AS r FROM b GROUP BY 1"
    for c in WEATHER_COLUMNS) + ")", """k AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY abs(r) DESC, feature) AS rank
  FROM r WHERE r IS NOT NULL)""") + """SELECT series_id, feature, """ + V.r("r", "r") + """, rank,
  CASE WHEN abs(r) > 0.7 THEN 'Very Strong' WHEN abs(r) > 0.5 THEN 'Strong' WHEN abs(r) > 0.3 THEN 'Moderate' ELSE 'Weak' END AS strength,
  CASE WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS direction FROM k WHERE rank <= 20""")
def q_target_corr(spark, sf_dir):
    """Pearson r with the target, by |r|, top 20."""
    return out(PR.target_correlations(T.base_panel(spark, sf_dir, exact=True), PANEL, WEATHER_COLUMNS, 20))


_CORR_COLS = ["y", *WEATHER_COLUMNS]


@query("a15_correlation_matrix", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X) + " UNION ALL ".join(
    f"SELECT series_id, '{a}' AS \"row\", '{b}' AS col, " + V.r(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", "r") +
    " FROM b GROUP BY 1" for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[:i]))
def q_corr_matrix(spark, sf_dir):
    """Strict lower triangle of all pairwise correlations, one aggregation."""
    return out(PR.correlation_matrix(T.base_panel(spark, sf_dir, exact=True), PANEL, _CORR_COLS))


_TRENDS_SQL = V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X, "t AS (" + " UNION ALL ".join(
    f"SELECT series_id, '{c}' AS feature, corr(CAST({c} AS DOUBLE), CAST(y AS DOUBLE)) AS r, "
    f"regr_slope(CAST(y AS DOUBLE), CAST({c} AS DOUBLE)) AS slope, regr_intercept(CAST(y AS DOUBLE), CAST({c} AS DOUBLE)) AS intercept, "
    f"CAST(min({c}) AS DOUBLE) AS x_min, CAST(max({c}) AS DOUBLE) AS x_max FROM b GROUP BY 1" for c in WEATHER_COLUMNS) + ")")


@query("a16_exog_trends", _TRENDS_SQL + "SELECT series_id, feature, " +
       ", ".join(V.r(c, c) for c in ["r", "slope", "intercept", "x_min", "x_max"]) + " FROM t")
def q_trends(spark, sf_dir):
    """R, slope, intercept of target ~ each exogenous column; the
    columns are found by keyword in the schema."""
    b = T.base_panel(spark, sf_dir, exact=True)
    cols = PR.find_columns(b, contains=["temperature", "humidity", "precipitation", "wind", "radiation"],
                           numeric_only=True)
    assert cols == WEATHER_COLUMNS
    return out(PR.exog_trends(b, PANEL, cols))


@query("a16_trend_lines", _TRENDS_SQL + """, pts AS (SELECT t.*, unnest(range(0, 100)) AS point FROM t),
xs AS (SELECT *, x_min + (x_max - x_min) * point / 99.0 AS x FROM pts)
SELECT series_id, feature, CAST(point AS BIGINT) AS point, """ + V.r("x", "x") + ", " + V.r("intercept + slope * x", "y_fit", 2) + " FROM xs")
def q_trend_lines(spark, sf_dir):
    """Fitted line at 100 even points per (series, column)."""
    t = PR.exog_trends(T.base_panel(spark, sf_dir, exact=True), PANEL, WEATHER_COLUMNS)
    return out(PR.trend_lines(t, ["series_id"], 100), coarse=["y_fit"])


@query("a17_histogram", V.with_(V.DAILY_PANEL_X, """s AS (SELECT series_id, CAST(y AS DOUBLE) AS v,
  min(CAST(y AS DOUBLE)) OVER (PARTITION BY series_id) AS lo, max(CAST(y AS DOUBLE)) OVER (PARTITION BY series_id) AS hi FROM daily_panel)""",
  """b AS (SELECT series_id, lo, hi, (hi - lo) / 50.0 AS w,
  CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / ((hi - lo) / 50.0)), 49) END AS BIGINT) AS bin FROM s)""",
  """k AS (SELECT series_id, CAST(sum(y) AS DOUBLE) / count(y) AS mean, quantile_cont(CAST(y AS DOUBLE), 0.5) AS median FROM daily_panel GROUP BY 1)""") +
       "SELECT series_id, bin, " + V.r("lo + w * bin", "bin_start") + ", " + V.r("lo + w * (bin + 1)", "bin_end") +
       ", count(*) AS count, " + V.r("mean", "mean") + ", " + V.r("median", "median") +
       " FROM b JOIN k USING (series_id) GROUP BY series_id, lo, hi, w, bin, mean, median")
def q_histogram(spark, sf_dir):
    """50 equal-width bins per series, with mean and median marks."""
    return out(PR.histogram(_panel(spark, sf_dir), PANEL, 50))


def _box_sql(by_month: bool) -> str:
    g = "series_id, month" if by_month else "series_id"
    mcol = ", month(date) AS month" if by_month else ""
    return V.with_(V.DAILY_PANEL_X, f"s AS (SELECT series_id{mcol}, CAST(y AS DOUBLE) AS v, y AS v0 FROM daily_panel)",
                   f"""q AS (SELECT {g}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3, CAST(sum(v0) AS DOUBLE) / count(v0) AS mean, stddev_samp(v) AS std, count(*) AS n FROM s GROUP BY {g})""",
                   f"""w AS (SELECT q.*, min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
  max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_fliers
  FROM q JOIN s USING ({g}) GROUP BY ALL)""") + (
        f"SELECT {g.replace('month', 'CAST(month AS BIGINT) AS month')}, " + ", ".join(
            V.r(c, c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high", "mean"]) + ", " +
        V.r("std", "std", 2) + ", n_fliers, n FROM w")


@query("a18_boxplot_overall", _box_sql(False))
def q_box(spark, sf_dir):
    """Box-plot statistics per series."""
    return out(PR.boxplot_stats(_panel(spark, sf_dir), PANEL, False), coarse=["std"])


@query("a18_boxplot_by_month", _box_sql(True))
def q_box_month(spark, sf_dir):
    """Box-plot statistics per series and month."""
    return out(PR.boxplot_stats(_panel(spark, sf_dir), PANEL, True), coarse=["std"])


@query("a19_kernel_density", V.with_(V.DAILY_PANEL_X, """st AS (SELECT series_id, count(y) AS n, stddev_samp(CAST(y AS DOUBLE)) AS sd,
  CAST(min(y) AS DOUBLE) AS mn, CAST(max(y) AS DOUBLE) AS mx FROM daily_panel GROUP BY 1)""",
  """g AS (SELECT series_id, n, mn, mx, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, mn - (mx - mn) / 2.0 AS g0,
  (mx - mn) * 2.0 / 999.0 AS step, unnest(range(0, 1000)) AS point FROM st)""",
  """d AS (SELECT g.series_id, g.point, g.g0 + g.step * g.point AS x, g.n, g.h, g.mn, g.mx,
  sum(exp(-((g.g0 + g.step * g.point - CAST(p.y AS DOUBLE)) ** 2) / (2.0 * g.h ** 2))) AS s
  FROM g JOIN daily_panel p USING (series_id) GROUP BY ALL)""") +
       "SELECT series_id, CAST(point AS BIGINT) AS point, " + V.r("x", "x") + ", " +
       V.r("s / (n * h * 2.5066282746310002) * (mx - mn)", "density_scaled") + " FROM d")
def q_kde(spark, sf_dir):
    """Gaussian KDE on 1000 points, every value at every point."""
    return out(PR.kde(_panel(spark, sf_dir), PANEL, 1000))


def _qq_sql(levels: int = 99) -> str:
    qs = PR.normal_quantiles(levels)
    plist = "[" + ", ".join(repr(p) for _, p, _ in qs) + "]"
    vals = ", ".join(f"({k}, {z!r})" for k, _, z in qs)
    return V.with_(V.DAILY_PANEL_X, f"lv(k, theoretical) AS (VALUES {vals})",
                   f"q AS (SELECT series_id, quantile_cont(CAST(y AS DOUBLE), {plist}) AS qs FROM daily_panel GROUP BY 1)",
                   f"u AS (SELECT series_id, unnest(qs) AS sample, unnest(range(1, {levels + 1})) AS k FROM q)",
                   "p AS (SELECT u.series_id, u.k, lv.theoretical, u.sample FROM u JOIN lv USING (k))") + (
        "SELECT series_id, CAST(k AS BIGINT) AS k, " + V.r("theoretical", "theoretical") + ", " + V.r("sample", "sample") + ", " +
        V.r("regr_slope(sample, theoretical) OVER (PARTITION BY series_id)", "slope", 2) + ", " +
        V.r("regr_intercept(sample, theoretical) OVER (PARTITION BY series_id)", "intercept", 2) + ", " +
        V.r("corr(sample, theoretical) OVER (PARTITION BY series_id)", "r") + " FROM p")


@query("a20_qq_points", _qq_sql())
def q_qq(spark, sf_dir):
    """A20 (re-aimed): 99 quantile levels vs the normal, with fitted line."""
    return out(PR.qq_points(_panel(spark, sf_dir), PANEL, 99), coarse=["slope", "intercept"])


_ORDERS = "src AS (SELECT o_orderpriority AS series_id, CAST(o_totalprice AS DOUBLE) AS x FROM orders)"


def _orders(spark, sf_dir):
    return T.read_table(spark, sf_dir, "orders", ["o_orderpriority", "o_totalprice"]).select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_totalprice").cast("double").alias("x"))


def _normal_sql(p: str) -> str:
    """Normal quantile of the SQL expression ``p``, as in operators.ranks."""
    def ratio(table, r):
        return "(" + ") / (".join(_horner(side, r) for side in table) + ")"

    def _horner(side, r):
        text = f"CAST({side[7]!r} AS DOUBLE)"
        for a in side[6::-1]:
            text = f"({text} * ({r}) + CAST({a!r} AS DOUBLE))"
        return text

    far = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    outer = f"CASE WHEN {far} <= 5 THEN {ratio(RK.MIDDLE, far + ' - 1.6')} ELSE {ratio(RK.TAIL, far + ' - 5.0')} END"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(RK.CENTRE, f'0.180625 - ({p} - 0.5) * ({p} - 0.5)')} "
            f"WHEN {p} < 0.5 THEN -({outer}) ELSE {outer} END")


_SCORES = ("k AS (SELECT series_id, x, row_number() OVER (PARTITION BY series_id ORDER BY x) AS position, "
           "count(*) OVER (PARTITION BY series_id) AS n FROM src)",
           "p AS (SELECT *, CAST(position - 0.375 AS DOUBLE) / CAST(n + 0.25 AS DOUBLE) AS p FROM k)",
           f"z AS (SELECT series_id, position, n, x AS sample, {_normal_sql('p')} AS theoretical FROM p)")


@query("a20_qq_points_by_row", V.with_(_ORDERS, *_SCORES) + "SELECT series_id, position, " + V.r("sample", "sample") + ", " +
       V.r("theoretical", "theoretical") + " FROM z")
def q_qq_rows(spark, sf_dir):
    """One Q-Q point for every order of a priority, ranked by range partitions."""
    return out(RK.qq_rows(_orders(spark, sf_dir), ["series_id"], "x"))


@query("a21_order_statistic_normality", V.with_(_ORDERS, *_SCORES, """s AS (SELECT series_id, count(*) AS n, pow(corr(sample, theoretical), 2) AS w,
  regr_slope(sample, theoretical) AS slope, regr_intercept(sample, theoretical) AS intercept, ln(CAST(count(*) AS DOUBLE)) AS l FROM z GROUP BY 1)""",
  """t AS (SELECT *, (ln(1.0 - w) - (1.0521 * (ln(l) - l) - 1.2725)) / (1.0308 - 0.26758 * (ln(l) + 2.0 / l)) AS z FROM s)""") +
       "SELECT series_id, n, " + V.r("w", "w") + ", " + V.r("z", "z", 2) + ", CAST(z <= 1.6448536269514722 AS BIGINT) AS is_normal, " +
       V.r("slope", "slope", 2) + ", " + V.r("intercept", "intercept", 2) + " FROM t")
def q_order_normality(spark, sf_dir):
    """Shapiro-Francia on all orders of a priority, no sample."""
    return out(RK.order_normality(_orders(spark, sf_dir), ["series_id"], "x"), coarse=["z", "slope", "intercept"])


_LEVELS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("a7_quantiles_of_large_groups", V.with_(_ORDERS, f"q AS (SELECT series_id, count(x) AS n, quantile_cont(x, {_LEVELS}) AS q FROM src GROUP BY 1)") +
       "SELECT series_id, n, " + ", ".join(V.r(f"q[{i + 1}]", f"q{round(100 * p)}") for i, p in enumerate(_LEVELS)) + " FROM q")
def q_large_quantiles(spark, sf_dir):
    """Exact quantiles of raw rows by their ranks; no group's values in one task."""
    q = RK.exact_quantiles(RK.value_ranks(_orders(spark, sf_dir), ["series_id"], "x"), ["series_id"], "x", _LEVELS)
    return out(q.select("series_id", "n", *[F.col("q")[i].alias(f"q{round(100 * p)}") for i, p in enumerate(_LEVELS)]))


# --------------------------------------------------------------------------
# Quality, splits, scaling
# --------------------------------------------------------------------------
from seriesforge.operators import split as SP  # noqa: E402


@query("q3_completeness", V.with_(V.SPARSE_PANEL_X, "d AS (SELECT series_id, date, count(*) AS c FROM sparse_panel GROUP BY 1, 2)")
       + """SELECT series_id, min(date) AS first_date, max(date) AS last_date,
  CAST(datediff('day', min(date), max(date)) + 1 AS BIGINT) AS expected_days, count(*) AS present_days,
  count(*) FILTER (WHERE c > 1) AS duplicate_keys,
  CAST(datediff('day', min(date), max(date)) + 1 AS BIGINT) - count(*) AS missing_days, """ +
       V.r("count(*) * 100.0 / (datediff('day', min(date), max(date)) + 1)", "pct_complete") + " FROM d GROUP BY 1")
def q_completeness(spark, sf_dir):
    """Q3: expected/present/missing days and duplicates per series (gappy panel)."""
    return out(QU.completeness(T.sparse_panel(spark, sf_dir), PANEL))


@query("q3_missing_days", V.with_(V.DAILY_SINGLE_X, """sp AS (SELECT series_id,
  CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily_single GROUP BY 1)""")
       + "SELECT series_id, date FROM sp ANTI JOIN daily_single USING (series_id, date)")
def q_missing_days(spark, sf_dir):
    """Q3: calendar days absent from the series (spine anti-join)."""
    return QU.missing_days(T.daily_single(spark, sf_dir), PANEL)


@query("q3_duplicate_keys", V.with_(V.RAW_LONG) +
       "SELECT date_query, type, count(*) AS n FROM raw_long GROUP BY 1, 2 HAVING count(*) > 1")
def q_dup_keys(spark, sf_dir):
    """Q3: keys stored more than once in the raw table."""
    return QU.duplicate_keys(T.raw_long(spark, sf_dir), ["date_query", "type"])


@query("q4_forward_fill", V.with_(V.SPARSE_PANEL_X, """sp AS (SELECT series_id,
  CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sparse_panel GROUP BY 1)""",
  "j AS (SELECT sp.series_id, sp.date, d.y, d.y IS NULL AND d.date IS NULL AS ins FROM sp LEFT JOIN sparse_panel d USING (series_id, date))")
       + "SELECT series_id, date, " + V.r("last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date "
                                          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", "y") +
       ", CAST(ins AS BIGINT) AS filled FROM j")
def q_ffill(spark, sf_dir):
    """Q4: daily spine, last value carried forward into missing days, per series."""
    return out(QU.forward_fill(T.sparse_panel(spark, sf_dir, exact=True), PANEL, ["y"]))


_IMPUTE_COLS = [c for c in _LAG_COLS if c not in ("series_id", "date")]


@query("a22_q2_median_impute", V.with_(V.DAILY_PANEL_X, _LAG_CTE) + "SELECT series_id, date, " + ", ".join(
    V.r(f"coalesce(CAST({c} AS DOUBLE), quantile_cont(CAST({c} AS DOUBLE), 0.5) OVER (PARTITION BY series_id))", c, 2 if c in STD_COLS else 4)
    for c in _IMPUTE_COLS) + " FROM lf")
def q_median_impute(spark, sf_dir):
    """NULL -> per-series median."""
    lf = _lag_table(spark, sf_dir).select("series_id", "date", *_IMPUTE_COLS)
    return out(QU.median_impute(lf, PANEL, _IMPUTE_COLS), coarse=STD_COLS)


_FILL_COLS = [c for c in _LAG_COLS if c not in ("series_id", "date")]


@query("a23_mean_fill", V.with_(V.DAILY_PANEL_X, _LAG_CTE) + "SELECT series_id, date, " + ", ".join(
    V.r(f"coalesce(CAST({c} AS DOUBLE), CAST(sum({c}) OVER (PARTITION BY series_id) AS DOUBLE) / "
        f"count({c}) OVER (PARTITION BY series_id))", c, 2 if c in STD_COLS else 4) for c in _FILL_COLS) + " FROM lf")
def q_mean_fill(spark, sf_dir):
    """NULL -> per-series mean of the rows present."""
    lf = _lag_table(spark, sf_dir).select("series_id", "date", *_FILL_COLS)
    return out(FE.fill_with_means(lf, PANEL, columns=_FILL_COLS), coarse=STD_COLS)


@query("p6_trailing_window", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X) + "SELECT series_id, date, " + V.r("y", "y") +
       ", " + V.r("temperature_2m_mean", "temperature_2m_mean") +
       " FROM b QUALIFY date >= CAST(max(date) OVER (PARTITION BY series_id) - INTERVAL 730 DAY AS DATE)")
def q_trailing(spark, sf_dir):
    """The last 730 days of each series (data-dependent bound)."""
    b = T.base_panel(spark, sf_dir, exact=True).select("series_id", "date", "y", "temperature_2m_mean")
    return out(SP.trailing_window(b, PANEL, 730))


@query("o4_time_split", V.with_(V.DAILY_PANEL_X, """d AS (SELECT date, row_number() OVER (ORDER BY date) AS pos,
  count(*) OVER () AS n FROM (SELECT DISTINCT date FROM daily_panel))""") +
       "SELECT p.series_id, p.date, " + V.r("p.y", "y") +
       ", CAST(d.pos <= floor(d.n * 0.8) AS BIGINT) AS is_train FROM daily_panel p JOIN d USING (date)")
def q_split(spark, sf_dir):
    """First int(0.8 n) distinct dates train, the rest test."""
    return out(SP.label_split(_panel(spark, sf_dir), "date", 0.8))


@query("o4_time_split_any_grain", """WITH d AS (SELECT ts, row_number() OVER (ORDER BY ts) AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts FROM events)) SELECT event_id, CAST(d.pos <= floor(d.n * 0.8) AS BIGINT) AS is_train FROM events e JOIN d USING (ts)""")
def q_split_any_grain(spark, sf_dir):
    """O4 on the events' own times: their ranks come from range partitions."""
    return out(RK.cut_by_rank(T.read_table(spark, sf_dir, "events", ["event_id", "ts"]), "ts").select("event_id", "is_train"))


_SCALE_COLS = ["y", *WEATHER_COLUMNS]


@query("f15_standardize", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X,
                                  """d AS (SELECT date, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT date FROM b))""", "l AS (SELECT b.*, d.pos <= floor(d.n * 0.8) AS tr FROM b JOIN d USING (date))",
                                  "st AS (SELECT series_id, " + ", ".join(
                                      f"avg(CAST({c} AS DOUBLE)) FILTER (WHERE tr) AS {c}__mu, "
                                      f"stddev_pop(CAST({c} AS DOUBLE)) FILTER (WHERE tr) AS {c}__sd" for c in _SCALE_COLS) +
                                  " FROM l GROUP BY 1)") + "SELECT l.series_id, l.date, " + ", ".join(
    V.r(f"(CAST(l.{c} AS DOUBLE) - {c}__mu) / CASE WHEN {c}__sd = 0 OR {c}__sd IS NULL THEN 1.0 ELSE {c}__sd END", c)
    for c in _SCALE_COLS) + " FROM l JOIN st USING (series_id)")
def q_standardize(spark, sf_dir):
    """Z-scores with population mean/std fitted on the train split."""
    b = T.base_panel(spark, sf_dir, exact=True).select("series_id", "date", *_SCALE_COLS)
    lab = SP.label_split(b, "date", 0.8)
    stats = SP.fit_scaler(lab.where("is_train = 1"), _SCALE_COLS, ["series_id"])
    return out(SP.apply_scaler(lab.drop("is_train"), stats, _SCALE_COLS, ["series_id"]))


# --------------------------------------------------------------------------
# Baselines, metrics, competition, registry (no trained model needed)
# --------------------------------------------------------------------------
from seriesforge.operators import evaluate as EV  # noqa: E402
from seriesforge.operators import forecast as FC  # noqa: E402

REGISTRY_CUT = "1998-06-30"
_ORDER_SQL = "CASE candidate WHEN 'persistence' THEN 1 WHEN 'seasonal_naive_7' THEN 2 ELSE 3 END"


def _baseline_cte(src: str = "daily_panel", require_truth: bool = True) -> str:
    w = f"OVER (PARTITION BY series_id ORDER BY date)"
    leads = ", ".join(f"lead(y, {h}) {w} AS l{h}, lead(date, {h}) {w} AS d{h}" for h in range(1, 8))
    lags = ", ".join(f"lag(y, {k}) {w} AS g{k}" for k in range(1, 7))
    b = (f"bl AS (SELECT series_id, date, y, {leads}, {lags}, " + V.guarded("avg", "y", 7, lo=-6, hi=0) +
         f" AS ma7 FROM {src})")
    parts = []
    for h in range(1, 8):
        preds = {"persistence": "y", "seasonal_naive_7": "y" if h == 7 else f"g{7 - h}", "moving_average_7": "ma7"}
        for c in EV.BASELINES:
            parts.append(f"SELECT series_id, date, {h} AS horizon, '{c}' AS candidate, d{h} AS target_date, "
                         f"CAST(l{h} AS DOUBLE) AS y_true, CAST({preds[c]} AS DOUBLE) AS y_pred FROM bl")
    cond = "y_pred IS NOT NULL" + (" AND y_true IS NOT NULL" if require_truth else "")
    return b + ",\npr AS (SELECT * FROM (" + " UNION ALL ".join(parts) + f") WHERE {cond})"


def _preds(spark, sf_dir):
    return EV.baseline_predictions(_panel(spark, sf_dir), PANEL)


def _metrics_sql(src: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, {V.r('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', 'rmse', 2)},
  {V.r('avg(abs(y_true - y_pred))', 'mae', 2)},
  {V.r('avg(abs(y_true - y_pred) / greatest(abs(y_true), 2.220446049250313e-16)) * 100.0', 'mape')},
  {V.r('1.0 - sum((y_true - y_pred) * (y_true - y_pred)) / (count(*) * var_pop(y_true))', 'r2')}
FROM {src} GROUP BY {by}"""


def _metrics_raw_sql(src: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
  avg(abs(y_true - y_pred)) AS mae, avg(abs(y_true - y_pred) / greatest(abs(y_true), 2.220446049250313e-16)) * 100.0 AS mape,
  1.0 - sum((y_true - y_pred) * (y_true - y_pred)) / (count(*) * var_pop(y_true)) AS r2
FROM {src} GROUP BY {by}"""


_MCOARSE = ["rmse", "mae"]


@query("d1_baseline_predictions", V.with_(V.DAILY_PANEL_X, _baseline_cte()) +
       "SELECT series_id, date, CAST(horizon AS BIGINT) AS horizon, candidate, target_date, " +
       V.r("y_true", "y_true") + ", " + V.r("y_pred", "y_pred") + " FROM pr")
def q_baselines(spark, sf_dir):
    """Persistence, seasonal naive and 7-row mean for h = 1..7."""
    return out(_preds(spark, sf_dir))


@query("a24_regression_metrics", V.with_(V.DAILY_PANEL_X, _baseline_cte()) + _metrics_sql("pr", "candidate, horizon"))
def q_metrics(spark, sf_dir):
    """RMSE, MAE, MAPE %, R2 per (candidate, horizon), pooled over series."""
    return out(EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"]), coarse=_MCOARSE)


@query("a24_metrics_per_series", V.with_(V.DAILY_PANEL_X, _baseline_cte()) +
       _metrics_sql("pr", "series_id, candidate, horizon"))
def q_metrics_series(spark, sf_dir):
    """A24 per (series, candidate, horizon)."""
    return out(EV.metrics(_preds(spark, sf_dir), ["series_id", "candidate", "horizon"]), coarse=_MCOARSE)


_WIN_SQL = (V.with_(V.DAILY_PANEL_X, _baseline_cte(), "m AS (" + _metrics_raw_sql("pr", "candidate, horizon") + ")") +
            f"SELECT horizon, candidate, n, {V.r('rmse', 'rmse', 2)}, {V.r('mae', 'mae', 2)}, {V.r('mape', 'mape')}, "
            f"{V.r('r2', 'r2')} FROM m QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, {_ORDER_SQL}) = 1")


@query("w11_m5_competition_winner", _WIN_SQL)
def q_winner(spark, sf_dir):
    """Lowest RMSE per horizon, ties to the earlier candidate."""
    m = EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"])
    return out(EV.pick_winner(m, ["horizon"]), coarse=_MCOARSE)


def _registry_parts(spark, sf_dir):
    p = _preds(spark, sf_dir)
    cut = F.lit(REGISTRY_CUT).cast("date")
    old = EV.pick_winner(EV.metrics(p.where(F.col("date") < cut), ["candidate", "horizon"]), ["horizon"])
    old = old.where(F.col("horizon") <= 5)  # horizons 6 and 7 never registered
    new = EV.pick_winner(EV.metrics(p.where(F.col("date") >= cut), ["candidate", "horizon"]), ["horizon"])
    return old, new


_REG_CTE = [V.DAILY_PANEL_X, _baseline_cte(),
            f"mo AS ({_metrics_raw_sql(f'(SELECT * FROM pr WHERE date < DATE {chr(39)}{REGISTRY_CUT}{chr(39)})', 'candidate, horizon')})",
            f"mn AS ({_metrics_raw_sql(f'(SELECT * FROM pr WHERE date >= DATE {chr(39)}{REGISTRY_CUT}{chr(39)})', 'candidate, horizon')})",
            f"reg AS (SELECT * FROM mo WHERE horizon <= 5 QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, {_ORDER_SQL}) = 1)",
            f"nw AS (SELECT * FROM mn QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, {_ORDER_SQL}) = 1)"]


@query("m6_promotion_decisions", V.with_(*_REG_CTE) + f"""SELECT nw.horizon, nw.candidate, nw.n, {V.r('nw.rmse', 'new_rmse', 2)},
  {V.r('nw.mae', 'mae', 2)}, {V.r('nw.mape', 'mape')}, {V.r('nw.r2', 'r2')}, {V.r('reg.rmse', 'old_rmse', 2)},
  CAST(reg.rmse IS NULL OR nw.rmse < reg.rmse AS BIGINT) AS promoted,
  CASE WHEN reg.rmse IS NULL THEN 'promoted_first' WHEN nw.rmse < reg.rmse THEN 'promoted' ELSE 'rejected' END AS action
FROM nw LEFT JOIN reg USING (horizon)""")
def q_promotion(spark, sf_dir):
    """Promote per horizon on strictly lower RMSE; horizons never
    registered are registered on first sight."""
    old, new = _registry_parts(spark, sf_dir)
    return out(EV.promote(new, old, ["horizon"]), coarse=["new_rmse", "old_rmse", "mae"])


@query("m6_next_registry", V.with_(*_REG_CTE, """dec AS (SELECT nw.*, reg.rmse AS old_rmse FROM nw LEFT JOIN reg USING (horizon)
  WHERE reg.rmse IS NULL OR nw.rmse < reg.rmse)""") + f"""SELECT horizon, {V.r('rmse', 'rmse', 2)}, candidate FROM reg
  WHERE horizon NOT IN (SELECT horizon FROM dec)
UNION ALL SELECT horizon, {V.r('rmse', 'rmse', 2)}, candidate FROM dec""")
def q_next_registry(spark, sf_dir):
    """The next registry version after the promotions."""
    old, new = _registry_parts(spark, sf_dir)
    dec = EV.promote(new, old, ["horizon"])
    reg = EV.apply_promotions(old.select("horizon", "rmse", "candidate"), dec, ["horizon"], ["candidate"])
    return out(reg, coarse=["rmse"])


@query("m14_m7_missing_horizons", V.with_(*_REG_CTE) +
       "SELECT CAST(h AS BIGINT) AS horizon FROM (SELECT unnest(range(1, 8)) AS h) WHERE h NOT IN (SELECT horizon FROM reg)")
def q_missing_horizons(spark, sf_dir):
    """Horizons 1..7 without a production entry in the registry."""
    old, _ = _registry_parts(spark, sf_dir)
    groups = old.select(F.lit(1).alias("__g")).distinct()
    return out(EV.missing_horizons(old.withColumn("__g", F.lit(1)), groups, 7, ["__g"]).select("horizon"))


@query("d2_expanding_folds", V.with_(V.DAILY_PANEL_X, _baseline_cte(),
                                     "fm AS (" + _metrics_raw_sql("(SELECT *, year(date) AS fold FROM pr)",
                                                                  "candidate, horizon, fold") + ")") +
       f"""SELECT candidate, horizon, count(rmse) AS n_folds, {V.r('avg(rmse)', 'rmse_mean', 2)}, {V.r('stddev_samp(rmse)', 'rmse_std', 2)},
  {V.r('min(rmse)', 'rmse_min', 2)}, {V.r('max(rmse)', 'rmse_max', 2)} FROM fm GROUP BY 1, 2""")
def q_folds(spark, sf_dir):
    """Validation year Y (training years < Y), RMSE spread over all years
    (the predictors here need no training year before them)."""
    f = EV.expanding_folds(_preds(spark, sf_dir), "date")
    fm = EV.metrics(f, ["candidate", "horizon", "fold"])
    return out(EV.fold_summary(fm, ["candidate", "horizon"]), coarse=["rmse_mean", "rmse_std", "rmse_min", "rmse_max"])


@query("d4_mape_tier", V.with_(V.DAILY_PANEL_X, _baseline_cte(), "m AS (" + _metrics_raw_sql("pr", "candidate, horizon") + ")") +
       f"""SELECT candidate, horizon, {V.r('mape', 'mape')}, CASE WHEN mape < 3 THEN 'Excellent' WHEN mape <= 5 THEN 'Good'
  WHEN mape <= 10 THEN 'Reasonable' ELSE 'Poor' END AS tier FROM m""")
def q_mape_tier(spark, sf_dir):
    """MAPE tier label."""
    m = EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"])
    return out(m.select("candidate", "horizon", "mape", S.mape_tier("mape").alias("tier")))


def _segments(spark, sf_dir):
    p = _preds(spark, sf_dir)
    p = CAL.holiday_flags(p, "target_date")
    segs = F.array(F.struct(F.lit("season").alias("segment_type"), EV.season_of("target_date").alias("segment")),
                   F.struct(F.lit("day_group").alias("segment_type"), EV.day_group("target_date").alias("segment")),
                   F.struct(F.lit("holiday").alias("segment_type"),
                            F.when(F.col("is_holiday") == 1, "holiday").otherwise("normal").alias("segment")))
    return p.select("*", F.inline(segs))


_SEASON = ("CASE WHEN month(target_date) IN (12, 1, 2) THEN 'winter' WHEN month(target_date) IN (3, 4, 5) THEN 'spring' "
           "WHEN month(target_date) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END")
_DAYG = ("CASE WHEN isodow(target_date) <= 4 THEN 'mon-thu' WHEN isodow(target_date) = 5 THEN 'fri' "
         "WHEN isodow(target_date) = 6 THEN 'sat' ELSE 'sun' END")


@query("d5_error_by_segment", V.with_(V.DAILY_PANEL_X, _baseline_cte(), V.holidays_sql("daily_panel"),
                                      """h1 AS (SELECT pr.*, coalesce(c.is_holiday, 0) AS is_holiday FROM pr
  LEFT JOIN cal_flags c ON c.date = pr.target_date)""",
                                      f"""sg AS (SELECT *, 'season' AS segment_type, {_SEASON} AS segment FROM h1
  UNION ALL SELECT *, 'day_group', {_DAYG} FROM h1
  UNION ALL SELECT *, 'holiday', CASE WHEN is_holiday = 1 THEN 'holiday' ELSE 'normal' END FROM h1)""") +
       _metrics_sql("sg", "candidate, horizon, segment_type, segment"))
def q_segments(spark, sf_dir):
    """Error by season, day group and holiday vs normal day, every horizon."""
    return out(EV.metrics(_segments(spark, sf_dir), ["candidate", "horizon", "segment_type", "segment"]), coarse=_MCOARSE)


@query("d6_residual_profile", V.with_(V.DAILY_PANEL_X, _baseline_cte(), """src AS (SELECT candidate || '|' || horizon AS series_id,
  y_true - y_pred AS x FROM pr)""", _MOMENTS) + """SELECT split_part(series_id, '|', 1) AS candidate,
  CAST(split_part(series_id, '|', 2) AS BIGINT) AS horizon, n, """ + V.r("mu", "mean_error", 2) + ", " +
       V.r("skewness", "skewness") + ", " + V.r("kurtosis", "kurtosis") + ", " + V.r("jb", "jarque_bera", 2) + ", " +
       V.r("exp(-jb / 2.0)", "jb_pvalue") + " FROM j JOIN m USING (series_id, n)")
def q_residuals(spark, sf_dir):
    """Residual mean, skewness, kurtosis and normality per (candidate, horizon)."""
    return out(EV.residual_profile(_preds(spark, sf_dir), ["candidate", "horizon"]), coarse=["mean_error", "jarque_bera"])


@query("d7_error_reduction", V.with_(V.DAILY_PANEL_X, _baseline_cte(), "m AS (" + _metrics_raw_sql("pr", "candidate, horizon") + ")",
                                     "b AS (SELECT horizon, mape AS bm FROM m WHERE candidate = 'persistence')") +
       f"SELECT horizon, candidate, {V.r('mape', 'mape')}, {V.r('bm', 'baseline_mape')}, "
       f"{V.r('(bm - mape) / bm * 100.0', 'reduction_pct')} FROM m LEFT JOIN b USING (horizon)")
def q_reduction(spark, sf_dir):
    """MAPE reduction versus persistence."""
    m = EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"])
    return out(EV.error_reduction(m, ["horizon"]))


# --------------------------------------------------------------------------
# Forecast tables and what is served from them (on baseline predictors)
# --------------------------------------------------------------------------
from seriesforge.operators import joins as JN  # noqa: E402


def _production_forecast(spark, sf_dir, with_exog: bool = True):
    """Latest-row forecasts of the per-horizon winner, with its metrics
    and the exogenous values of the target date (J2)."""
    panel = _panel(spark, sf_dir)
    fc = FC.date_forecast(EV.baseline_forecast(panel, PANEL), "origin_date")
    m = EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"])
    win = EV.pick_winner(m, ["horizon"]).select("horizon", "candidate", "rmse", "mae", "mape", "r2")
    prod = fc.join(win, ["horizon", "candidate"])  # the winner's forecast only
    if with_exog:
        ex = T.exog_daily(spark, sf_dir).select("date", "temperature_2m_mean", "precipitation_sum")
        prod = FC.attach_context(prod, exog=ex)
    return prod


_FC_CTE = [V.DAILY_PANEL_X, V.EXOG_DAILY, _baseline_cte(),
           "m AS (" + _metrics_raw_sql("pr", "candidate, horizon") + ")",
           f"win AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY horizon ORDER BY rmse, {_ORDER_SQL}) = 1)",
           """tail AS (SELECT * FROM daily_panel QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 7)""",
           _baseline_cte("tail", require_truth=False).replace("bl AS", "tbl AS").replace("FROM bl", "FROM tbl")
           .replace("pr AS", "fpr AS"),
           """fc AS (SELECT series_id, date AS origin_date, horizon, candidate, y_pred,
  CAST(date + horizon * INTERVAL 1 DAY AS DATE) AS target_date, round(y_pred, 2) AS predicted FROM fpr
  QUALIFY date = max(date) OVER (PARTITION BY series_id))""",
           """prod AS (SELECT fc.*, win.rmse, win.mae, win.mape, win.r2 FROM fc JOIN win USING (horizon, candidate))""",
           """prodx AS (SELECT prod.*, e.temperature_2m_mean, e.precipitation_sum FROM prod
  LEFT JOIN exog_daily e ON e.date = prod.target_date)"""]


@query("m8_j2_j3_forecast_latest", V.with_(*_FC_CTE) + "SELECT series_id, origin_date, CAST(horizon AS BIGINT) AS horizon, "
       "candidate, target_date, " + ", ".join([V.r("y_pred", "y_pred"), V.r("predicted", "predicted"), V.r("rmse", "rmse", 2),
                                              V.r("mae", "mae", 2), V.r("mape", "mape"), V.r("r2", "r2"),
                                              V.r("temperature_2m_mean", "temperature_2m_mean"),
                                              V.r("precipitation_sum", "precipitation_sum")]) + " FROM prodx")
def q_forecast_latest(spark, sf_dir):
    """Score the last day of every series for h = 1..7,
    attach the winner's metrics and the exogenous values of the target day."""
    return out(_production_forecast(spark, sf_dir), coarse=_MCOARSE)


@query("m9_forecast_as_of", V.with_(*_FC_CTE) + f"SELECT series_id, CAST(horizon AS BIGINT) AS horizon, "
       f"CAST(DATE '{AS_OF}' + (horizon - 1) * INTERVAL 1 DAY AS DATE) AS target_date, " + V.r("predicted", "predicted") + " FROM prod")
def q_forecast_as_of(spark, sf_dir):
    """M9: alternative dating from a given day (as_of + h - 1)."""
    p = _production_forecast(spark, sf_dir, False)
    p = FC.date_forecast(p.drop("target_date", "predicted"), "origin_date", as_of=AS_OF)
    return out(p.select("series_id", "horizon", "target_date", "predicted"))


@query("m10_f10_next_day", V.with_(*_FC_CTE) + "SELECT series_id, target_date, " + V.r("predicted", "predicted") + ", " +
       V.r("round(predicted - coalesce(mae, 5.0), 2)", "lower") + ", " + V.r("round(predicted + coalesce(mae, 5.0), 2)", "upper") +
       " FROM prod WHERE horizon = 1")
def q_next_day(spark, sf_dir):
    """Next-day forecast with -/+ MAE interval."""
    p = FC.next_day(_production_forecast(spark, sf_dir, False))
    return out(p.select("series_id", "target_date", "predicted", "lower", "upper"))


@query("d3_intervals", V.with_(*_FC_CTE) + "SELECT series_id, CAST(horizon AS BIGINT) AS horizon, " + ", ".join(
    [V.r("predicted", "predicted"), V.r("round(predicted - coalesce(mae, 5.0), 2)", "lower_68"),
     V.r("round(predicted + coalesce(mae, 5.0), 2)", "upper_68"), V.r("round(predicted - coalesce(mae, 5.0) * 1.96, 2)", "lower_95"),
     V.r("round(predicted + coalesce(mae, 5.0) * 1.96, 2)", "upper_95")]) + " FROM prod")
def q_intervals(spark, sf_dir):
    """D3: 68 % / 95 % bands as -/+ 1.0 / 1.96 MAE."""
    p = FC.intervals(_production_forecast(spark, sf_dir, False))
    return out(p.select("series_id", "horizon", "predicted", "lower_68", "upper_68", "lower_95", "upper_95"))


def _last_known(spark, sf_dir):
    lr = FC.latest_row(_panel(spark, sf_dir), PANEL)
    return lr.select("series_id", F.col("date").alias("last_date"), F.col("y").cast("double").alias("last_value"))


@query("s7_m11_o5_document_roundtrip", V.with_(*_FC_CTE) +
       "SELECT series_id, CAST(horizon AS BIGINT) AS day, 'day_' || horizon AS day_key, target_date, " +
       V.r("predicted", "prediction") + " FROM prod")
def q_document(spark, sf_dir):
    """S7 + M11/O5/P11: one nested JSON forecast document per series, read
    back into display rows sorted by day number."""
    prod = _production_forecast(spark, sf_dir, False)
    doc = FC.forecast_document(prod, _last_known(spark, sf_dir), ["series_id"])
    rows = FC.parse_forecast_document(doc, ["series_id"])
    return out(FC.display_rows(rows, ["series_id"]).select("series_id", "day", "day_key", "target_date", "prediction"))


@query("s6_latest_row", V.with_(V.DAILY_PANEL_X, V.EXOG_DAILY, _BASE_X) + "SELECT series_id, date, " + V.r("y", "y") + ", " +
       ", ".join(V.r(c, c) for c in WEATHER_COLUMNS) + " FROM b QUALIFY date = max(date) OVER (PARTITION BY series_id)")
def q_latest_row(spark, sf_dir):
    """The latest row of every series (one max_by aggregate)."""
    return out(FC.latest_row(T.base_panel(spark, sf_dir, exact=True), PANEL))


@query("o2_last_90_rows", V.with_(V.DAILY_PANEL_X) + "SELECT series_id, date, " + V.r("y", "y") +
       " FROM daily_panel QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 90")
def q_last_rows(spark, sf_dir):
    """O2: the last 90 rows of every series."""
    return out(FC.last_rows(_panel(spark, sf_dir), PANEL, 90))


@query("m12_f4_f11_history_and_forecast", V.with_(*_FC_CTE) + f"""SELECT series_id, date, {V.r('value', 'value')}, kind,
  {V.r('lower', 'lower')}, {V.r('upper', 'upper')}, CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend FROM (
  SELECT series_id, date, CAST(y AS DOUBLE) AS value, 'actual' AS kind, NULL::DOUBLE AS lower, NULL::DOUBLE AS upper
  FROM daily_panel QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY date DESC) <= 90
  UNION ALL SELECT series_id, target_date, predicted, 'forecast', round(predicted - coalesce(rmse, 5.5), 2),
  round(predicted + coalesce(rmse, 5.5), 2) FROM prod)""")
def q_history_forecast(spark, sf_dir):
    """90 days of history and the forecast with -/+ RMSE band."""
    return out(FC.history_and_forecast(_panel(spark, sf_dir), _production_forecast(spark, sf_dir, False), PANEL, 90))


@query("w8_w9_forecast_changes", V.with_(*_FC_CTE, """lk AS (SELECT series_id, CAST(y AS DOUBLE) AS last_value FROM daily_panel
  QUALIFY date = max(date) OVER (PARTITION BY series_id))""", """c AS (SELECT prod.*, lk.last_value,
  coalesce(lag(predicted) OVER (PARTITION BY series_id ORDER BY horizon), lk.last_value) AS base FROM prod JOIN lk USING (series_id))""")
       + "SELECT series_id, CAST(horizon AS BIGINT) AS horizon, " + ", ".join(
    [V.r("predicted", "predicted"), V.r("last_value", "last_value"),
     V.r("CASE WHEN base > 0 THEN (predicted - base) / base * 100.0 END", "change_pct"),
     V.r("CASE WHEN last_value IS NULL OR last_value = 0 THEN 0.0 ELSE (predicted - last_value) / last_value * 100.0 END",
         "change_vs_last_pct")]) + " FROM c")
def q_changes(spark, sf_dir):
    """Change % from the previous horizon (first from the last known
    value) and from the last known value."""
    p = _production_forecast(spark, sf_dir, False).join(_last_known(spark, sf_dir).drop("last_date"), "series_id")
    return out(FC.change_columns(p, ["series_id"]).select("series_id", "horizon", "predicted", "last_value",
                                                          "change_pct", "change_vs_last_pct"))


@query("f14_candidate_spread_confidence", V.with_(*_FC_CTE) + "SELECT series_id, CAST(horizon AS BIGINT) AS horizon, " +
       V.r("stddev_samp(y_pred)", "spread", 2) + """, count(*) AS n_candidates,
  CASE WHEN stddev_samp(y_pred) < 2 THEN 'high' WHEN stddev_samp(y_pred) < 3 THEN 'medium' ELSE 'low' END AS confidence
  FROM fc GROUP BY 1, 2""")
def q_confidence(spark, sf_dir):
    """spread of the candidates' forecasts and its confidence bucket."""
    fc = EV.baseline_forecast(_panel(spark, sf_dir), PANEL)
    return out(FC.spread_confidence(fc, ["series_id"]), coarse=["spread"])


@query("m13_summary", V.with_(*_FC_CTE, "reg AS (SELECT count(*) AS n_models, avg(rmse) AS avg_rmse FROM win)") +
       """SELECT d.series_id, count(*) AS n_rows, min(d.date) AS first_date, max(d.date) AS last_date,
  any_value(r.n_models) AS n_models, """ + V.r("any_value(r.avg_rmse)", "avg_rmse", 2) + """,
  """ + V.r("any_value(p.predicted)", "next_day_forecast") + """
FROM daily_panel d CROSS JOIN reg r LEFT JOIN (SELECT series_id, predicted FROM prod WHERE horizon = 1) p USING (series_id)
GROUP BY d.series_id""")
def q_summary(spark, sf_dir):
    """Dataset, model and forecast summary per series."""
    panel = _panel(spark, sf_dir)
    span = QU.date_span(panel, PANEL).select("series_id", "n_rows", "first_date", "last_date")
    m = EV.metrics(_preds(spark, sf_dir), ["candidate", "horizon"])
    reg = EV.pick_winner(m, ["horizon"]).agg(F.count(F.lit(1)).alias("n_models"), F.avg("rmse").alias("avg_rmse"))
    nd = (_production_forecast(spark, sf_dir, False).where("horizon = 1")
          .select("series_id", F.col("predicted").alias("next_day_forecast")))
    return out(QU.with_one_row(span.join(nd, "series_id", "left"), reg).select(
        "series_id", "n_rows", "first_date", "last_date", "n_models", "avg_rmse", "next_day_forecast"), coarse=["avg_rmse"])


@query("j7_attach_by_position", V.with_(*_FC_CTE, """lk AS (SELECT series_id, max(date) AS last_date FROM daily_panel GROUP BY 1)""",
                                        """ahead AS (SELECT lk.series_id, e.date, e.temperature_2m_mean,
  row_number() OVER (PARTITION BY lk.series_id ORDER BY e.date) AS pos FROM lk JOIN exog_daily e ON e.date > lk.last_date
  QUALIFY pos <= 7)""") + "SELECT p.series_id, CAST(p.horizon AS BIGINT) AS horizon, a.date AS exog_date, " +
       V.r("a.temperature_2m_mean", "temperature_2m_mean") + ", " + V.r("p.predicted", "predicted") +
       " FROM prod p LEFT JOIN ahead a ON a.series_id = p.series_id AND a.pos = p.horizon")
def q_position(spark, sf_dir):
    """Attach the next exogenous rows to forecast days by position."""
    lk = _last_known(spark, sf_dir).select("series_id", "last_date")
    ex = T.exog_daily(spark, sf_dir).select("date", "temperature_2m_mean")
    ahead = JN.next_rows_by_position(lk, "last_date", ex, "date", 7).withColumnRenamed("date", "exog_date")
    p = _production_forecast(spark, sf_dir, False).select("series_id", "horizon", "predicted")
    j = p.join(ahead, (p["series_id"] == ahead["series_id"]) & (p["horizon"] == ahead["pos"]), "left")
    return out(j.select(p["series_id"], "horizon", "exog_date", "temperature_2m_mean", "predicted"))


@query("j6_f16_nearest_hour_lookup", """WITH ph AS (SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS n_purchases
  FROM events WHERE event_type = 'purchase' GROUP BY 1),
c AS (SELECT e.event_id, ph.hour_ts, ph.n_purchases FROM events e CROSS JOIN ph
  QUALIFY row_number() OVER (PARTITION BY e.event_id
    ORDER BY abs(epoch(ph.hour_ts) - epoch(date_trunc('hour', e.ts))), ph.hour_ts) = 1)
SELECT event_id, strftime(hour_ts, '%Y-%m-%d %H:%M:%S') AS matched_hour, n_purchases FROM c""")
def q_nearest_hour(spark, sf_dir):
    """Each event's hour matched exactly in the hourly table of
    purchases, else the nearest hour (earlier on ties) - a bucketed as-of
    join, no cross product."""
    ev = T.read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type"])
    ph = (ev.where(F.col("event_type") == "purchase").groupBy(F.date_trunc("hour", "ts").alias("hour_ts"))
          .agg(F.count(F.lit(1)).alias("n_purchases")))
    j = JN.nearest_time_join(ev.select("event_id", "ts"), ph, "ts", "hour_ts", [], "hour", 86400, "matched_ts")
    return j.select("event_id", F.date_format("matched_ts", "yyyy-MM-dd HH:mm:ss").alias("matched_hour"), "n_purchases")


# --------------------------------------------------------------------------
# Trained models (rows-only checks: no SQL equivalent of a fitted forest)
# --------------------------------------------------------------------------
def trained(spark, sf_dir, base=None):
    """M1-M5 over all 7 horizons with the reference's model sizes (``full``), and
    the folder of the run: trained once in an application, later calls read what
    the first one stored. Features are ranked by the linear values here; the boosted
    selector is a query of its own (``m4_a25_feature_selection``)."""
    import hashlib
    from seriesforge.plans import train as TR
    from seriesforge.session import checkpoint_dir
    from seriesforge.sources import store
    root = store.join(checkpoint_dir(spark), f"competition-{spark.sparkContext.applicationId}-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
    if not store.exists(spark, store.join(root, "metrics", "_SUCCESS")):
        cfg = TR.TrainConfig(horizons=list(range(1, 8)), profile="full", selection="linear_shap")
        base = stored_base(spark, sf_dir) if base is None else base
        res = TR.train_competition(features_table(spark, sf_dir, True, base), PANEL, cfg)
        run = TR.save_models(res, store.join(root, "runs"))
        res["winners"].withColumn("run_path", F.lit(run)).write.mode("overwrite").parquet(store.join(root, "winners"))
        res["predictions"].write.mode("overwrite").parquet(store.join(root, "predictions"))
        res["metrics"].coalesce(1).write.mode("overwrite").parquet(store.join(root, "metrics"))
    return {x: spark.read.parquet(store.join(root, x)) for x in ("metrics", "winners", "predictions")}


@query("m1_m2_m3_m5_train_competition")
def q_train(spark, sf_dir):
    """M1/M2/M3/M5: every candidate for every horizon on all series, holdout
    metrics per candidate."""
    return trained(spark, sf_dir)["metrics"]


@query("m4_a25_feature_selection")
def q_selection(spark, sf_dir):
    """Mean |Shapley value| per feature of the boosted selector (400 trees, 60
    leaves) over the training rows, top 30."""
    from seriesforge.plans import train as TR
    cfg = TR.TrainConfig(horizons=[1])
    lab, feats, targets, _ = TR.prepare(features_table(spark, sf_dir, True, stored_base(spark, sf_dir)), PANEL, cfg)
    return TR.select_features(cut_lineage(lab.where("is_train = 1").select(*feats, *targets)), feats, targets[0], cfg)


@query("m8_score_with_models")
def q_score_models(spark, sf_dir):
    """The trained run registered, then the last day of every series
    scored from what is stored alone."""
    import uuid
    from seriesforge.plans import train as TR
    from seriesforge.session import checkpoint_dir
    root = f"{checkpoint_dir(spark).rstrip('/')}/registry-{uuid.uuid4().hex}"
    base = stored_base(spark, sf_dir)
    winners = trained(spark, sf_dir, base)["winners"]
    TR.update_registry(spark, root, winners.drop("run_path"), winners.first()["run_path"])
    return TR.score_production(features_table(spark, sf_dir, False, base), PANEL, TR.read_registry(spark, root))


@query("d10_patience")
def q_patience(spark, sf_dir):
    """Both boosted candidates for every horizon with a patience of 50 rounds on
    the last dates of the training rows: rounds run, the best of them by the stored
    errors, and the rounds that the stored models keep."""
    from pyspark.sql import Window
    from seriesforge.plans import train as TR
    sizes = {k: v for k, v in TR.candidate_models("full").items() if v.kind == "boost"}
    cfg = TR.TrainConfig(horizons=list(range(1, 8)), candidates=sizes, patience=50, selection="linear_shap")
    res = TR.train_competition(features_table(spark, sf_dir, True, stored_base(spark, sf_dir)), PANEL, cfg)
    order = Window.partitionBy("candidate", "horizon").orderBy("validation_rmse", "round")
    best = res["rounds"].withColumn("rn", F.row_number().over(order)).withColumn("rounds_run", F.count("*").over(Window.partitionBy("candidate", "horizon"))).where("rn = 1")
    kept = res["trees"].where("tree >= 0").groupBy("candidate", "horizon").agg(F.count("*").alias("rounds_kept"))
    return best.join(kept, ["candidate", "horizon"]).select("candidate", "horizon", "rounds_run", (F.col("round") + 1).alias("best_round"), "rounds_kept", "validation_rmse")


@query("d9_grid")
def q_grid(spark, sf_dir):
    """Learning rate x leaves of the leaf-wise candidate for the next day, as
    candidates of one competition (patience 50): holdout metrics of each."""
    from seriesforge.plans import train as TR
    name = "LeafwiseBoosting"
    cfg = TR.TrainConfig(horizons=[1], candidates={name: TR.candidate_models("full")[name]}, patience=50, selection="linear_shap",
                         grid={name: {"learning_rate": [0.01, 0.05, 0.1], "max_leaves": [15, 31, 63]}})
    return TR.train_competition(features_table(spark, sf_dir, True, stored_base(spark, sf_dir)), PANEL, cfg)["metrics"]


# one feature, one pooled line per horizon: least squares that SQL can say too
_OLS_SQL = V.with_(V.DAILY_PANEL_X, "lf0 AS (SELECT series_id, date, CAST(y AS DOUBLE) AS y, " + ", ".join(
    f"CAST(lead(y, {h}) OVER (PARTITION BY series_id ORDER BY date) AS DOUBLE) AS t{h}" for h in range(1, 8)) + " FROM daily_panel)",
    "w AS (SELECT * FROM lf0 QUALIFY date >= max(date) OVER (PARTITION BY series_id) - INTERVAL 5475 DAY)",
    "c AS (SELECT * FROM w WHERE t7 IS NOT NULL)",
    "d AS (SELECT date, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM c))",
    "l AS (SELECT c.*, d.pos <= floor(d.n * 0.8) AS tr FROM c JOIN d USING (date))",
    "x AS (" + " UNION ALL ".join(f"SELECT {h} AS horizon, tr, y, t{h} AS t FROM l" for h in range(1, 8)) + ")",
    "f AS (SELECT horizon, regr_slope(t, y) AS b, regr_intercept(t, y) AS a FROM x WHERE tr GROUP BY 1)",
    "p AS (SELECT 'LinearRegression' AS candidate, horizon, t AS y_true, a + b * y AS y_pred FROM x JOIN f USING (horizon) WHERE NOT tr)")


@query("d1_linear_regression_one_feature", _OLS_SQL + _metrics_sql("p", "candidate, horizon"))
def q_linear_one(spark, sf_dir):
    """The linear baseline on today's value alone, where SQL can check it."""
    from seriesforge.plans import train as TR
    cfg = TR.TrainConfig(horizons=list(range(1, 8)), selection="none")
    cols = ["series_id", "date", "y", *[f"target_next_day_{h}" for h in range(1, 8)]]
    return out(TR.linear_baseline(FE.lag_features(_panel(spark, sf_dir), PANEL).select(*cols), PANEL, cfg), coarse=_MCOARSE)


# --------------------------------------------------------------------------
# Sink round trip, date range, horizon limit
# --------------------------------------------------------------------------
@query("s5_s1_o1_csv_sink_roundtrip", _pivot_sql())
def q_csv_roundtrip(spark, sf_dir):
    """S5 + O1 + S1: the wide table written as sorted CSV into the shared
    checkpoint folder (a new folder per run) and scanned back with a schema."""
    import uuid
    from seriesforge.session import checkpoint_dir
    from seriesforge.sources.files import read_csv, write_table
    wide = IN.pivot_wide(T.raw_long(spark, sf_dir), RAW_TYPES)
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-sink-{uuid.uuid4().hex}"
    write_table(wide, path, fmt="csv", sort_by=["date"])
    schema = "date string, " + ", ".join(f"`{c}` double" for c in wide.columns[1:])
    return out(read_csv(spark, path, schema, date_cols=["date"]))


@query("p7_date_range_profile", V.with_(V.DAILY_PANEL_X, """s AS (SELECT series_id,
  CAST(sum(y) AS DOUBLE) / count(y) AS mean, quantile_cont(CAST(y AS DOUBLE), 0.5) AS median,
  stddev_samp(y) AS std, CAST(min(y) AS DOUBLE) AS min, CAST(max(y) AS DOUBLE) AS max, count(y) AS count
  FROM daily_panel WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY 1)""") + "SELECT series_id, " +
       ", ".join([V.r("mean", "mean"), V.r("median", "median"), V.r("std", "std", 2), V.r("min", "min"), V.r("max", "max"),
                  "count", V.r("max - min", "range"), V.r("std / mean * 100.0", "cv_pct"), V.r("min / mean - 1.0", "min_rel"),
                  V.r("max / mean - 1.0", "max_rel")]) + " FROM s")
def q_date_range(spark, sf_dir):
    """The scalar profile on a closed date range (bounds pushed down)."""
    p = PR.date_range_filter(_panel(spark, sf_dir), "date", "1996-01-01", "1998-12-31")
    return out(PR.scalar_profile(p, PANEL), coarse=["std"])


@query("p12_forecast_first_days", V.with_(*_FC_CTE) + "SELECT series_id, CAST(horizon AS BIGINT) AS horizon, target_date, "
       + V.r("predicted", "predicted") + " FROM prod WHERE horizon <= 3")
def q_first_days(spark, sf_dir):
    """The forecast limited to the first ``days`` horizons (1..7 checked)."""
    p = FC.first_days(_production_forecast(spark, sf_dir, False), 3)
    return out(p.select("series_id", "horizon", "target_date", "predicted"))



_LINEAR_FEATS = [*(["y"] + WEATHER_COLUMNS), *[f"consumption_lag_{k}" for k in FE.LAGS], *[f"rolling_mean_{n}" for n in FE.ROLLING_MEAN_WINDOWS],
                 *[f"rolling_std_{n}" for n in FE.ROLLING_STD_WINDOWS], *[f"trend_{n}days" for n in FE.DIFFS], "temp", "temp_lag_1", "temp_squared",
                 "humidity", "rain_amount", "rain_flag", "wind_speed", "solar_radiation", "temp_x_rain", "temp_x_humidity", "temp_x_wind", "weekday", "month",
                 "is_weekend", "weekday_sin", "weekday_cos", "month_sin", "month_cos", "is_holiday", "is_bridge_day"]


def _linear_sql(part: str) -> str:
    """Least squares of every part on the parts before it: products of all pairs of
    columns by a join, elimination column by column in a recursive query."""
    k = len(_LINEAR_FEATS)
    feats = ", ".join(f"CAST({c} AS DOUBLE)" for c in _LINEAR_FEATS)
    targets = ", ".join(f"CAST(target_next_day_{h} AS DOUBLE)" for h in range(1, 8))
    return f"""WITH RECURSIVE f AS ({_features_sql(True, rounded=False)}),
w AS (SELECT * FROM f QUALIFY date >= max(date) OVER (PARTITION BY series_id) - INTERVAL 5475 DAY),
days AS (SELECT date, row_number() OVER (ORDER BY date) AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM w)),
x AS (SELECT row_number() OVER () AS rid, CAST({part} AS INTEGER) AS part, [{feats}] AS v, [{targets}] AS t FROM w JOIN days USING (date)),
s AS (SELECT j, avg(val) AS mu, stddev_pop(val) AS sd FROM (SELECT unnest(range(1, {k + 1})) AS j, unnest(v) AS val FROM x) GROUP BY j),
st AS (SELECT list(mu ORDER BY j) AS mu, list(CASE WHEN sd > 0 THEN sd ELSE 1.0 END ORDER BY j) AS sd FROM s),
z AS (SELECT rid, part, list_concat([1.0::DOUBLE], list_transform(range(1, {k + 1}), lambda i: coalesce((v[i] - mu[i]) / sd[i], 0.0))) AS z, t FROM x, st),
cells AS (SELECT rid, part, unnest(range(1, {k + 9})) AS j, unnest(list_concat(z, t)) AS val FROM z),
g AS (SELECT a.part, a.j AS i, b.j AS j, sum(a.val * b.val) AS s FROM cells a JOIN cells b USING (rid) WHERE a.j <= {k + 1} GROUP BY ALL),
pg AS (SELECT p.part AS fold, i, j, sum(s) AS s FROM (SELECT DISTINCT part FROM z) p JOIN g ON g.part < p.part GROUP BY ALL),
m0 AS (SELECT fold, list(r ORDER BY i) AS m FROM (SELECT fold, i, list(s ORDER BY j) AS r FROM pg GROUP BY ALL) GROUP BY fold),
elim AS (
  SELECT fold, 1 AS k, m, list_transform(range(1, {k + 2}), lambda i: m[i][i]) AS d, []::BOOLEAN[] AS kept FROM m0
  UNION ALL
  SELECT fold, k + 1, CASE WHEN m[k][k] > 1e-9 * d[k] THEN list_transform(range(1, {k + 2}), lambda i: list_transform(range(1, {k + 9}),
      lambda j: CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * (m[k][j] / m[k][k]) END)) ELSE m END, d, list_append(kept, m[k][k] > 1e-9 * d[k])
  FROM elim WHERE k <= {k + 1}),
coef AS (SELECT fold, list_transform(range(1, 8), lambda h: list_transform(range(1, {k + 2}), lambda i: CASE WHEN kept[i] THEN m[i][{k + 1} + h] ELSE 0.0 END)) AS b FROM elim WHERE k = {k + 2}),
p AS (SELECT fold, 'LinearRegression' AS candidate, h AS horizon, t[h] AS y_true, list_dot_product(z, b[h]) AS y_pred
  FROM z JOIN coef ON z.part = coef.fold, (SELECT unnest(range(1, 8)) AS h))
"""


@query("d1_linear_regression_baseline", _linear_sql("pos > floor(n * 0.8)") + _metrics_sql("p", "candidate, horizon"))
def q_linear_baseline(spark, sf_dir):
    """Linear regression per horizon (h = 1..7) on all features."""
    from seriesforge.plans import train as TR
    cfg = TR.TrainConfig(horizons=list(range(1, 8)), selection="none")
    return out(TR.linear_baseline(features_table(spark, sf_dir, True), PANEL, cfg), coarse=_MCOARSE)


@query("d2_fitted_folds", _linear_sql("year(date)") + _metrics_sql("p", "fold, candidate, horizon"))
def q_fitted_folds(spark, sf_dir):
    """Linear models of all features fitted on the years before each year, which
    they predict: metrics of every fold and horizon."""
    from seriesforge.plans import train as TR
    return out(TR.fitted_folds(features_table(spark, sf_dir, True), PANEL), coarse=_MCOARSE)
