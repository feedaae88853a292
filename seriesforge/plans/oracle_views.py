"""DuckDB text of the derived views, used only by the oracle SQL.

They restate ``seriesforge.sources.tables`` so that each oracle query can be
run by DuckDB over the raw parquet views.
"""

DAILY_PANEL = """daily_panel AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY 1, 2)"""

DAILY_SINGLE = """daily_single AS (
  SELECT 'all' AS series_id, CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY 2)"""

RAW_LONG = """raw_long AS (
  SELECT CAST(o_orderdate AS DATE) AS date_query, lower(o_orderpriority) AS type,
         o_totalprice AS daily_accumulation, o_orderkey AS ingest_seq
  FROM orders)"""

EXOG_DAILY = """exog_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
    CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS temperature_2m_mean,
    MAX(l_quantity) AS temperature_2m_max,
    MIN(l_quantity) AS temperature_2m_min,
    CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 1000.0 AS relative_humidity_2m_mean,
    CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 25.0 AS precipitation_sum,
    CAST(COUNT(*) AS DOUBLE) AS wind_speed_10m_mean,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) / 1000.0 AS shortwave_radiation_sum
  FROM lineitem GROUP BY 1)"""

HOURLY = """hourly AS (
  SELECT date_trunc('hour', ts) AS hour_ts, COUNT(*) AS n_events,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
  FROM events GROUP BY 1)"""

SPARSE_PANEL = """sparse_panel AS (
  SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""

BASE_PANEL = """base_panel AS (
  SELECT p.*, e.* EXCLUDE (date) FROM daily_panel p JOIN exog_daily e USING (date))"""


def easter_sql(y: str) -> str:
    a = f"({y} % 19)"
    b = f"({y} // 100)"
    c = f"({y} % 100)"
    d = f"({b} // 4)"
    e = f"({b} % 4)"
    f = f"(({b} + 8) // 25)"
    g = f"(({b} - {f} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i = f"({c} // 4)"
    k = f"({c} % 4)"
    ll = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {ll}) // 451)"
    n = f"({h} + {ll} - 7 * {m} + 114)"
    return f"make_date(CAST({y} AS BIGINT), CAST({n} // 31 AS BIGINT), CAST({n} % 31 + 1 AS BIGINT))"


def holidays_sql(source: str, time_col: str = "date") -> str:
    """CTEs ``years``, ``holidays`` (date, name) and ``cal_flags`` over the
    years of ``source`` padded by one on each side."""
    from seriesforge.functions.calendar import (EASTER_HOLIDAYS, FIXED_HOLIDAYS,
                                                SUSPENDED_NAMES, SUSPENDED_YEARS)
    fixed = ", ".join(f"({m}, {d}, '{n.replace(chr(39), chr(39) * 2)}')" for m, d, n in FIXED_HOLIDAYS)
    mov = ", ".join(f"({o}, '{n}')" for o, n in EASTER_HOLIDAYS)
    susp = ", ".join("'" + n.replace("'", "''") + "'" for n in SUSPENDED_NAMES)
    lo, hi = SUSPENDED_YEARS
    return f"""years AS (
  SELECT UNNEST(range(CAST(min(year({time_col})) - 1 AS BIGINT), CAST(max(year({time_col})) + 2 AS BIGINT))) AS year
  FROM {source}),
fixed_h(m, d, name) AS (VALUES {fixed}),
mov_h(o, name) AS (VALUES {mov}),
holidays_all AS (
  SELECT year, make_date(CAST(year AS BIGINT), CAST(m AS BIGINT), CAST(d AS BIGINT)) AS date, name FROM years, fixed_h
  UNION ALL
  SELECT year, CAST({easter_sql('year')} + o * INTERVAL 1 DAY AS DATE) AS date, name FROM years, mov_h),
holidays AS (
  SELECT date, name FROM holidays_all
  WHERE NOT (year BETWEEN {lo} AND {hi} AND name IN ({susp}))),
cal_flags AS (
  SELECT date, max(is_holiday) AS is_holiday, max(is_bridge_day) AS is_bridge_day FROM (
    SELECT DISTINCT date, 1 AS is_holiday, 0 AS is_bridge_day FROM holidays
    UNION ALL
    SELECT CAST(date - INTERVAL 1 DAY AS DATE), 0, 1 FROM holidays WHERE isodow(date - INTERVAL 1 DAY) = 4
    UNION ALL
    SELECT CAST(date + INTERVAL 1 DAY AS DATE), 0, 1 FROM holidays WHERE isodow(date + INTERVAL 1 DAY) = 2
  ) GROUP BY date)"""

# Exact variants: y stays a DECIMAL sum (the Spark side passes exact=True).
DAILY_PANEL_X = """daily_panel AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS y
  FROM orders GROUP BY 1, 2)"""

DAILY_SINGLE_X = """daily_single AS (
  SELECT 'all' AS series_id, CAST(o_orderdate AS DATE) AS date,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS y
  FROM orders GROUP BY 2)"""

SPARSE_PANEL_X = """sparse_panel AS (
  SELECT CAST(user_id AS VARCHAR) AS series_id, CAST(ts AS DATE) AS date,
         SUM(CAST(value AS DECIMAL(18,2))) AS y
  FROM events GROUP BY 1, 2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, alias: str, scale: int = 4) -> str:
    """Rounded double output column."""
    x = f"CAST({expr} AS DOUBLE)"
    p = float(10 ** scale)
    return f"(CASE WHEN abs({x}) < 1e15 THEN floor({x} * {p} + 0.5) / {p} + 0.0 ELSE {x} END) AS {alias}"


def guarded(fn: str, col: str, w: int, part: str = "series_id", order: str = "date",
            lo: int | None = None, hi: int = -1) -> str:
    lo = w if lo is None else -lo
    frame = (f"ROWS BETWEEN {lo} PRECEDING AND " +
             (f"{-hi} PRECEDING" if hi < 0 else ("CURRENT ROW" if hi == 0 else f"{hi} FOLLOWING")))
    pb = f"PARTITION BY {part} " if part else ""
    win = f"OVER ({pb}ORDER BY {order} {frame})"
    val = (f"CAST(sum({col}) {win} AS DOUBLE) / {float(w)}" if fn == "avg"
           else f"{fn}({col}) {win}")
    return f"CASE WHEN count({col}) {win} = {w} THEN {val} END"
