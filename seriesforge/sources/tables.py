"""Panels derived from the shared parquet tables.

Each view is a lazy DataFrame over ``{sf_dir}/{table}.parquet``; only the
needed columns reach the scan (column pruning) and every aggregation is a
partial (map-side) hash aggregate, so a hot key is reduced inside each task
before the shuffle. Money sums go through ``decimal(18,2)`` so the result does
not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.functions.scalar import nan_to_null

# The exogenous ("weather") columns of the daily table.
WEATHER_COLUMNS = [
    "temperature_2m_mean", "temperature_2m_max", "temperature_2m_min",
    "relative_humidity_2m_mean", "precipitation_sum",
    "wind_speed_10m_mean", "shortwave_radiation_sum",
]


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet scan with NaN -> NULL on double columns."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    out = [nan_to_null(f.name).alias(f.name) if f.dataType.typeName() == "double"
           else F.col(f.name) for f in df.schema.fields]
    return df.select(*out)


def _cents(c: str):
    return F.round(F.col(c) * F.lit(100.0)).cast("long")


def _money_sum(c: str, exact: bool = False):
    """Exact sum of a 2-decimal column as integer cents (long arithmetic in
    the partial aggregate; no BigDecimal buffers). ``exact`` returns
    decimal(28,2), otherwise the correctly rounded double."""
    s = F.sum(_cents(c))
    if exact:
        return (s.cast("decimal(28,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(28,2)")
    return s.cast("double") / F.lit(100.0)


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw long observations: (date_query, type, daily_accumulation, ingest_seq)."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    return o.select(
        F.to_date("o_orderdate").alias("date_query"),
        F.lower("o_orderpriority").alias("type"),
        F.col("o_totalprice").alias("daily_accumulation"),
        F.col("o_orderkey").alias("ingest_seq"),
    )


def daily_panel(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """Many-series base: (series_id, date, y).

    ``exact=True`` keeps ``y`` as an exact decimal sum, so window sums and
    means do not depend on the order in which rows are added.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_orderpriority", "o_totalprice"])
    return (o.groupBy(F.col("o_orderpriority").alias("series_id"),
                      F.to_date("o_orderdate").alias("date"))
            .agg(_money_sum("o_totalprice", exact).alias("y")))


def daily_single(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """The single national series: (series_id='all', date, y)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    return (o.groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(_money_sum("o_totalprice", exact).alias("y"))
            .select(F.lit("all").alias("series_id"), "date", "y"))


def exog_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exogenous daily table standing for weather (one row per date)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    n = F.count(F.lit(1)).cast("double")
    return (li.groupBy(F.to_date("l_shipdate").alias("date"))
            .agg((_money_sum("l_quantity") / n).alias("temperature_2m_mean"),
                 F.max("l_quantity").alias("temperature_2m_max"),
                 F.min("l_quantity").alias("temperature_2m_min"),
                 (_money_sum("l_discount") / n * F.lit(1000.0)).alias("relative_humidity_2m_mean"),
                 (_money_sum("l_tax") / n * F.lit(25.0)).alias("precipitation_sum"),
                 n.alias("wind_speed_10m_mean"),
                 (_money_sum("l_extendedprice") / n / F.lit(1000.0)).alias("shortwave_radiation_sum")))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings: (hour_ts, n_events, value_sum)."""
    e = read_table(spark, sf_dir, "events", ["ts", "value"])
    return (e.groupBy(F.date_trunc("hour", "ts").alias("hour_ts"))
            .agg(F.count(F.lit(1)).alias("n_events"), _money_sum("value").alias("value_sum")))


def sparse_panel(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """Gappy panel: (series_id=user_id, date, y)."""
    e = read_table(spark, sf_dir, "events", ["ts", "user_id", "value"])
    return (e.groupBy(F.col("user_id").cast("string").alias("series_id"),
                      F.to_date("ts").alias("date"))
            .agg(_money_sum("value", exact).alias("y")))


def base_panel(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """Daily panel joined with the exogenous table on date."""
    from seriesforge.operators.joins import join_exogenous
    return join_exogenous(daily_panel(spark, sf_dir, exact), exog_daily(spark, sf_dir))


def row_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw observations in landed row-JSON form (S3 input): one series
    per order status, one JSON array per order row:
    (series_id, date_query, ingest_seq, payload)."""
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_totalprice"])
    item = F.struct(F.initcap("o_orderpriority").alias("type"), F.col("o_totalprice").alias("daily_Accumulation"))
    return o.select(F.col("o_orderstatus").alias("series_id"), F.to_date("o_orderdate").alias("date_query"),
                    F.col("o_orderkey").alias("ingest_seq"), F.to_json(F.array(item)).alias("payload"))


def columnar_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exogenous table in landed columnar-JSON form (S4 input): one
    {"daily": {"time": [...], <var>: [...]}} document per month (at most 31
    entries each: a calendar bound)."""
    ex = exog_daily(spark, sf_dir)
    g = ex.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.array_sort(F.collect_list(F.struct("date", *WEATHER_COLUMNS))).alias("rows"))

    def field(c):
        return lambda r: r[c]
    daily = F.struct(F.transform("rows", lambda r: F.date_format(r["date"], "yyyy-MM-dd")).alias("time"),
                     *[F.transform("rows", field(c)).alias(c) for c in WEATHER_COLUMNS])
    return g.select(F.to_json(F.struct(daily.alias("daily"))).alias("payload"))
