"""Calendar tables (C1, C2) and calendar flags.

The default flags are per-row column expressions (fixed month/day pairs and
Easter arithmetic on the row's year), so they need no lookup table at all. A
user-supplied calendar table is joined instead; it is built per year, so its
size is bounded by 13 rows per year, which makes its broadcast safe at any
data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# National holidays (public law). (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (4, 25, "Freedom Day"),
    (5, 1, "Labour Day"),
    (6, 10, "Portugal Day"),
    (8, 15, "Assumption Day"),
    (10, 5, "Republic Day"),
    (11, 1, "All Saints' Day"),
    (12, 1, "Restoration of Independence"),
    (12, 8, "Immaculate Conception"),
    (12, 25, "Christmas Day"),
]
# Movable holidays as day offsets from Easter Sunday.
EASTER_HOLIDAYS = [
    (-2, "Good Friday"),
    (0, "Easter Sunday"),
    (60, "Corpus Christi"),
]
# Holidays suspended in 2013, 2014 and 2015.
SUSPENDED_NAMES = ["Corpus Christi", "Republic Day", "All Saints' Day",
                   "Restoration of Independence"]
SUSPENDED_YEARS = (2013, 2015)


def easter_sunday_expr(year: str = "year") -> str:
    """Gregorian Easter Sunday of an integer year column (anonymous
    Gregorian algorithm, as published by Meeus), as a Spark SQL expression."""
    y = f"({year})"
    a = f"({y} % 19)"
    b = f"({y} div 100)"
    c = f"({y} % 100)"
    d = f"({b} div 4)"
    e = f"({b} % 4)"
    f_ = f"(({b} + 8) div 25)"
    g = f"(({b} - {f_} + 1) div 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i = f"({c} div 4)"
    k = f"({c} % 4)"
    ll = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {ll}) div 451)"
    n = f"({h} + {ll} - 7 * {m} + 114)"
    return f"make_date({y}, cast({n} div 31 as int), cast({n} % 31 + 1 as int))"


def years_of(df: DataFrame, time_col: str = "date", pad: int = 1) -> DataFrame:
    """One row per year spanned by ``df`` (min-pad .. max+pad). One global
    aggregate (partial per task) then a bounded explode."""
    return (df.agg(F.min(F.year(time_col)).alias("y0"), F.max(F.year(time_col)).alias("y1"))
            .where(F.col("y0").isNotNull())
            .select(F.explode(F.sequence(F.col("y0") - pad, F.col("y1") + pad)).alias("year")))


def year_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def holiday_calendar(years: DataFrame) -> DataFrame:
    """(date, name) for every year row in ``years``."""
    fixed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("name"))
                      for m, d, n in FIXED_HOLIDAYS])
    movable = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(n).alias("name"))
                        for o, n in EASTER_HOLIDAYS])
    fx = (years.select("year", F.explode(fixed).alias("h"))
          .select("year", F.make_date("year", F.col("h.m"), F.col("h.d")).alias("date"),
                  F.col("h.name").alias("name")))
    mv = (years.select("year", F.expr(easter_sunday_expr("year")).alias("easter"),
                       F.explode(movable).alias("h"))
          .select("year", F.date_add("easter", F.col("h.o")).alias("date"),
                  F.col("h.name").alias("name")))
    lo, hi = SUSPENDED_YEARS
    suspended = F.col("year").between(lo, hi) & F.col("name").isin(SUSPENDED_NAMES)
    return fx.unionByName(mv).where(~suspended).select("date", "name")


def calendar_flags(holidays: DataFrame) -> DataFrame:
    """(date, is_holiday, is_bridge_day) for holiday dates and their bridge
    neighbours: a Thursday before a holiday, a Tuesday after one (J5)."""
    h = holidays.select("date").distinct()
    hol = h.select("date", F.lit(1).alias("is_holiday"), F.lit(0).alias("is_bridge_day"))
    thu = (h.select(F.date_sub("date", 1).alias("date"))
           .where(F.weekday("date") == 3))
    tue = (h.select(F.date_add("date", 1).alias("date"))
           .where(F.weekday("date") == 1))
    br = thu.unionByName(tue).select("date", F.lit(0).alias("is_holiday"),
                                     F.lit(1).alias("is_bridge_day"))
    return (hol.unionByName(br).groupBy("date")
            .agg(F.max("is_holiday").alias("is_holiday"),
                 F.max("is_bridge_day").alias("is_bridge_day")))


def is_holiday_sql(date: str) -> str:
    """SQL text of :func:`is_holiday` for a date expression ``date``."""
    y = f"year({date})"
    lo, hi = SUSPENDED_YEARS
    susp = f"({y} BETWEEN {lo} AND {hi})"
    terms = []
    for mm, d, name in FIXED_HOLIDAYS:
        t = f"(month({date}) = {mm} AND dayofmonth({date}) = {d})"
        terms.append(f"({t} AND NOT {susp})" if name in SUSPENDED_NAMES else t)
    easter = easter_sunday_expr(y)
    for off, name in EASTER_HOLIDAYS:
        t = f"({date} = date_add({easter}, {off}))"
        terms.append(f"({t} AND NOT {susp})" if name in SUSPENDED_NAMES else t)
    return "CAST((" + " OR ".join(terms) + ") AS INT)"


def is_holiday(date: str) -> Column:
    """J4 as a per-row expression: 1 when the date column ``date`` is a
    national holiday of the default calendar (any year, no lookup table).
    Built as one SQL expression (one call into the JVM)."""
    return F.expr(is_holiday_sql(f"`{date}`"))


def is_bridge_day(date: str) -> Column:
    """J5 as a per-row expression: a Thursday before a holiday or a Tuesday
    after one."""
    d = f"`{date}`"
    nxt, prv = is_holiday_sql(f"date_add({d}, 1)"), is_holiday_sql(f"date_sub({d}, 1)")
    return F.expr(f"CAST(((weekday({d}) = 3 AND {nxt} = 1) OR (weekday({d}) = 1 AND {prv} = 1)) AS INT)")


def holiday_flags(df: DataFrame, time_col: str = "date",
                  holidays: DataFrame | None = None) -> DataFrame:
    """J4 + J5 as one broadcast lookup instead of a per-row loop.

    Without ``holidays`` the default calendar is evaluated per row as
    column expressions (:func:`is_holiday`, :func:`is_bridge_day`): no join,
    no year range. ``holidays`` may be any (date, name) calendar table; it
    is then turned into (date, flags) rows - at most 3 per holiday - and
    broadcast.
    """
    if holidays is None:
        # default calendar: pure column expressions, no join and no broadcast
        return df.select("*", is_holiday(time_col).alias("is_holiday"),
                         is_bridge_day(time_col).alias("is_bridge_day"))
    flags = calendar_flags(holidays).withColumnRenamed("date", "__cal_date")
    out = (df.join(F.broadcast(flags), F.col(time_col) == F.col("__cal_date"), "left")
           .drop("__cal_date"))
    return (out.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))
               .withColumn("is_bridge_day", F.coalesce("is_bridge_day", F.lit(0))))


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end",
               out: str = "date") -> DataFrame:
    """One row per day between ``start`` and ``end`` inclusive, for every
    row of ``bounds`` (other columns, e.g. series keys, are kept)."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*keep, F.explode(F.sequence(F.col(start), F.col(end),
                                                     F.expr("interval 1 day"))).alias(out))
