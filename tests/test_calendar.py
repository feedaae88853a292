import datetime as dt

from pyspark.sql import functions as F

from seriesforge.functions import calendar as CAL


def test_easter_sundays(spark):
    years = CAL.year_range(spark, 1990, 2050)
    got = {r.year: r.e for r in years.select("year", F.expr(CAL.easter_sunday_expr("year")).alias("e")).collect()}
    known = {2000: dt.date(2000, 4, 23), 2008: dt.date(2008, 3, 23), 2011: dt.date(2011, 4, 24),
             2019: dt.date(2019, 4, 21), 2024: dt.date(2024, 3, 31), 2025: dt.date(2025, 4, 20),
             2038: dt.date(2038, 4, 25)}
    for y, d in known.items():
        assert got[y] == d
    assert all(got[y].weekday() == 6 for y in got)


def test_holiday_counts_and_suspension(spark):
    cal = CAL.holiday_calendar(CAL.year_range(spark, 2012, 2016))
    n = {r.y: r.n for r in cal.groupBy(F.year("date").alias("y")).agg(F.countDistinct("date").alias("n")).collect()}
    assert n[2012] == 13 and n[2016] == 13
    assert n[2013] == n[2014] == n[2015] == 9


def test_bridge_days(spark):
    df = spark.createDataFrame([(dt.date(2017, 12, 7),), (dt.date(2016, 11, 2),), (dt.date(2017, 12, 8),),
                                (dt.date(2019, 10, 29),), (dt.date(2018, 1, 2),),
                                (dt.date(2016, 12, 31),), (dt.date(2017, 1, 1),)], "date date")
    f = {r.date: (r.is_holiday, r.is_bridge_day) for r in CAL.holiday_flags(df).collect()}
    assert f[dt.date(2017, 12, 7)] == (0, 1)   # Thursday before the Friday holiday
    assert f[dt.date(2016, 11, 2)] == (0, 0)   # a Wednesday after a Tuesday holiday is no bridge
    assert f[dt.date(2017, 12, 8)] == (1, 0)
    assert f[dt.date(2017, 1, 1)] == (1, 0)
    assert f[dt.date(2018, 1, 2)] == (0, 1)    # Tuesday after New Year's Day (a Monday)
    assert f[dt.date(2019, 10, 29)] == (0, 0)


def test_date_spine(spark):
    b = spark.createDataFrame([("a", dt.date(2024, 1, 30), dt.date(2024, 2, 2))], "k string, start date, end date")
    assert [r.date for r in CAL.date_spine(b).orderBy("date").collect()] == [
        dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 2, 2)]


def test_expression_flags_equal_table_flags(spark):
    days = spark.range(0, 366 * 62).select(F.date_add(F.lit("1989-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    by_expr = CAL.holiday_flags(days)
    by_table = CAL.holiday_flags(days, holidays=CAL.holiday_calendar(CAL.year_range(spark, 1988, 2052)))
    diff = by_expr.exceptAll(by_table.select(*by_expr.columns))
    assert diff.count() == 0
    assert by_expr.where("is_holiday = 1").count() > 13 * 60
