"""Edge rules of the served forecast tables on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from seriesforge.functions import scalar as S
from seriesforge.operators import forecast as FC
from seriesforge.spec import SeriesSpec


def test_w8_w9_change_bases(spark):
    rows = [("a", 1, 110.0, 100.0), ("a", 2, 99.0, 100.0), ("b", 1, 5.0, 0.0), ("b", 2, 0.0, 0.0), ("b", 3, 3.0, 0.0),
            ("c", 1, 7.0, None)]
    fc = spark.createDataFrame(rows, "series_id string, horizon int, predicted double, last_value double")
    r = {(x.series_id, x.horizon): (x.change_pct, x.change_vs_last_pct)
         for x in FC.change_columns(fc, ["series_id"]).collect()}
    assert r[("a", 1)] == (10.0, 10.0)
    assert round(r[("a", 2)][0], 6) == -10.0 and r[("a", 2)][1] == -1.0
    assert r[("b", 1)] == (None, 0.0)      # base 0: "-" for W8, 0 for W9
    assert r[("b", 3)] == (None, 0.0)      # previous forecast 0: "-"
    assert r[("c", 1)] == (None, 0.0)      # missing last value


def test_f10_f11_d3_intervals(spark):
    fc = spark.createDataFrame([(1, 100.0, 2.5, None), (1, 50.0, None, 3.0)],
                               "horizon int, predicted double, mae double, rmse double")
    nd = {x.predicted: (x.lower, x.upper) for x in FC.next_day(fc).collect()}
    assert nd == {100.0: (97.5, 102.5), 50.0: (45.0, 55.0)}  # MAE default 5.0
    lo, hi = S.interval_bounds("predicted", "rmse", FC.DEFAULT_RMSE)
    b = {x.predicted: (x.lo, x.hi) for x in fc.select("predicted", lo.alias("lo"), hi.alias("hi")).collect()}
    assert b == {100.0: (94.5, 105.5), 50.0: (47.0, 53.0)}  # RMSE default 5.5
    iv = FC.intervals(fc).where("predicted = 100.0").first()
    assert (iv.lower_95, iv.upper_95) == (95.1, 104.9)


def test_label_boundaries(spark):
    df = spark.createDataFrame([(x,) for x in [None, 0.0, 0.5, 5.0, 5.5]], "v double")
    got = [r.c for r in df.select(S.weather_condition("v").alias("c")).collect()]
    assert got == ["Clear", "Clear", "Clouds", "Clouds", "Rain"]
    r = spark.createDataFrame([(x,) for x in [0.71, -0.6, 0.3, 0.31]], "r double")
    assert [x.s for x in r.select(S.correlation_strength("r").alias("s")).collect()] == \
        ["Very Strong", "Strong", "Weak", "Moderate"]
    m = spark.createDataFrame([(x,) for x in [2.9, 3.0, 5.0, 10.0, 10.1]], "m double")
    assert [x.t for x in m.select(S.mape_tier("m").alias("t")).collect()] == \
        ["Excellent", "Good", "Good", "Reasonable", "Poor"]
    sp = spark.createDataFrame([(x,) for x in [1.9, 2.0, 3.0]], "s double")
    assert [x.c for x in sp.select(S.confidence_bucket("s").alias("c")).collect()] == ["high", "medium", "low"]


def test_o2_s6_latest_rows(spark):
    d0 = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", d0 + dt.timedelta(days=i), float(i)) for i in range(10)] +
                               [("b", d0, 1.0)], "series_id string, date date, y double")
    spec = SeriesSpec(("series_id",), "date", "y")
    assert FC.last_rows(df, spec, 3).where("series_id = 'a'").agg(F.min("y")).first()[0] == 7.0
    lr = {r.series_id: r.y for r in FC.latest_row(df, spec).collect()}
    assert lr == {"a": 9.0, "b": 1.0}
