"""Correlations where a column does not vary inside a series."""

import datetime as dt
import math

import duckdb
import oracle_harness as H
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import profile as PR
from seriesforge.plans.catalog import ORACLE, QUERIES

NAMES = ["a14_f13_target_correlations", "a15_correlation_matrix", "a16_exog_trends", "a16_trend_lines", "a20_qq_points"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Every date ships a smallest and a largest quantity, so both are constant; the
    series 5-LOW has the same value on every date, 4-LATE only one date."""
    to = tmp_path_factory.mktemp("constant")
    days = [dt.datetime(1996, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    orders = [(1 + i, day, "1-URGENT", 100.0 + 7 * (i * i % 11)) for i, day in enumerate(days)]
    orders += [(101 + i, day, "5-LOW", 50.0) for i, day in enumerate(days)] + [(201, days[3], "4-LATE", 9.5)]
    lines = [(q, 10.0 * q + i % 5, (i % 7) / 100, (i % 3) / 100, day) for i, day in enumerate(days) for q in (1.0, 50.0, float(2 + i % 9))]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double").write.parquet(f"{to}/orders.parquet")
    spark.createDataFrame(lines, "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(f"{to}/lineitem.parquet")
    return str(to)


@pytest.mark.parametrize("name", NAMES)
def test_constant_columns_match_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    problems = H.compare(spark, name, QUERIES[name], ORACLE[name], tables, con)
    assert not problems, problems


def test_pearson_by_pairs(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 4.0), (2.0, 5.0, 4.0), (None, 9.0, 4.0), (4.0, 1.0, 4.0), (7.0, None, 4.0)], "x double, y double, c double")
    x, y, c, none = F.col("x"), F.col("y"), F.col("c"), F.lit(None).cast("double")
    r, constant, empty, plain = rows.agg(PR.pearson(x, y), PR.pearson(x, c), PR.pearson(x, none), F.corr(x, y)).first()
    assert abs(r - plain) < 1e-12 and math.isnan(constant) and empty is None
