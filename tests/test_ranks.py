"""Ranks, positions and what follows from them against plain Python on hot,
null, repeated and empty groups, with many range partitions."""

from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import features as FE
from seriesforge.operators import ranks as RK
from seriesforge.spec import SeriesSpec


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = [("hot", 7.0)] * 400 + [("hot", float(x)) for x in rng.integers(0, 50, 300)] + [(None, float(x)) for x in rng.normal(size=120)]
    data += [("one", 3.5), ("nulls", None), ("nulls", None), ("some", None), ("some", 1.0), ("some", 2.0)]
    return spark.createDataFrame(data, "k string, x double").repartition(9)


def groups(rows):
    out = {}
    for r in rows.collect():
        if r.x is not None:
            out.setdefault(r.k, []).append(r.x)
    return {k: sorted(v) for k, v in out.items()}


def test_value_ranks(rows):
    want = {(k, x): (v.count(x), sum(y < x for y in v), len(v)) for k, v in groups(rows).items() for x in v}
    got = RK.value_ranks(rows, ["k"], "x").collect()
    assert {(r.k, r.x): (r.n, r.below, r.total) for r in got} == want and len(got) == len(want)


def test_positions_are_gapless_and_keep_rows(rows):
    got = RK.row_positions(rows, ["k"], ["x"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.position, r.x))
    for k, v in by.items():
        v.sort()
        assert [p for p, _ in v] == list(range(len(v)))
        values = [x for _, x in v]
        assert values == sorted(values, key=lambda x: (x is not None, x or 0.0))
    assert sorted(map(str, ((r.k, r.x) for r in got))) == sorted(map(str, ((r.k, r.x) for r in rows.collect())))


def test_quantiles_equal_percentile(rows):
    levels = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r.q for r in RK.exact_quantiles(RK.value_ranks(rows, ["k"], "x"), ["k"], "x", levels).collect()}
    spark_own = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("x", levels).alias("q")).collect() if r.q is not None}
    assert got.keys() == spark_own.keys()
    for k, v in groups(rows).items():
        assert got[k] == pytest.approx(spark_own[k], abs=1e-12)
        assert got[k] == pytest.approx(list(np.quantile(v, levels)), abs=1e-12)


def test_one_point_a_row_in_blocks(rows, monkeypatch):
    monkeypatch.setattr(RK, "BLOCK", 16)
    got = {}
    for r in RK.expand_ranks(RK.value_ranks(rows, ["k"], "x"), ["k"], "x").collect():
        got.setdefault(r.k, []).append((r.position, r.x))
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == groups(rows)
    assert all(sorted(p for p, _ in v) == list(range(1, len(v) + 1)) for v in got.values())


def test_normal_quantile(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.001, 0.074, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-12]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(RK.normal_quantile("p").alias("z")).collect()
    assert [r.z for r in got] == pytest.approx([NormalDist().inv_cdf(p) for p in ps], rel=1e-12, abs=1e-12)


def test_normality_tells_normal_from_skewed(spark):
    rng = np.random.default_rng(1)
    data = [("normal", float(x)) for x in rng.normal(10, 3, 2000)] + [("skewed", float(x)) for x in rng.exponential(size=2000)]
    data += [("flat", 1.0)] * 50 + [("few", 1.0), ("few", 2.0), ("few", None)]
    got = {r.k: r for r in RK.order_normality(spark.createDataFrame(data, "k string, x double"), ["k"], "x").collect()}
    assert got["normal"].is_normal == 1 and got["skewed"].is_normal == 0
    assert got["flat"].is_normal is None and got["few"].is_normal is None and got["few"].n == 2
    x = np.sort([x for k, x in data if k == "normal"])
    z = [NormalDist().inv_cdf((i + 0.625) / 2000.25) for i in range(2000)]
    assert got["normal"].w == pytest.approx(np.corrcoef(x, z)[0, 1] ** 2, abs=1e-9)


def test_empty(spark):
    none = spark.createDataFrame([], "k string, x double")
    assert RK.value_ranks(none, ["k"], "x").count() == RK.row_positions(none, ["k"], ["x"]).count() == RK.order_normality(none, ["k"], "x").count() == 0
    assert RK.order_normality(none, [], "x").count() == 0


def test_buckets_equal_whole_series(spark):
    rng = np.random.default_rng(3)
    data = [(k, int(d), None if rng.random() < 0.1 else float(v)) for k, n in (("long", 700), ("b", 45), (None, 3))
            for d, v in zip(np.cumsum(rng.integers(1, 4, n)), rng.normal(size=n))]
    df = spark.createDataFrame(data, "series_id string, date int, y double").repartition(5)
    spec = SeriesSpec()
    want = sorted(map(str, FE.lag_features(df, spec).collect()))
    for size in (30, 64, 10_000):
        out = FE.lag_features_in_buckets(df, spec, bucket_rows=size)
        assert sorted(map(str, out.collect())) == want
    with pytest.raises(ValueError):
        FE.lag_features_in_buckets(df, spec, bucket_rows=29)


def test_no_window_holds_a_series(spark):
    df = spark.range(2000).select(F.lit("a").alias("series_id"), F.col("id").alias("date"), F.col("id").cast("double").alias("y"))
    plan = FE.lag_features_in_buckets(df, SeriesSpec(), bucket_rows=100)._jdf.queryExecution().executedPlan().toString()
    lags = [line for line in plan.splitlines() if "Window [lag(" in line]
    assert lags and all("__bucket" in line for line in lags)


def test_split_by_rank(spark):
    df = spark.createDataFrame([(i, None if i == 3 else i // 2) for i in range(40)], "id int, t int")
    got = {r.id: r.is_train for r in RK.cut_by_rank(df, "t", 0.75).collect()}
    assert got == {i: int(i // 2 < 15) for i in range(40) if i != 3}
