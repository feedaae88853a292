"""Property tests against brute force on small random fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seriesforge.operators import features as FE
from seriesforge.operators import ingest as IN
from seriesforge.operators.joins import nearest_time_join
from seriesforge.spec import SeriesSpec

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2024, 1, 1)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40),
       st.sampled_from([2, 3, 7]))
def test_rolling_matches_pandas(spark, vals, w):
    rows = [("a", D0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = FE.lag_features(df, SeriesSpec(("k",), "date", "v"), lags=[1, w], leads=[1],
                          mean_windows=[w], std_windows=[w], diffs=[w]).orderBy("date").toPandas()
    s = pd.Series([np.nan if v is None else float(v) for v in vals])
    np.testing.assert_allclose(got[f"rolling_mean_{w}"].astype(float), s.shift(1).rolling(w).mean(), equal_nan=True)
    np.testing.assert_allclose(got[f"rolling_std_{w}"].astype(float), s.shift(1).rolling(w).std(),
                               equal_nan=True, atol=1e-9)
    np.testing.assert_allclose(got[f"lag_{w}"].astype(float), s.shift(w), equal_nan=True)
    np.testing.assert_allclose(got["target_next_day_1"].astype(float), s.shift(-1), equal_nan=True)
    np.testing.assert_allclose(got[f"trend_{w}days"].astype(float), s.diff(w), equal_nan=True)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["Solar", "solar", "Wind X", "wind x", "hydro"]),
                          st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=30))
def test_pivot_matches_pandas(spark, recs):
    rows = [(D0 + dt.timedelta(days=d), t, None if v is None else float(v), i) for i, (d, t, v) in enumerate(recs)]
    df = spark.createDataFrame(rows, "date_query date, type string, daily_accumulation double, ingest_seq long")
    values = ["solar", "wind x", "hydro"]
    got = IN.pivot_wide(df, values).toPandas().set_index("date").sort_index()
    p = pd.DataFrame(rows, columns=["date", "type", "v", "seq"]).dropna(subset=["v"])
    p["type"] = p["type"].str.lower().str.replace(" ", "_")
    p = p.sort_values("seq").drop_duplicates(["date", "type"], keep="last")
    exp = p.pivot_table(index="date", columns="type", values="v", aggfunc="first")
    for c in ["solar", "wind_x", "hydro"]:
        e = exp[c] if c in exp.columns else pd.Series(np.nan, index=exp.index)
        g = got[c].reindex(exp.index) if len(exp) else got[c]
        np.testing.assert_allclose(g.astype(float).values, e.astype(float).values, equal_nan=True)
    assert len(got) == len(exp)


@SETTINGS
@given(st.lists(st.integers(0, 24 * 6 * 60), min_size=1, max_size=25),
       st.lists(st.integers(0, 24 * 6), min_size=1, max_size=12, unique=True),
       st.sampled_from([3600, 86400, 4 * 86400]))
def test_nearest_time_matches_brute_force(spark, left_min, right_h, bucket):
    base = dt.datetime(2024, 1, 1)
    left = [(i, "k1" if i % 2 else "k2", base + dt.timedelta(minutes=m)) for i, m in enumerate(left_min)]
    right = [(k, base + dt.timedelta(hours=h), float(h)) for h in right_h for k in ("k1", "k2") if (h + len(k)) % 3]
    if not right:
        return
    L = spark.createDataFrame(left, "id long, key string, ts timestamp_ntz")
    R = spark.createDataFrame(right, "key string, hour_ts timestamp_ntz, val double")
    got = {r.id: r.val for r in nearest_time_join(L, R, "ts", "hour_ts", ["key"], "hour", bucket).collect()}
    for i, k, ts in left:
        target = ts.replace(minute=0, second=0, microsecond=0)
        cands = [(abs((t - target).total_seconds()), t, v) for kk, t, v in right if kk == k]
        exp = min(cands)[2] if cands else None
        assert got[i] == exp, (i, k, ts)
