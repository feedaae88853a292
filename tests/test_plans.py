"""Plan shape: one exchange on the series key for the whole feature step,
no Python on the data path, filters and columns pushed to the scan."""

import re

from paths import SF_SMALL
from seriesforge.operators import features as FE
from seriesforge.operators import profile as PR
from seriesforge.plans.catalog import PANEL, QUERIES
from seriesforge.sources import tables as T


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_windows_share_one_exchange(spark):
    b = T.base_panel(spark, SF_SMALL, exact=True)
    p = plan(FE.build_features(b, PANEL, training=True))
    # all lag/lead/rolling windows and the mean fill use hashpartitioning(series_id)
    assert len(re.findall(r"Exchange hashpartitioning\(series_id", p)) == 1, p
    assert len(re.findall(r"\bSort \[", p)) == 1, p


def test_no_python_and_no_cross_products(spark):
    for name in ["features_train", "a19_kernel_density", "j6_f16_nearest_hour_lookup",
                 "j7_attach_by_position", "d5_error_by_segment", "m8_j2_j3_forecast_latest"]:
        p = plan(QUERIES[name](spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_date_filter_and_columns_reach_the_scan(spark):
    o = T.read_table(spark, SF_SMALL, "orders", ["o_orderdate", "o_totalprice"])
    df = PR.date_range_filter(o, "o_orderdate", "1996-01-01", "1996-12-31")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(schema.split(",")) == ["o_orderdate:timestamp_ntz", "o_totalprice:double"]


def test_keep_last_is_a_partial_aggregate(spark):
    p = plan(QUERIES["w10_u2_keep_last"](spark, SF_SMALL))
    assert "partial_max_by" in p and "Window" not in p


def test_panel_and_raw_rows_stay_where_they_are(spark):
    """J1 and the keyless J6 send the calendar-sized side, not the large one."""
    base = plan(T.base_panel(spark, SF_SMALL, exact=True))
    assert "BroadcastHashJoin" in base and "SortMergeJoin" not in base
    # the topmost join is the one of the raw rows
    p = plan(QUERIES["j6_f16_nearest_hour_lookup"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in next(line for line in p.splitlines() if "Join" in line)


def test_latest_and_keep_last_hash(spark):
    for name in ["s6_latest_row", "w10_u2_keep_last", "i3_u1_upsert"]:
        df = QUERIES[name](spark, SF_SMALL)
        assert "max_by" in plan(df)
    kept = QUERIES["w10_u2_keep_last"](spark, SF_SMALL)
    assert "HashAggregate" in plan(kept)
