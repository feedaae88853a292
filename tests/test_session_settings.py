"""Answers must not depend on the session time zone or on ANSI mode."""

import pytest

from paths import SF_SMALL
from seriesforge.plans.catalog import ORACLE, QUERIES
import oracle_harness as H

SENSITIVE = ["j6_f16_nearest_hour_lookup", "f16_f17_time_and_json", "d8_hourly_to_daily",
             "features_train", "a7_scalar_profile", "w_sparse_panel_lags"]


@pytest.mark.parametrize("tz,ansi", [("America/Los_Angeles", "false"), ("Asia/Kolkata", "true")])
def test_other_time_zone_and_ansi(spark, tz, ansi):
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.session.timeZone", tz)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        con = H.duck(SF_SMALL)
        for name in SENSITIVE:
            assert not H.compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)
