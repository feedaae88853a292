"""End to end on payloads derived from the shared tables: two collection
runs (the second only lands days after the mark), features, training with
registry, forecast documents, profile tables."""

import json
import os

from pyspark.sql import functions as F

from paths import SF_SMALL
from seriesforge.plans import train as TR
from seriesforge.plans.pipeline import Pipeline
from seriesforge.sources import store
from seriesforge.sources import tables as T
from seriesforge.sources.store import read_latest
from seriesforge.sources.tables import WEATHER_COLUMNS


def test_full_pipeline(spark, tmpdir_path):
    raw = T.raw_long(spark, SF_SMALL)
    rows = T.row_payloads(spark, SF_SMALL)
    docs = T.columnar_payloads(spark, SF_SMALL)

    p = Pipeline("file://" + os.path.join(tmpdir_path, "pipe"), wide_values=["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"],
                 target="1-urgent", exog_variables=WEATHER_COLUMNS, default_start="1992-01-01")
    first = rows.where(F.col("date_query") < F.lit("1999-01-01").cast("date"))
    c1 = p.collect(spark, first, docs)
    assert c1["missing_columns"] == [] and len(c1["raw_months"]) > 12
    c2 = p.collect(spark, rows)  # re-sends old days too: only days after the mark land
    assert min(c2["raw_months"]) >= "1998-12" and store.versions(spark, p.path("wide")) == [1, 2]
    # latest record per (series, day, type): the distinct keys of all rows sent
    assert spark.read.parquet(p.path("raw")).count() == rows.select("series_id", "date_query", "ingest_seq").join(
        raw.select("ingest_seq", "type"), "ingest_seq").select("series_id", "date_query", "type").distinct().count()
    assert read_latest(spark, p.path("base")).count() > 0
    fr = {r.stage: r.stale for r in p.freshness(spark, "2001-08-02").collect()}
    assert fr == {"raw": 0, "exogenous": 1}  # orders end 2001-08-01, the exogenous table later

    p.features(spark)
    cfg = TR.TrainConfig(horizons=[1, 2], profile="smoke", top_k=8)
    res = p.train(spark, cfg)
    assert {r.action for r in res["decisions"].collect()} == {"promoted_first"}
    path = p.predict(spark)
    docs_out = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(docs_out) == 3 and all(set(d["predictions"]) == {"day_1", "day_2"} for d in docs_out)
    day = docs_out[0]["predictions"]["day_1"]
    assert docs_out[0]["generated_at"] and set(day["weather"]) <= set(WEATHER_COLUMNS) and "RMSE" in day["metrics"]
    summ = p.summary(spark).collect()
    assert len(summ) == 3 and all(r.n_models == 2 and r.n_rows > 0 for r in summ)
    prof = p.profile(spark)
    assert spark.read.parquet(prof["scalar"]).count() == 3


def test_absent_target_stops_before_any_write(spark, tmpdir_path):
    p = Pipeline(os.path.join(tmpdir_path, "pipe"), wide_values=["1-URGENT", "9-NONE"], target="9-none", default_start="1992-01-01")
    try:
        p.collect(spark, T.row_payloads(spark, SF_SMALL))
        raise AssertionError("no error")
    except ValueError as e:
        assert "9-none" in str(e)
    assert not store.exists(spark, p.path("raw")) and store.names(spark, p.path("wide")) == []
