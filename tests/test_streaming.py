"""Incremental landing as a stream: new files only, latest record wins,
re-running the same stream does nothing twice."""

import json
import os

from seriesforge.streaming import landing as L


def write_docs(path, docs):
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_stream_landing_latest_wins(spark, tmpdir_path):
    land, log, ck = (os.path.join(tmpdir_path, x) for x in ("landing", "log", "ckpt"))
    os.makedirs(land)
    write_docs(os.path.join(land, "a.json"), [
        {"date_query": "2024-01-01", "items": [{"type": "Solar", "daily_Accumulation": 10},
                                               {"type": "Wind", "daily_Accumulation": "20.5"},
                                               {"daily_Accumulation": 3}, {"type": "Hydro"}]},
        {"date_query": "2024-01-02", "items": [{"type": "Solar", "daily_Accumulation": 11}]},
        {"date_query": "not-a-date", "items": [{"type": "Solar", "daily_Accumulation": 99}]},
    ])
    L.start_landing_stream(spark, land, log, ck).awaitTermination()
    cur = {(str(r.date_query), r.type): r.daily_accumulation for r in L.current_table(spark, log).collect()}
    assert cur == {("2024-01-01", "solar"): 10.0, ("2024-01-01", "wind"): 20.5, ("2024-01-02", "solar"): 11.0}

    # a revision arrives later; the second run only reads the new file
    write_docs(os.path.join(land, "b.json"), [
        {"date_query": "2024-01-01", "items": [{"type": "SOLAR", "daily_Accumulation": 12.5}]}])
    L.start_landing_stream(spark, land, log, ck).awaitTermination()
    cur = {(str(r.date_query), r.type): r.daily_accumulation for r in L.current_table(spark, log).collect()}
    assert cur[("2024-01-01", "solar")] == 12.5
    assert L.log_table(spark, log).count() == 4  # 3 + 1: nothing landed twice
    assert str(L.high_water_mark(spark, log, "2010-01-01").first().last_date) == "2024-01-02"

    # no new file: the stream is a no-op
    L.start_landing_stream(spark, land, log, ck).awaitTermination()
    assert L.log_table(spark, log).count() == 4
    out = os.path.join(tmpdir_path, "compacted")
    L.compact(spark, log, out)
    assert spark.read.parquet(out).count() == 3
