import datetime as dt
import os

from seriesforge.operators import ingest as IN


def files_of(path):
    return {(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_rewrites_only_touched_months(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "raw")
    schema = "date_query date, type string, daily_accumulation double, ingest_seq long"
    first = spark.createDataFrame([(dt.date(2024, 1, 5), "solar", 1.0, 1), (dt.date(2024, 2, 5), "solar", 2.0, 2),
                                   (dt.date(2024, 3, 5), "solar", 3.0, 3)], schema)
    assert IN.upsert_partitions(spark, t, first, ["date_query", "type"], "ingest_seq") == ["2024-01", "2024-02", "2024-03"]
    before = files_of(t)
    jan_mar = {x for x in before if "month=2024-02" not in x[0]}
    second = spark.createDataFrame([(dt.date(2024, 2, 5), "solar", 20.0, 10), (dt.date(2024, 2, 6), "wind", 5.0, 11)], schema)
    assert IN.upsert_partitions(spark, t, second, ["date_query", "type"], "ingest_seq") == ["2024-02"]
    after = files_of(t)
    assert jan_mar <= after                      # January and March files untouched
    rows = {(str(r.date_query), r.type): r.daily_accumulation for r in spark.read.parquet(t).collect()}
    assert rows == {("2024-01-05", "solar"): 1.0, ("2024-02-05", "solar"): 20.0, ("2024-02-06", "wind"): 5.0,
                    ("2024-03-05", "solar"): 3.0}


def test_upsert_through_a_uri_keeps_all_rows(spark, tmpdir_path):
    t = "file://" + os.path.join(tmpdir_path, "raw")
    schema = "date_query date, type string, daily_accumulation double, ingest_seq long"
    day = dt.date(2024, 1, 5)
    for seq, kind in enumerate(("solar", "wind", "solar")):
        IN.upsert_partitions(spark, t, spark.createDataFrame([(day, kind, float(seq), seq)], schema), ["date_query", "type"], "ingest_seq")
    assert {(r.type, r.daily_accumulation) for r in spark.read.parquet(t).collect()} == {("solar", 2.0), ("wind", 1.0)}


def test_bad_items_do_not_lose_the_document(spark):
    payload = '[{"type": "Solar", "daily_Accumulation": 1}, 5, null, "x", [1], {"type": {"a": 1}, "daily_Accumulation": 3}, {"type": "Wind", "daily_Accumulation": "2.5", "more": [1]}]'
    rows = IN.land_row_json(spark.createDataFrame([("2024-01-01", payload, 1), ("2024-01-02", "5", 2), ("2024-01-03", None, 3)], "date_query string, payload string, ingest_seq long"))
    got = {(r.date_query, r.type, r.daily_accumulation) for r in rows.collect()}
    assert {("2024-01-01", "solar", 1.0), ("2024-01-01", "wind", 2.5)} <= got
    assert all(r[0] == "2024-01-01" for r in got)


def test_keep_last_null_and_equal_order(spark):
    rows = [("a", 1.0, None), ("a", 2.0, 1), ("b", 3.0, None), ("c", None, 5), ("c", 4.0, 4), ("d", 5.0, 2), ("d", 5.0, 2), (None, 6.0, 1), (None, 7.0, 2)]
    df = spark.createDataFrame(rows, "k string, v double, seq long")
    kept = IN.keep_last(df, ["k"], "seq")
    assert {(r.k, r.v) for r in kept.collect()} == {("a", 2.0), ("b", 3.0), ("c", None), ("d", 5.0), (None, 7.0)}
    assert "SortAggregate" not in kept._jdf.queryExecution().executedPlan().toString()
    text = df.select("k", "seq", df.v.cast("string").alias("v"))
    assert {(r.k, r.v) for r in IN.keep_last(text, ["k"], "seq").collect()} == {("a", "2.0"), ("b", "3.0"), ("c", None), ("d", "5.0"), (None, "7.0")}


def test_new_rows_start_and_end(spark):
    d = lambda n: dt.date(2024, 1, n)
    landed = spark.createDataFrame([(k, d(i)) for k in "ab" for i in range(1, 11)], "series_id string, date_query date")
    stored = spark.createDataFrame([("a", d(5)), ("a", d(3))], "series_id string, date_query date")
    got = {}
    for r in IN.new_rows(landed, stored, "date_query", ["series_id"], "2024-01-08", "2024-01-09").collect():
        got.setdefault(r.series_id, []).append(r.date_query.day)
    assert {k: sorted(v) for k, v in got.items()} == {"a": [6, 7, 8, 9], "b": [8, 9]}
    assert IN.new_rows(landed, None, "date_query", ["series_id"], "2024-01-08").count() == 6
