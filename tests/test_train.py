"""Model jobs (rows-only in the oracle check): competition, winner =
argmin recomputed, registry promotion rules on disk, reload = same model."""

import os

from pyspark.sql import functions as F

from paths import SF_SMALL
from seriesforge.plans import train as TR
from seriesforge.plans.catalog import PANEL, features_table
from seriesforge.sources import store


def test_competition_registry_and_scoring(spark, tmpdir_path):
    f = features_table(spark, SF_SMALL, True)
    cfg = TR.TrainConfig(horizons=[1, 2], profile="smoke", top_k=10)
    res = TR.train_competition(f, PANEL, cfg, out_dir=os.path.join(tmpdir_path, "models"))
    met = res["metrics"].collect()
    assert len(met) == 6 and all(m.rmse > 0 and m.n > 0 for m in met)
    # winner is the argmin recomputed from the stored predictions
    for h in (1, 2):
        best = min((m for m in met if m.horizon == h),
                   key=lambda m: (m.rmse, TR.CANDIDATE_ORDER.index(m.candidate)))
        w = res["winners"].where(F.col("horizon") == h).first()
        assert w.candidate == best.candidate
    sel = res["selection"].orderBy("rank").collect()
    assert 1 <= len(sel) <= 10 and sel[0].rank == 1

    prod = features_table(spark, SF_SMALL, False)
    fc = {(r.series_id, r.horizon): r for r in TR.score_latest(prod, PANEL, res).collect()}
    assert len(fc) == 5 * 2 and all(r.predicted is not None for r in fc.values())
    assert all((r.target_date - r.origin_date).days == r.horizon for r in fc.values())

    root = "file://" + os.path.join(tmpdir_path, "registry")
    run = res["run_path"]
    d1 = {r.horizon: r.action for r in TR.update_registry(spark, root, res["winners"], run).collect()}
    assert set(d1.values()) == {"promoted_first"}
    # a later run with equal metrics: equal is not better, the registry keeps the first run's models
    later = {**res, "trees": res["trees"].withColumn("horizon", 3 - F.col("horizon"))}
    second = TR.save_models(later, os.path.join(tmpdir_path, "models"))
    d2 = {r.horizon: r.action for r in TR.update_registry(spark, root, res["winners"], second).collect()}
    assert set(d2.values()) == {"rejected"} and second != run
    assert store.versions(spark, root) == [1, 2]
    reg = TR.read_registry(spark, root)
    assert reg.count() == 2 and {r.run_path for r in reg.collect()} == {run}

    # scores from storage alone equal those of the live objects, in a fresh session too
    fresh = spark.newSession()
    again = TR.score_production(features_table(fresh, SF_SMALL, False), PANEL, TR.read_registry(fresh, root))
    assert {(r.series_id, r.horizon): r.y_pred for r in again.collect()} == {k: r.y_pred for k, r in fc.items()}

    # the metrics, recomputed in SQL from the stored predictions
    import duckdb
    sql = duckdb.sql(f"""SELECT candidate, horizon, count(*) AS n, sqrt(avg((y_true - y_pred) ** 2)) AS rmse, avg(abs(y_true - y_pred)) AS mae,
      1 - sum((y_true - y_pred) ** 2) / (count(*) * var_pop(y_true)) AS r2 FROM read_parquet('{res["predictions"].path_of.replace("file:", "")}/*.parquet') GROUP BY ALL""").fetchall()
    want = {(c, h): (n, rmse, mae, r2) for c, h, n, rmse, mae, r2 in sql}
    assert len(want) == len(met)
    for m in met:
        n, rmse, mae, r2 = want[m.candidate, m.horizon]
        assert m.n == n and abs(m.rmse / rmse - 1) < 1e-9 and abs(m.mae / mae - 1) < 1e-9 and abs(m.r2 - r2) < 1e-9


def test_ranking_ignores_copies(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        a, b, c = (rnd.gauss(0, 1) for _ in range(3))
        rows.append((a, a * 2 + 1, b, c, 3.0, 5 * a + 2 * b + rnd.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "a double, a_copy double, b double, c double, one double, y double")
    cfg = TR.TrainConfig(top_k=10, selection="linear_shap")
    full = [(r.feature, round(r.importance, 6)) for r in TR.select_features(df, ["a", "a_copy", "b", "c", "one"], "y", cfg).collect()]
    less = [(r.feature, round(r.importance, 6)) for r in TR.select_features(df, ["a", "b", "c", "one"], "y", cfg).collect()]
    assert full == less and [f for f, _ in full] == ["a", "b", "c"]


def test_key_index_is_a_table(spark):
    df = spark.createDataFrame([(f"k{i % 37:02d}", i) for i in range(500)], "series_id string, v int").repartition(7)
    out, tables = TR.index_keys(df, PANEL)
    assert {r.series_id: r["series_id__idx"] for r in out.collect()} == {f"k{i:02d}": float(i) for i in range(37)}
    new = spark.createDataFrame([("k05", 1), ("zz", 2), (None, 3)], "series_id string, v int")
    assert sorted(r["series_id__idx"] for r in TR.index_keys(new, PANEL, tables)[0].collect()) == [5.0, 37.0, 37.0]


def test_grid_and_patience(spark):
    base = TR.candidate_models("smoke")["DepthwiseBoosting"]
    g = TR.grid_candidates({"DepthwiseBoosting": base, "x": base}, {"DepthwiseBoosting": {"max_depth": [2, 3], "trees": [4]}})
    assert sorted(g) == ["DepthwiseBoosting#0", "DepthwiseBoosting#1", "x"]
    assert [g[f"DepthwiseBoosting#{i}"].max_depth for i in (0, 1)] == [2, 3] and g["DepthwiseBoosting#0"].trees == 4
    f = features_table(spark, SF_SMALL, True)
    grid = TR.TrainConfig(horizons=[1], selection="none", candidates={"b": base}, grid={"b": {"max_depth": [2, 3]}}, patience=2)
    res = TR.train_competition(f, PANEL, grid)
    assert sorted(r.candidate for r in res["metrics"].collect()) == ["b#0", "b#1"]
    # kept rounds: up to the lowest validation error
    for name in ("b#0", "b#1"):
        errors = [r.validation_rmse for r in sorted(res["rounds"].where(F.col("candidate") == name).collect(), key=lambda r: r["round"])]
        assert res["trees"].where((F.col("candidate") == name) & (F.col("tree") >= 0)).count() == errors.index(min(errors)) + 1
    lin = TR.linear_baseline(f, PANEL, TR.TrainConfig(horizons=[1], selection="none")).collect()
    assert len(lin) == 1 and lin[0].rmse > 0


def test_model_beats_persistence_on_weekly_series(spark):
    import math
    import random
    rnd = random.Random(7)
    rows = []
    for k in ("a", "b", "c"):
        for i in range(420):
            d = __import__("datetime").date(2020, 1, 6) + __import__("datetime").timedelta(days=i)
            y = 100.0 + (30.0 if d.weekday() >= 5 else 0.0) + 5.0 * math.sin(i / 30.0) + rnd.gauss(0, 1.0)
            rows.append((k, d, y))
    base = spark.createDataFrame(rows, "series_id string, date date, y double")
    from seriesforge.operators import features as FE
    from seriesforge.spec import SeriesSpec
    spec = SeriesSpec(("series_id",), "date", "y")
    f = FE.build_features(base, spec, training=True, horizons=1)
    cfg = TR.TrainConfig(horizons=[1], profile="smoke", selection="none")
    res = TR.train_competition(f, spec, cfg)
    best = res["winners"].first().rmse
    p = res["predictions"].select("series_id", "date", "y_true").distinct()
    persist = p.join(f.select("series_id", "date", F.col("y").alias("y_pred")), ["series_id", "date"])
    pr = persist.select(F.sqrt(F.avg((F.col("y_true") - F.col("y_pred")) ** 2)).alias("r")).first().r
    assert best < 0.5 * pr, (best, pr)


def test_expanding_folds_train_on_the_years_before(spark):
    from seriesforge.operators import evaluate as EV
    f = features_table(spark, SF_SMALL, True)
    cfg = TR.TrainConfig(horizons=[1], selection="none", candidates={"b": TR.candidate_models("smoke")["DepthwiseBoosting"]})
    met = TR.expanding_folds(f, PANEL, cfg, [1996, 1997])
    rows = {r.fold: r for r in met.collect()}
    for year in (1996, 1997):
        lab, _, targets, _ = TR.prepare(f, PANEL, TR.replace(cfg, validation_year=year))
        n = {(r.is_train, r.y): r["count"] for r in lab.groupBy("is_train", F.year("date").alias("y")).count().collect()}
        assert max(y for t, y in n if t) < year and {y for t, y in n if not t} == {year}
        assert rows[year].n == n[0, year]
    total = EV.fold_summary(met, ["candidate", "horizon"]).collect()
    assert len(total) == 1 and total[0].n_folds == 2


def test_full_sizes():
    """M2/M3: 300 trees of depth 15 and 500 rounds at 0.05, which m1_... and m8_... train."""
    models = TR.candidate_models("full")
    assert (models["RandomForest"].trees, models["RandomForest"].max_depth, models["RandomForest"].min_split, models["RandomForest"].min_leaf) == (300, 15, 5, 2)
    assert all((models[m].trees, models[m].learning_rate, models[m].max_depth) == (500, 0.05, 8) for m in ("LeafwiseBoosting", "DepthwiseBoosting"))
    assert models["LeafwiseBoosting"].max_leaves == 31 and models["LeafwiseBoosting"].min_leaf == 20 and models["DepthwiseBoosting"].min_leaf == 3
