"""Direct multi-horizon training by competition, the model registry and
scoring (M1-M9, M14, A25, D9, D10, S8-S10).

Every candidate is a set of histogram trees (:mod:`seriesforge.plans.trees`). The
table is binned once; the fits of all candidates and horizons run together. All
series train together with the series key as an indexed feature. Every training run
has a folder of its own with its trees and its preprocessing (features, bins, fill
values, scaler, key index); the registry names the run folder of each production
model. Nothing is edited in place, so a model can be loaded with exactly what it was
trained with.
"""

from __future__ import annotations

import itertools
import uuid
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators import attribution as AT
from seriesforge.operators import evaluate as EV
from seriesforge.operators import linear as LN
from seriesforge.operators import split as SP
from seriesforge.operators.features import TARGET_PREFIX, numeric_columns, split_features_targets
from seriesforge.operators.histogram import Trees
from seriesforge.plans import trees as TT
from seriesforge.session import cut_lineage
from seriesforge.sources import store
from seriesforge.spec import SeriesSpec

# Candidate order of the competition (ties go to the earlier).
CANDIDATE_ORDER = ["RandomForest", "LeafwiseBoosting", "DepthwiseBoosting"]

# Sizes of the candidates and of the feature selector (M2, M3, M4).
FULL = {
    "RandomForest": Trees("forest", trees=300, max_depth=15, min_split=5, min_leaf=2),
    "LeafwiseBoosting": Trees("boost", trees=500, learning_rate=0.05, max_depth=8, max_leaves=31, min_leaf=20),
    "DepthwiseBoosting": Trees("boost", trees=500, learning_rate=0.05, max_depth=8, min_leaf=3, l2=1.0),
}
SELECTOR = Trees("boost", trees=400, learning_rate=0.1, max_depth=16, max_leaves=60, min_leaf=20)


def candidate_models(profile: str = "full", seed: int = 42) -> dict[str, Trees]:
    """M2/M3: the three candidates: a forest, boosting that splits the best leaf
    first, and boosting that splits whole levels. ``full`` has the sizes above and is
    what the registered queries train; ``smoke`` is for trials and tests."""
    if profile == "full":
        return {k: replace(v, seed=seed) for k, v in FULL.items()}
    if profile == "smoke":
        return {"RandomForest": replace(FULL["RandomForest"], trees=10, max_depth=5, seed=seed),
                "LeafwiseBoosting": replace(FULL["LeafwiseBoosting"], trees=5, learning_rate=0.3, max_depth=4, max_leaves=8, seed=seed),
                "DepthwiseBoosting": replace(FULL["DepthwiseBoosting"], trees=5, learning_rate=0.3, max_depth=4, seed=seed)}
    raise ValueError(f"no profile {profile}")


def linear_baseline(features: DataFrame, spec: SeriesSpec, cfg: TrainConfig | None = None) -> DataFrame:
    """The linear-regression baseline per horizon, on the rows and the split of
    the competition. Returns (candidate, horizon, n, rmse, mae, mape, r2)."""
    cfg = cfg or TrainConfig(selection="none")
    lab, feats, targets, _ = prepare(features, spec, cfg)
    rows = lab.withColumn("__part", 1 - F.col("is_train"))
    return EV.metrics(_linear(rows, spec, feats, targets, cfg), ["candidate", "horizon"])


def fitted_folds(features: DataFrame, spec: SeriesSpec, cfg: TrainConfig | None = None, per_series: bool = False) -> DataFrame:
    """The linear model of every expanding fold: each calendar year but the first
    is predicted by the fit of all years before it, all folds from one pass over the
    rows. ``per_series``: a fit for each series. Returns (fold, candidate, horizon, n,
    rmse, mae, mape, r2), with ``per_series`` for each series."""
    cfg = cfg or TrainConfig(selection="none")
    targets = [f"{TARGET_PREFIX}{h}" for h in cfg.horizons]
    df = SP.trailing_window(features, spec, cfg.window_days).dropna(how="any", subset=targets)
    feats = numeric_columns(df.select(*split_features_targets(df)[0]), exclude={*spec.key_cols, spec.time})
    keys = spec.key_cols if per_series else []
    preds = _linear(df.withColumn("__part", F.year(spec.time)), spec, feats, targets, cfg, keys)
    return EV.metrics(preds.withColumnRenamed("__part", "fold"), [*keys, "fold", "candidate", "horizon"])


def _linear(rows: DataFrame, spec: SeriesSpec, feats: list[str], targets: list[str], cfg: TrainConfig, by: list[str] | None = None) -> DataFrame:
    rows = cut_lineage(rows.select(*spec.key_cols, spec.time, "__part", *feats, *targets))
    p = LN.fold_predictions(rows, feats, targets, "__part", [*spec.key_cols, spec.time], by)
    horizon = F.element_at(F.array(*map(F.lit, cfg.horizons)), F.col("target") + 1)
    return p.select(*spec.key_cols, spec.time, "__part", F.lit("LinearRegression").alias("candidate"), horizon.alias("horizon"), "y_true", "y_pred")


def grid_candidates(base: dict[str, Trees], grid: dict) -> dict[str, Trees]:
    """Expand candidates over a grid {candidate: {size: [values]}}; each
    combination competes as its own named candidate."""
    out = {}
    for name, trees in base.items():
        sizes = grid.get(name, {})
        combos = list(itertools.product(*sizes.values())) if sizes else []
        for i, combo in enumerate(combos):
            out[f"{name}#{i}"] = replace(trees, **dict(zip(sizes, combo)))
        if not combos:
            out[name] = trees
    return out


@dataclass
class TrainConfig:
    horizons: list[int] = field(default_factory=lambda: list(range(1, 8)))
    profile: str = "full"
    train_frac: float = 0.8
    window_days: int = 365 * 15
    top_k: int = 30
    validation_year: int | None = None  # D2: train on the years before it, test on it, instead of train_frac
    alias_corr: float = 0.999999     # M4: copies of a feature are not ranked twice
    candidates: dict | None = None   # D9: sizes by name, instead of those of ``profile``
    grid: dict | None = None         # D9: {candidate: {size: [values]}}, each combination competes
    selection: str = "tree_shap"     # or "linear_shap", "none"
    selector: Trees = SELECTOR
    patience: int = 0                # D10: boosting stops after so many rounds without a lower validation error
    validation_frac: float = 0.1     # D10: the last dates of the training rows validate
    in_task_rows: int = TT.IN_TASK_ROWS


def prepare(features: DataFrame, spec: SeriesSpec, cfg: TrainConfig):
    """P6 + P3 + P13 + O4: trailing window, feature/target split, split label.
    Returns (labelled table, feature names, target names, fill values)."""
    df = SP.trailing_window(features, spec, cfg.window_days)
    targets = [f"{TARGET_PREFIX}{h}" for h in cfg.horizons]
    df = df.dropna(how="any", subset=targets)
    non_target, _ = split_features_targets(df)  # P3
    feats = [c for c in numeric_columns(df.select(*non_target), exclude={*spec.key_cols, spec.time})]
    if cfg.validation_year is None:
        lab = SP.label_split(df, spec.time, cfg.train_frac)
    else:
        lab = df.where(F.year(spec.time) <= cfg.validation_year) \
            .withColumn("is_train", (F.year(spec.time) < cfg.validation_year).cast("int"))
    # a column that is empty for a whole series stays NULL after the
    # per-series mean fill: it takes the mean of the training rows (0 when
    # empty everywhere) - one aggregate row, k numbers
    means = lab.where("is_train = 1").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in feats]).first()
    fill = {c: float(means[c] or 0.0) for c in feats}
    lab = lab.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c)
                       if c in feats else F.col(c) for c in lab.columns])
    return lab, feats, targets, fill


def scale(df: DataFrame, train: DataFrame, feats: list[str]):
    """population z-scores fitted on the training rows; the scaler is
    2 numbers per feature (model parameters), applied as column maths."""
    stats = SP.fit_scaler(train, feats)
    row = stats.first()
    params = {c: (row[f"{c}__mu"], row[f"{c}__sd"]) for c in feats}

    def z(c):
        mu, sd = params[c]
        sd = 1.0 if (sd is None or sd == 0) else sd
        return ((F.col(c).cast("double") - F.lit(mu or 0.0)) / F.lit(sd)).alias(c)
    return df.select(*[z(c) if c in feats else F.col(c) for c in df.columns]), params


def select_features(train: DataFrame, feats: list[str], label: str, cfg: TrainConfig) -> DataFrame:
    """Importance per feature from the training rows of the first horizon, top
    k. ``tree_shap``: exact Shapley values of a boosted model fitted to the unscaled
    features. ``linear_shap``: those of a linear model, phi_j = beta_j (x_j - mean_j),
    averaged in absolute value by one aggregation; copies of a feature are left out.
    Returns (rank, feature, importance)."""
    spark = train.sparkSession
    if cfg.selection == "tree_shap":
        cuts = TT.cut_points(train, feats)
        rows = train.withColumn("__row", F.xxhash64(*feats)).withColumn("__y", F.array(F.col(label).cast("double")))
        table = TT.binned(rows, cuts, ["__row", "__y"]).withColumnsRenamed({"__row": "row", "__y": "y"}).withColumn("part", F.lit(0))
        table = store.staged(table, "selector")
        fit = TT.fitted(table, {"selector": cfg.selector}, [1], in_task_rows=cfg.in_task_rows)
        # the rows cost much more than their bytes say: spread them over all cores
        spread = table.repartition(spark.sparkContext.defaultParallelism, "row")
        return AT.mean_absolute(AT.attributions(spread, fit.trees, len(feats), []), feats, cfg.top_k)
    feats = distinct_features(train, feats, cfg.alias_corr)
    vec = VectorAssembler(inputCols=feats, outputCol="features")
    lr = LinearRegression(labelCol=label, regParam=0.0, standardization=False).fit(vec.transform(train))
    mu = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in feats]).first()
    # |phi| = |beta| |x - mean|: one aggregate row over the training rows
    spread = train.agg(*[F.avg(F.abs(F.col(c).cast("double") - F.lit(mu[c] or 0.0))).alias(c) for c in feats]).first()
    imp = [(c, abs(float(b)) * float(spread[c] or 0.0)) for c, b in zip(feats, lr.coefficients)]
    imp.sort(key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(i + 1, *x) for i, x in enumerate(imp[:cfg.top_k])],
                                 "rank int, feature string, importance double")


def distinct_features(train: DataFrame, feats: list[str], alias_corr: float) -> list[str]:
    """Without constant features, and of features that are all but copies of
    each other (|r| >= ``alias_corr``) only the first: a linear model cannot
    tell such copies apart, so their shares would be arbitrary. One pass for the
    correlation matrix (features x features)."""
    vec = VectorAssembler(inputCols=feats, outputCol="features").transform(train).select("features")
    r = Correlation.corr(vec, "features").first()[0].toArray()
    kept: list[int] = []
    for j in range(len(feats)):
        constant = r[j][j] != r[j][j] or all(x != x for i, x in enumerate(r[j]) if i != j)
        if len(feats) > 1 and constant:
            continue
        if not any(abs(r[i][j]) >= alias_corr for i in kept):
            kept.append(j)
    return [feats[j] for j in kept] or feats[:1]


def index_keys(df: DataFrame, spec: SeriesSpec, mapping: dict[str, DataFrame] | None = None):
    """Series keys as numbers from 0 in their order, in a table (key, index) for
    each key column; keys that the table does not have get the number past the
    last. Returns (df with ``<key>__idx`` columns, tables). The tables are joined,
    never collected: there may be any number of series."""
    from pyspark.sql import Window
    tables = {}
    for k in spec.key_cols:
        table = (mapping or {}).get(k)
        if table is None:
            keys = df.select(k).distinct().where(F.col(k).isNotNull())
            # numbers by range partitions: a running count over partitions plus the place inside
            part = keys.repartitionByRange(k).sortWithinPartitions(k).withColumn("__id", F.monotonically_increasing_id())
            part = cut_lineage(part.select(k, F.shiftright("__id", 33).alias("__part"), F.expr("__id & 8589934591L").alias("__nth")))
            before = part.groupBy("__part").count().withColumn(
                "__before", F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            table = cut_lineage(part.join(before, "__part").select(k, (F.col("__before") + F.col("__nth")).cast("double").alias(f"{k}__idx")))
        tables[k] = table
        past = float(table.agg(F.max(f"{k}__idx")).first()[0] or 0.0) + 1.0
        df = df.join(table, k, "left").withColumn(f"{k}__idx", F.coalesce(f"{k}__idx", F.lit(past)))
    return df, tables


def train_competition(features: DataFrame, spec: SeriesSpec, cfg: TrainConfig | None = None,
                      out_dir: str | None = None):
    """M1/M5: fit every candidate for every horizon, score the holdout, pick
    the lowest RMSE per horizon. Returns dict with ``predictions`` (long, stored),
    ``metrics``, ``winners``, ``features``, the ``trees`` of all models, ``rounds``
    (validation errors with ``patience``) and the preprocessing."""
    cfg = cfg or TrainConfig()
    spark = features.sparkSession
    lab, feats, targets, fill = prepare(features, spec, cfg)
    idx = {}
    if spec.keys:
        # series keys as an indexed feature; in key order, so that the index of
        # a series does not depend on how many rows it has
        lab, idx = index_keys(lab, spec)
        feats = feats + [f"{k}__idx" for k in spec.key_cols]
    lab = cut_lineage(lab.select(*spec.key_cols, spec.time, "is_train", *feats, *targets))
    train = lab.where("is_train = 1")
    sel = None
    if cfg.selection != "none":
        sel = select_features(train, feats, targets[0], cfg)
        chosen = [r["feature"] for r in sel.orderBy("rank").collect()]  # at most top_k names
        feats = chosen + [f for f in feats if f.endswith("__idx") and f not in chosen]
    scaled, scaler = scale(lab, train, feats)
    cands = cfg.candidates or candidate_models(cfg.profile)
    if cfg.grid:
        cands = grid_candidates(cands, cfg.grid)
    cuts = TT.cut_points(scaled.where("is_train = 1"), feats)
    part = F.when(F.col("is_train") == 1, F.lit(0))
    if cfg.patience:
        # The last dates of the training rows validate the boosting rounds
        cands = {k: replace(v, patience=cfg.patience) if v.kind == "boost" else v for k, v in cands.items()}
        last = SP.date_positions(lab.where("is_train = 1"), spec.time, 1 - cfg.validation_frac).withColumnRenamed("is_train", "__early")
        scaled = scaled.join(last, spec.time, "left")
        part = F.when(F.col("is_train") == 1, F.when(F.col("__early") == 1, F.lit(0)).otherwise(F.lit(1)))
    rows = scaled.withColumn("__row", F.xxhash64(*spec.key_cols, spec.time)).withColumn("__part", part) \
        .withColumn("__y", F.array(*[F.col(t).cast("double") for t in targets]))
    table = TT.binned(rows, cuts, [*spec.key_cols, spec.time, "is_train", "__row", "__part", "__y"])
    table = store.staged(table.withColumnsRenamed({"__row": "row", "__part": "part", "__y": "y"}), "binned")
    fit = TT.fitted(table, cands, cfg.horizons, in_task_rows=cfg.in_task_rows)
    # every candidate and horizon on the rows held out
    scored = TT.predictions(table.where("is_train = 0"), fit.trees, [*spec.key_cols, spec.time, "y"])
    truth = F.element_at("y", F.array_position(F.array(*map(F.lit, cfg.horizons)), F.col("horizon")).cast("int"))
    allp = store.staged(scored.select(*spec.key_cols, spec.time, "horizon", "candidate", truth.alias("y_true"), "y_pred"), "predictions")
    met = EV.metrics(allp, ["candidate", "horizon"])
    win = cut_lineage(EV.pick_winner(met, ["horizon"], order=list(cands)))
    res = {"predictions": allp, "metrics": met, "winners": win, "features": feats, "selection": sel, "trees": fit.trees, "rounds": fit.rounds,
           "cuts": cuts, "scaler": scaler, "candidates": list(cands), "indexer": idx, "fill": fill}
    if out_dir:
        save_models(res, out_dir)
    return res


def expanding_folds(features: DataFrame, spec: SeriesSpec, cfg: TrainConfig | None = None,
                    years: list[int] | None = None) -> DataFrame:
    """One competition for each validation year, trained on all years
    before it. Returns the metrics with their ``fold``; :func:`evaluate.fold_summary`
    sums them up. Without ``years`` every year but the first."""
    cfg = cfg or TrainConfig()
    if years is None:
        years = sorted(r[0] for r in features.select(F.year(spec.time)).distinct().collect())[1:]  # calendar years
    out = None
    for year in years:
        met = train_competition(features, spec, replace(cfg, validation_year=year))["metrics"]
        met = cut_lineage(met.withColumn("fold", F.lit(year)))
        out = met if out is None else out.unionByName(met)
    return out


def save_models(res: dict, out_dir: str) -> str:
    """A new run folder with the trees of every candidate, the feature list
    with its bins and scaler, the fill values and the key index. Returns its path,
    which the result also carries as ``run_path``."""
    run = store.join(out_dir, f"run={uuid.uuid4().hex}")
    spark = res["metrics"].sparkSession
    res["trees"].repartition("candidate", "horizon").write.partitionBy("candidate", "horizon").parquet(store.join(run, "trees"))
    prep = [(i + 1, f, float(res["scaler"][f][0] or 0.0), float(res["scaler"][f][1] or 0.0), [float(x) for x in res["cuts"][f]]) for i, f in enumerate(res["features"])]
    spark.createDataFrame(prep, "rank int, feature string, mu double, sd double, cuts array<double>").coalesce(1).write.parquet(store.join(run, "selected_features"))
    spark.createDataFrame(list(res["fill"].items()), "feature string, value double").coalesce(1).write.parquet(store.join(run, "fill"))
    for k, table in res["indexer"].items():
        table.write.parquet(store.join(run, "index", k))
    res["run_path"] = run
    return run


def load_preprocessing(spark: SparkSession, run: str) -> dict:
    """What :func:`save_models` saved beside the models of a run."""
    rows = spark.read.parquet(store.join(run, "selected_features")).orderBy("rank").collect()  # a row for each feature
    fill = {r["feature"]: r["value"] for r in spark.read.parquet(store.join(run, "fill")).collect()}
    index = {k: spark.read.parquet(store.join(run, "index", k)) for k in store.names(spark, store.join(run, "index"))}
    return {"features": [r["feature"] for r in rows], "scaler": {r["feature"]: (r["mu"], r["sd"]) for r in rows},
            "cuts": {r["feature"]: list(r["cuts"]) for r in rows}, "fill": fill, "indexer": index}


# ---------------------------------------------------------------- registry
REGISTRY = "horizon int, rmse double, mae double, mape double, r2 double, candidate string, run_path string, model_path string"


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """The latest registry version (empty when none)."""
    vs = store.versions(spark, root)
    if not vs:
        return spark.createDataFrame([], REGISTRY)
    return spark.read.schema(REGISTRY).parquet(store.join(root, f"v={vs[-1]}"))


def update_registry(spark: SparkSession, root: str, winners: DataFrame, run: str) -> DataFrame:
    """Promote per horizon on strictly lower RMSE (first registration
    when the horizon is absent) and write the next version, which names the run
    folder and model of each horizon. Returns the decision table."""
    old = cut_lineage(read_registry(spark, root))
    new = winners.select("horizon", "rmse", "mae", "mape", "r2", "candidate")
    dec = cut_lineage(EV.promote(new, old, ["horizon"]))
    newrows = dec.where("promoted = 1").select(
        "horizon", F.col("new_rmse").alias("rmse"), "mae", "mape", "r2", "candidate", F.lit(run).alias("run_path"),
        F.concat(F.lit(store.join(run, "trees") + "/candidate="), "candidate", F.lit("/horizon="), F.col("horizon").cast("string")).alias("model_path"))
    kept = old.join(newrows.select("horizon"), "horizon", "left_anti")
    store.write_version(kept.unionByName(newrows).coalesce(1), root)
    return dec


def _prepared_latest(prod_features: DataFrame, spec: SeriesSpec, pre: dict) -> DataFrame:
    """The last row of every series, filled, scaled and binned as in training."""
    from seriesforge.operators.forecast import last_rows
    last = last_rows(prod_features, spec, 1)
    if pre["indexer"]:
        last, _ = index_keys(last, spec, pre["indexer"])  # the training mapping; unseen keys -> extra index
    feats, mu_sd, fill = pre["features"], pre["scaler"], pre["fill"]
    last = last.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fill[c])).alias(c) if c in fill
                         else F.col(c) for c in last.columns])
    cols = [((F.col(c).cast("double") - F.lit(mu_sd[c][0] or 0.0)) /
             F.lit(1.0 if not mu_sd[c][1] else mu_sd[c][1])).alias(c) for c in feats]
    rows = last.select(*spec.key_cols, spec.time, *cols)
    return TT.binned(rows, {f: pre["cuts"][f] for f in feats}, [*spec.key_cols, spec.time])


def _scored(rows: DataFrame, trees: DataFrame, spec: SeriesSpec, as_of) -> DataFrame:
    from seriesforge.operators.forecast import date_forecast
    p = TT.predictions(rows, trees, [*spec.key_cols, spec.time])
    return date_forecast(p.select(*spec.key_cols, F.col(spec.time).alias("origin_date"), "horizon", "candidate", "y_pred"), "origin_date", as_of)


def score_latest(prod_features: DataFrame, spec: SeriesSpec, res: dict, as_of=None) -> DataFrame:
    """M8/M9 with a training result at hand: the last row of every series
    through each horizon's winner; target date = last date + h (or as_of + h - 1)."""
    best = res["trees"].join(F.broadcast(res["winners"].select("candidate", "horizon")), ["candidate", "horizon"])  # a row for each horizon
    return _scored(_prepared_latest(prod_features, spec, res), best, spec, as_of)


def score_production(prod_features: DataFrame, spec: SeriesSpec, registry: DataFrame, as_of=None) -> DataFrame:
    """M8/M9 from storage: each horizon's production model, loaded with the
    preprocessing of the run that trained it. One pass for each run that the
    registry names; its models are read together."""
    spark = prod_features.sparkSession
    runs: dict[str, list] = {}
    for r in registry.collect():  # one row per horizon
        runs.setdefault(r["run_path"], []).append(r)
    if not runs:
        raise ValueError("no model is registered")
    out = None
    for run, rows in sorted(runs.items()):
        chosen = spark.createDataFrame([(r["candidate"], r["horizon"]) for r in rows], "candidate string, horizon int")
        trees = spark.read.schema(TT.TREE).parquet(store.join(run, "trees")).join(F.broadcast(chosen), ["candidate", "horizon"])
        part = _scored(_prepared_latest(prod_features, spec, load_preprocessing(spark, run)), trees, spec, as_of)
        out = part if out is None else out.unionByName(part)
    return out
