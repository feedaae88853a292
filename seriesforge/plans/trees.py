"""Training and scoring of histogram trees on Spark.

The table is binned once, a byte a feature, and every candidate for every horizon
is a *fit* over it. How a fit runs depends on the number of its training rows, what
it returns does not:

* up to ``IN_TASK_ROWS`` rows, fits are groups of a shuffle and each is trained in
  one task, all of them side by side (a forest in blocks of trees);
* beyond that, no task ever sees a node's rows whole. All fits grow together: one
  job a level, in which every task adds up the gradient histograms of its rows for
  all large nodes of all fits, Spark sums them by (fit, node, feature, bin) and the
  best split of a node is taken from at most 256 sums a feature. Nodes that have
  come down to ``IN_TASK_ROWS`` rows are finished in a task each, in one job for
  all. A boosting round ends with a table of new predictions; the trees are on the
  driver only while they grow, a round or a batch at a time.

Gradients are integers, so both ways give the same trees to the bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.operators import histogram as H
from seriesforge.operators.histogram import Trees
from seriesforge.session import for_workers
from seriesforge.sources import store

IN_TASK_ROWS = 100_000
TREES_A_TASK = 75  # of a forest
TREES_A_BATCH = 8  # of each forest that grow level by level together
MODEL_BYTES = 128 << 20  # trees that are sent to the tasks at a time when scoring
BINS = 256
TREE = "candidate string, horizon int, tree int, feature array<smallint>, bin array<smallint>, left array<int>, value array<double>, n array<bigint>, gain array<double>"
ROUND = "candidate string, horizon int, round int, validation_rmse double"


def cut_points(train: DataFrame, feats: list[str]) -> dict[str, list[float]]:
    """For each feature at most 255 distinct values of the training rows that split it
    into bins of about equal size; a value goes into the bin of the first that is not
    below it. One aggregation for all features."""
    share = [k / BINS for k in range(1, BINS)]
    row = train.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), share, 20_000).alias(f"c{i}") for i, c in enumerate(feats)]).first()
    return {c: sorted(set(row[f"c{i}"] or [])) for i, c in enumerate(feats)}


def _binner(cuts: list[np.ndarray], kept: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((batch.num_rows, len(cuts)), np.uint8)
            for i, cut in enumerate(cuts):
                bins[:, i] = np.searchsorted(cut, batch.column(kept + i).to_numpy(zero_copy_only=False))
            whole = pa.array([x.tobytes() for x in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(kept)), whole], names=[*batch.schema.names[:kept], "bins"])
    return run


def binned(df: DataFrame, cuts: dict[str, list[float]], keep: list[str]) -> DataFrame:
    """``keep`` columns and bins: a byte for each feature, in the order of ``cuts``.
    A null feature counts as below all others."""
    for_workers(df.sparkSession)
    feats = list(cuts)
    rows = df.select(*keep, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("-inf"))).alias(f"__{i}") for i, c in enumerate(feats)])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keep)])
    return rows.mapInArrow(_binner([np.array(cuts[c]) for c in feats], len(keep)), f"{kept}, bins binary")


@dataclass
class Fit:
    """One candidate for one horizon. ``place`` is the horizon's place among the targets."""
    candidate: str
    horizon: int
    place: int
    trees: Trees
    base: float = 0.0
    scale: float = 1.0


@dataclass
class Fitted:
    """``trees`` is a table with a row a tree: nodes from the root (0), the children of a
    node at left and left + 1 (feature -1: leaf), a row goes left if its bin is at most
    the node's. A prediction is the sum of the leaves' values over all trees; tree -1
    is the mean of the training rows. ``rounds`` has the validation errors of boosted
    candidates, if there are rows to validate."""
    trees: DataFrame
    rounds: DataFrame
    fits: list[Fit] = field(default_factory=list)


def fitted(rows: DataFrame, candidates: dict[str, Trees], horizons: list[int], label: str = "y", seen: str = "part", in_task_rows: int = IN_TASK_ROWS) -> Fitted:
    """Trees for every candidate and horizon. ``rows`` has row (a number of its own for
    every row that does not depend on how the table is read), bins, ``label`` (an array
    with a target for each horizon) and ``seen`` (0: training, 1: validation; other rows
    are not looked at). Should be a stored table; it is read once a job."""
    for_workers(rows.sparkSession)
    rows = rows.where(F.col(seen).isin(0, 1)).select("row", "bins", F.col(label).alias("y"), (F.col(seen) == 1).alias("valid"))
    train = rows.where(~F.col("valid"))
    spans = train.agg(F.count("*").alias("n"), *[x for i in range(len(horizons)) for x in (
        F.avg(F.col("y")[i]).alias(f"m{i}"), F.min(F.col("y")[i]).alias(f"lo{i}"), F.max(F.col("y")[i]).alias(f"hi{i}"))]).first()
    if not spans["n"]:
        raise ValueError("no training rows")
    fits = []
    for name, trees in candidates.items():
        for i, h in enumerate(horizons):
            base = float(spans[f"m{i}"])
            reach = max(spans[f"hi{i}"] - base, base - spans[f"lo{i}"], 1e-300)
            fits.append(Fit(name, h, i, trees, base, 2.0 ** math.floor(math.log2(2 ** 30 / reach))))
    grown, rounds = (_in_tasks if spans["n"] <= in_task_rows else _by_levels)(rows, fits, in_task_rows)
    spark = rows.sparkSession
    base = spark.createDataFrame([(f.candidate, f.horizon, -1, [-1], [0], [-1], [f.base], [int(spans["n"])], [0.0]) for f in fits], TREE)
    return Fitted(grown.unionByName(base), rounds, fits)


def _row(fit: Fit, tree: int, grown: H.Growing, value: np.ndarray) -> tuple:
    value = np.where(np.array(grown.feature) < 0, value, 0.0)
    return fit.candidate, fit.horizon, tree, grown.feature, [max(b, 0) for b in grown.bin], grown.left, value.tolist(), grown.n, grown.gain


# ------------------------------------------------------------ a fit in a task
def _trainer(jobs: list[tuple[Fit, range]]) -> callable:
    names = [x.split(" ")[0] for x in TREE.split(", ")]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        fit, some = jobs[key[0].as_py()]
        rows = rows.sort_by("row")
        bins = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8).reshape(rows.num_rows, -1).T.copy()
        y, valid = rows.column("target").to_numpy(), rows.column("valid").to_numpy(zero_copy_only=False).astype(bool)
        errors = []
        if fit.trees.kind == "boost":
            grown, errors = H.boosted(bins, y, valid, fit.trees, fit.base, fit.scale)
            out = [_row(fit, i, *x) for i, x in enumerate(grown)]
        else:
            inside = ~valid
            out = [_row(fit, *x) for x in H.forest(np.ascontiguousarray(bins[:, inside]), y[inside], rows.column("row").to_numpy()[inside], fit.trees, fit.base, fit.scale, some)]
        columns = [*zip(*out)] if out else [[] for _ in names]
        made = [pa.array(c, t) for c, t in zip(columns, _TREE_TYPES)]
        made.append(pa.array([errors] + [None] * (len(out) - 1) if out else [], pa.list_(pa.float64())))
        return pa.table(made, names=[*names, "errors"])
    return run


_TREE_TYPES = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int16()), pa.list_(pa.int16()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.float64()))


def _in_tasks(rows: DataFrame, fits: list[Fit], in_task_rows: int) -> tuple[DataFrame, DataFrame]:
    jobs = []
    for f in fits:
        step = f.trees.trees if f.trees.kind == "boost" else TREES_A_TASK
        jobs += [(f, range(lo, min(lo + step, f.trees.trees))) for lo in range(0, f.trees.trees, step)]
    jobs.sort(key=lambda j: j[0].trees.kind != "boost")  # the longest first
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("job"), F.lit(f.place).alias("place")) for i, (f, _) in enumerate(jobs)])).alias("one")
    dealt = rows.select("row", "bins", "y", "valid", each).select(F.col("one.job").alias("job"), "row", "bins", F.col("y")[F.col("one.place")].alias("target"), "valid")
    dealt = dealt.repartitionByRange(len(jobs), "job")
    grown = store.staged(dealt.groupBy("job").applyInArrow(_trainer(jobs), f"{TREE}, errors array<double>"), "trees")
    rounds = grown.where("errors is not null").select("candidate", "horizon", F.posexplode("errors").alias("round", "validation_rmse"))
    return grown.drop("errors"), rounds


# ------------------------------------------------------------ level by level
def _inputs(batch: pa.RecordBatch, fits: list[Fit], part: list[tuple[int, int]]):
    """For each (fit, tree) of a batch of rows (row, bins, y, valid[, pred]): bins, gradients and draws."""
    bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1).T
    y = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    inside = ~batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
    bins, y, row = np.ascontiguousarray(bins[:, inside]), y[inside], batch.column(0).to_numpy(zero_copy_only=False)[inside]
    pred = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[inside] if batch.num_columns > 4 else None
    for k, (u, tree) in enumerate(part):
        f = fits[u]
        if f.trees.kind == "boost":
            yield k, f, bins, row, H.gradients(y[:, f.place] - pred[:, u], f.scale), None
        else:
            w = H.draws(row, f.trees.seed, tree)
            yield k, f, bins, row, H.gradients(y[:, f.place] - f.base, f.scale) * w, w


def _summed(fits: list[Fit], part: list[tuple[int, int]], grown: list[H.Growing], large: list[list[int]]) -> callable:
    """Partial histograms (k, node, feature, bin, n, g) of the large nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, _, bins, _, g, w in _inputs(batch, fits, part):
                compact = np.full(len(grown[k].n), 65535, np.uint16)
                compact[large[k]] = np.arange(len(large[k]))
                node = compact[grown[k].route(bins)]
                some = np.flatnonzero((node != 65535) & (True if w is None else w > 0))
                if len(some):
                    inside = np.ascontiguousarray(bins[:, some])
                    feature, at, bin_, n, total = H.histogram(inside, H.by_bin(inside), node[some], g[some], None if w is None else w[some])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k)), pa.array(np.array(large[k])[at]), pa.array(feature), pa.array(bin_.astype(np.int64)), pa.array(n), pa.array(total)],
                                                     names=["k", "node", "feature", "bin", "n", "g"])
    return run


def _chosen(fits: list[Fit], part: list[tuple[int, int]]) -> callable:
    def run(key: tuple, sums: pd.DataFrame) -> pd.DataFrame:
        sums = sums.sort_values(["feature", "bin"])
        best = H.best_splits(*(sums[c].to_numpy() if c != "node" else np.zeros(len(sums), np.int64) for c in ("feature", "node", "bin", "n", "g")), 1, fits[part[key[0]][0]].trees)
        return pd.DataFrame({"k": [key[0]], "node": [key[1]], "gain": best[0], "feature": best[1], "bin": best[2], "n": best[3], "g": best[4]})
    return run


def _small_rows(fits: list[Fit], part: list[tuple[int, int]], grown: list[H.Growing], small: list[set[int]]) -> callable:
    """The rows of the nodes that are finished in tasks: k, node, row, bins, g, w."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, _, bins, row, g, w in _inputs(batch, fits, part):
                node = grown[k].route(bins)
                some = np.flatnonzero(np.isin(node, list(small[k])) & (True if w is None else w > 0))
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), k)), pa.array(node[some]), pa.array(row[some]), pa.array([x.tobytes() for x in bins[:, some].T], pa.binary()), pa.array(g[some]),
                         pa.array(np.ones(len(some), np.int64) if w is None else w[some])], names=["k", "node", "row", "bins", "g", "w"])
    return run


def _finisher(fits: list[Fit], part: list[tuple[int, int]], paths: dict[tuple[int, int], int]) -> callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        p = fits[part[key[0]][0]].trees
        rows = rows.sort_values("row")
        bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(len(rows), -1).T.copy()
        w = rows["w"].to_numpy() if p.kind == "forest" else None
        tree, _ = H.grow(bins, rows["g"].to_numpy(), w, p, H.by_bin(bins), paths[key])
        return pd.DataFrame({"k": [key[0]], "node": [key[1]], "path": [tree.path], "feature": [tree.feature], "bin": [tree.bin], "left": [tree.left], "n": [tree.n], "g": [tree.g], "gain": [tree.gain]})
    return run


def _grown(rows: DataFrame, fits: list[Fit], part: list[tuple[int, int]], in_task_rows: int) -> list[H.Growing]:
    """One tree for each (fit, tree) of ``part``, not cut to max_leaves yet."""
    roots = {r["k"]: r for r in rows.mapInArrow(_totals(fits, part), "k bigint, n bigint, g bigint").groupBy("k").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect()}
    grown = [H.Growing(roots[k]["n"] if k in roots else 0, roots[k]["g"] if k in roots else 0) for k in range(len(part))]
    frontier, small = [[0] for _ in part], [set() for _ in part]
    while True:
        large = []
        for k, (u, _) in enumerate(part):
            p, tree = fits[u].trees, grown[k]
            here = [i for i in frontier[k] if tree.path[i].bit_length() <= p.max_depth and tree.n[i] >= max(p.min_split, 2 * p.min_leaf, 2)]
            small[k] |= {i for i in here if tree.n[i] <= in_task_rows}
            large.append(tree.worth([i for i in here if tree.n[i] > in_task_rows], p.max_leaves))
        if not any(large):
            break
        sums = rows.mapInArrow(_summed(fits, part, grown, large), "k bigint, node bigint, feature bigint, bin bigint, n bigint, g bigint")
        sums = sums.groupBy("k", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
        best = sums.groupBy("k", "node").applyInPandas(_chosen(fits, part), "k bigint, node bigint, gain double, feature bigint, bin bigint, n bigint, g bigint")
        frontier = [[] for _ in part]
        for r in sorted(best.where("gain > 0").collect(), key=lambda r: (r["k"], r["node"])):  # a row for each large node
            tree = grown[r["k"]]
            tree.split(r["node"], r["feature"], r["bin"], r["n"], r["g"], r["gain"])
            frontier[r["k"]] += [tree.left[r["node"]], tree.left[r["node"]] + 1]
    if any(small):
        paths = {(k, i): grown[k].path[i] for k, nodes in enumerate(small) for i in nodes}
        kinds = "k bigint, node bigint, row bigint, bins binary, g bigint, w bigint"
        done = rows.mapInArrow(_small_rows(fits, part, grown, small), kinds).groupBy("k", "node").applyInPandas(
            _finisher(fits, part, paths), "k bigint, node bigint, path array<bigint>, feature array<bigint>, bin array<bigint>, left array<bigint>, n array<bigint>, g array<bigint>, gain array<double>")
        for r in done.toLocalIterator():
            sub = H.Growing(0, 0)
            sub.path, sub.feature, sub.bin, sub.left, sub.n, sub.g, sub.gain = (list(r[c]) for c in ("path", "feature", "bin", "left", "n", "g", "gain"))
            grown[r["k"]].graft(r["node"], sub)
    return [tree.finished(fits[u].trees)[0] for tree, (u, _) in zip(grown, part)]


def _totals(fits: list[Fit], part: list[tuple[int, int]]) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, len(g) if w is None else int(w.sum()), int(g.sum())) for k, _, _, _, g, w in _inputs(batch, fits, part)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3, names=["k", "n", "g"])
    return run


def _moved(fits: list[Fit], part: list[tuple[int, int]], grown: list[H.Growing]) -> callable:
    """Adds the leaves' values of a round to the predictions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1).T
            pred = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).copy()
            for (u, _), tree in zip(part, grown):
                pred[:, u] += tree.values(fits[u].trees, fits[u].scale)[tree.route(bins)]
            ends = np.arange(0, pred.size + 1, pred.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.ListArray.from_arrays(pa.array(ends), pa.array(pred.ravel()))], names=batch.schema.names)
    return run


def _by_levels(rows: DataFrame, fits: list[Fit], in_task_rows: int) -> tuple[DataFrame, DataFrame]:
    spark = rows.sparkSession
    made, rounds = [], []

    def keep(out: list[tuple]) -> None:
        if out:
            made.append(store.staged(spark.createDataFrame(out, TREE), "trees"))  # one round or batch

    boosts = [u for u, f in enumerate(fits) if f.trees.kind == "boost"]
    errors: dict[int, list[float]] = {u: [] for u in boosts}
    if boosts:
        state = store.staged(rows.withColumn("pred", F.array(*[F.lit(f.base) for f in fits])), "boosting")
        open_, r = list(boosts), 0
        while open_:
            part = [(u, r) for u in open_]
            grown = _grown(state, fits, part, in_task_rows)
            keep([_row(fits[u], r, tree, tree.values(fits[u].trees, fits[u].scale)) for (u, _), tree in zip(part, grown)])
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields)
            before, state = state, store.staged(state.mapInArrow(_moved(fits, part, grown), kinds), "boosting")
            store.remove(before)
            found = state.where("valid").agg(*[F.sqrt(F.avg((F.col("y")[fits[u].place] - F.col("pred")[u]) ** 2)).alias(f"e{u}") for u in open_]).first()
            r += 1
            for u in list(open_):
                p = fits[u].trees
                if found[f"e{u}"] is not None:
                    errors[u].append(float(found[f"e{u}"]))
                if r >= p.trees or p.patience and errors[u] and len(errors[u]) - 1 - int(np.argmin(errors[u])) >= p.patience:
                    open_.remove(u)
        store.remove(state)
    forests = [u for u, f in enumerate(fits) if f.trees.kind == "forest"]
    for lo in range(0, max((fits[u].trees.trees for u in forests), default=0), TREES_A_BATCH):
        part = [(u, t) for u in forests for t in range(lo, min(lo + TREES_A_BATCH, fits[u].trees.trees))]
        keep([_row(fits[u], t, tree, tree.values(fits[u].trees, fits[u].scale)) for (u, t), tree in zip(part, _grown(rows, fits, part, in_task_rows))])
    out = made[0]
    for x in made[1:]:
        out = out.unionByName(x)
    for u in boosts:
        f = fits[u]
        rounds += [(f.candidate, f.horizon, i, e) for i, e in enumerate(errors[u])]
        if f.trees.patience and errors[u]:  # the rounds up to the lowest error stay
            best = int(np.argmin(errors[u]))
            out = out.where((F.col("candidate") != f.candidate) | (F.col("horizon") != f.horizon) | (F.col("tree") <= best))
    return out, spark.createDataFrame(rounds, ROUND)


# ------------------------------------------------------------ scoring
class Ensemble:
    """All trees of one model, side by side in flat arrays."""

    def __init__(self, trees: list):
        trees = sorted(trees, key=lambda r: r["tree"])
        sizes = [len(r["left"]) for r in trees]
        self.root = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        flat = lambda c, kind: np.fromiter((x for r in trees for x in r[c]), kind, sum(sizes))
        self.feature, self.bin, self.value = flat("feature", np.int64), flat("bin", np.uint8), flat("value", float)
        self.left = flat("left", np.int64) + np.repeat(self.root, sizes)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """Of rows x features. Trees are added in their order."""
        out = np.empty(len(bins))
        step = max(1, (1 << 20) // len(self.root))
        for lo in range(0, len(bins), step):
            some = bins[lo:lo + step]
            at = np.tile(self.root, len(some))
            row = np.repeat(np.arange(len(some)), len(self.root))
            live = np.flatnonzero(self.feature[at] >= 0)
            while len(live):
                here = at[live]
                at[live] = self.left[here] + (some[row[live], self.feature[here]] > self.bin[here])
                live = live[self.feature[at[live]] >= 0]
            out[lo:lo + step] = self.value[at].reshape(len(some), -1).sum(axis=1)
        return out


def _scorer(shared, kept: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column(kept).to_pylist()), np.uint8).reshape(batch.num_rows, -1) if batch.num_rows else None
            for name, horizon, model in shared.value if batch.num_rows else ():
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(kept)), pa.array([name] * batch.num_rows, pa.string()), pa.array([horizon] * batch.num_rows, pa.int32()), pa.array(model.predict(bins))],
                    names=[*batch.schema.names[:kept], "candidate", "horizon", "y_pred"])
    return run


def predictions(rows: DataFrame, trees: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., candidate, horizon, y_pred): every row of ``rows`` (keep..., bins)
    through every model of ``trees``, as many models at a time as make up
    ``MODEL_BYTES`` (one may be larger)."""
    spark = for_workers(rows.sparkSession)
    sizes = trees.groupBy("candidate", "horizon").agg(F.sum(F.size("left")).alias("nodes")).collect()  # a row for each model
    if not sizes:
        raise ValueError("no trees")
    flat = rows.select(*keep, "bins")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[:-1])
    batches, room = [], 0
    for r in sorted(sizes, key=lambda r: (r["candidate"], r["horizon"])):
        if not batches or room < r["nodes"] * 25:
            batches.append([])
            room = MODEL_BYTES
        batches[-1].append((r["candidate"], r["horizon"]))
        room -= r["nodes"] * 25
    out = None
    for batch in batches:
        some = trees.where(" or ".join(f"(candidate = '{c}' and horizon = {h})" for c, h in batch))
        found: dict[tuple, list] = {}
        for r in some.select("candidate", "horizon", "tree", "feature", "bin", "left", "value").collect():
            found.setdefault((r["candidate"], r["horizon"]), []).append(r)
        models = [(c, h, Ensemble(found[(c, h)])) for c, h in batch]
        part = flat.mapInArrow(_scorer(spark.sparkContext.broadcast(models), len(keep)), f"{kinds}, candidate string, horizon int, y_pred double")
        out = part if out is None else out.unionByName(part)
    return out
