"""Histogram trees: the split search against all splits, the way by levels against
the way inside tasks, patience, and stored models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import histogram as H
from seriesforge.plans import trees as TT


def data(n=1500, seed=3, features=6):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(features, n)), 2)
    x[4] = rng.integers(0, 2, n)
    y = 3 * x[0] + np.sin(3 * x[1]) * 2 + x[2] * x[3] + 2 * x[4] + rng.normal(size=n) * 0.3
    bins = np.stack([np.searchsorted(np.unique(np.quantile(v, np.arange(1, 256) / 256)), v) for v in x]).astype(np.uint8)
    return bins, y


def plain_best(bins, y, rows, w, p):
    """The best split of the rows by trying all."""
    best = (0.0, None, None)
    total, n = sum(y[i] * w[i] for i in rows), sum(w[i] for i in rows)
    for f in range(len(bins)):
        for b in sorted({int(bins[f, i]) for i in rows}):
            left = [i for i in rows if bins[f, i] <= b]
            nl, gl = sum(w[i] for i in left), sum(y[i] * w[i] for i in left)
            if nl >= p.min_leaf and n - nl >= max(1, p.min_leaf) and n >= p.min_split:
                gain = gl ** 2 / (nl + p.l2) + (total - gl) ** 2 / (n - nl + p.l2) - total ** 2 / (n + p.l2)
                if gain > best[0] * (1 + 1e-9) + 1e-9:
                    best = (gain, f, b)
    return best


@pytest.mark.parametrize("weighted, p", [(False, H.Trees(max_depth=3, min_leaf=5)), (True, H.Trees("forest", 5, 4, min_leaf=2, min_split=5)), (False, H.Trees(max_depth=2, l2=1.0))])
def test_splits_are_the_best(weighted, p):
    bins, y = data(120)
    w = H.draws(np.arange(120), 1, 0) if weighted else None
    g = H.gradients(y, 2.0 ** 20)
    tree, node = H.grow(bins, g if w is None else g * w, w, p, H.by_bin(bins))
    members = {0: [i for i in range(120) if w is None or w[i]]}
    for i in range(len(tree.n)):
        if tree.left[i] >= 0:
            gain, f, b = plain_best(bins, g / 2.0 ** 20, members[i], np.ones(120, int) if w is None else w, p)
            assert (tree.feature[i], tree.bin[i]) == (f, b) and math.isclose(tree.gain[i] / 2.0 ** 40, gain, rel_tol=1e-6)
            members[tree.left[i]] = [r for r in members[i] if bins[f, r] <= b]
            members[tree.left[i] + 1] = [r for r in members[i] if bins[f, r] > b]
        elif tree.path[i].bit_length() <= p.max_depth:
            assert plain_best(bins, g / 2.0 ** 20, members[i], np.ones(120, int) if w is None else w, p)[0] == 0
    assert all(node[r] == i for i, rows in members.items() if tree.left[i] < 0 for r in rows)


def test_leaf_limit_is_best_first():
    """Cutting a full tree best first equals making one split after the other."""
    bins, y = data(600)
    g, p = H.gradients(y, 2.0 ** 20), H.Trees(max_depth=6, max_leaves=9, min_leaf=3)
    whole, _ = H.grow(bins, g, None, H.Trees(max_depth=6, min_leaf=3), H.by_bin(bins))
    cut, new = whole.finished(p)
    pruned, _ = H.grow(bins, g, None, p, H.by_bin(bins))
    assert pruned.finished(p)[0].__dict__ == cut.__dict__
    leaves, splits = {0}, 0
    while splits < 8:
        i = max((i for i in leaves if whole.left[i] >= 0), key=lambda i: whole.gain[i])
        leaves = leaves - {i} | {whole.left[i], whole.left[i] + 1}
        splits += 1
    assert {whole.path[i] for i in leaves} == {q for q, left in zip(cut.path, cut.left) if left < 0}
    assert sum(left < 0 for left in cut.left) == 9 and all(n >= 3 for n in cut.n)
    ends = whole.route(bins)
    assert (new[ends] == cut.route(bins)).all()


def test_sums_of_parts_give_the_same_split():
    bins, y = data(900)
    g, node, p = H.gradients(y, 2.0 ** 20), (np.arange(900) % 3).astype(np.uint16), H.Trees(min_leaf=4)
    whole = H.best_splits(*H.histogram(bins, H.by_bin(bins), node, g, None), 3, p)
    sums = {}
    for part in np.array_split(np.random.default_rng(1).permutation(900), 7):
        some = np.ascontiguousarray(bins[:, part])
        for f, k, b, n, t in zip(*H.histogram(some, H.by_bin(some), node[part], g[part], None)):
            old = sums.get((f, k, b), (0, 0))
            sums[f, k, b] = old[0] + n, old[1] + t
    rows = [(*k, *v) for k, v in sorted(sums.items())]
    again = H.best_splits(*(np.array(c) for c in zip(*rows)), 3, p)
    assert all((a == b).all() for a, b in zip(whole, again))


@pytest.fixture(scope="module")
def table(spark):
    bins, y = data(700)
    rows = [(i, bins[:, i].tobytes(), [float(y[i]), float(y[i] * 2 - bins[0, i])], 0 if i < 500 else 1 if i < 600 else None) for i in range(700)]
    return spark.createDataFrame(rows, "row bigint, bins binary, y array<double>, part int").repartition(5)


CANDIDATES = {"forest": H.Trees("forest", 3, 5, min_leaf=2, min_split=5), "leaves": H.Trees(trees=3, max_leaves=7, max_depth=4, min_leaf=10, learning_rate=0.3),
              "levels": H.Trees(trees=4, max_depth=3, l2=1.0, min_leaf=3, learning_rate=0.5, patience=2)}


def models(fit):
    return sorted(tuple(r) for r in fit.trees.collect())


def test_levels_equal_tasks(spark, table):
    """Table sizes decide how a fit runs, not what it gives: the same trees to the bit."""
    inside = TT.fitted(table, CANDIDATES, [1, 2])
    levels = TT.fitted(table, CANDIDATES, [1, 2], in_task_rows=60)
    a, b = models(inside), models(levels)
    assert len(a) == 2 * (3 + 3 + 4 + 3) and a == b
    assert [(r[0], r[1], r[2], round(r[3], 9)) for r in sorted(inside.rounds.collect())] == [(r[0], r[1], r[2], round(r[3], 9)) for r in sorted(levels.rounds.collect())]


def test_predictions_from_stored_trees(spark, table):
    fit = TT.fitted(table, CANDIDATES, [1, 2])
    got = {(r.row, r.candidate, r.horizon): r.y_pred for r in TT.predictions(table, fit.trees, ["row"]).collect()}
    assert len(got) == 700 * 6
    trees = {}
    for r in fit.trees.collect():
        trees.setdefault((r.candidate, r.horizon), []).append(r)
    for r in table.limit(40).collect():
        for (c, h), some in trees.items():
            total = 0.0
            for t in some:
                i = 0
                while t.feature[i] >= 0:
                    i = t.left[i] + (r.bins[t.feature[i]] > t.bin[i])
                total += t.value[i]
            assert math.isclose(got[r.row, c, h], total, rel_tol=1e-9, abs_tol=1e-9)


def test_patience_keeps_the_best_round(spark, table):
    noisy = {"b": H.Trees(trees=40, max_depth=6, learning_rate=0.8, patience=5)}
    fit = TT.fitted(table, noisy, [1])
    errors = [r.validation_rmse for r in sorted(fit.rounds.collect(), key=lambda r: r["round"])]
    kept = fit.trees.where("tree >= 0").count()
    best = errors.index(min(errors))
    assert kept == best + 1 and (len(errors) == best + 1 + 5 or len(errors) == 40) and best + 1 < len(errors)
    # the errors are those of the kept trees on the validation rows
    p = TT.predictions(table.where("part = 1"), fit.trees, ["row", "y"])
    assert math.isclose(p.select(F.sqrt(F.avg((F.col("y")[0] - F.col("y_pred")) ** 2))).first()[0], min(errors), rel_tol=1e-9)


def test_no_task_holds_a_large_node(spark, table):
    """By levels the groups are histograms: at most 256 sums a feature."""
    fits = [TT.Fit("b", 1, 0, H.Trees(), 0.0, 2.0 ** 20)]
    rows = table.withColumn("valid", F.lit(False)).withColumn("pred", F.array(F.lit(0.0))).select("row", "bins", "y", "valid", "pred")
    sums = rows.mapInArrow(TT._summed(fits, [(0, 0)], [H.Growing(700, 0)], [[0]]), "k bigint, node bigint, feature bigint, bin bigint, n bigint, g bigint")
    whole = sums.groupBy("k", "node", "feature", "bin").agg(F.sum("n").alias("n"))
    assert whole.count() <= 6 * 256 and whole.agg(F.sum("n")).first()[0] == 6 * 700
