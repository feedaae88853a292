"""Shapley values of trees against sums over all subsets."""

import itertools
import math

import numpy as np
import pytest

from seriesforge.operators import attribution as AT
from seriesforge.operators import histogram as H
from seriesforge.plans import trees as TT
from test_trees import data


def known(tree, bins, s, i=0):
    """The expected value when only the features in ``s`` are known."""
    f = tree["feature"][i]
    if f < 0:
        return tree["value"][i]
    left = tree["left"][i]
    if f in s:
        return known(tree, bins, s, left + (bins[f] > tree["bin"][i]))
    return sum(known(tree, bins, s, c) * tree["n"][c] for c in (left, left + 1)) / tree["n"][i]


def plain(trees, bins, features):
    v = {s: sum(known(t, bins, set(s), 0) for t in trees) for k in range(features + 1) for s in itertools.combinations(range(features), k)}
    phi = []
    for j in range(features):
        total = 0.0
        for s in v:
            if j not in s:
                weight = math.factorial(len(s)) * math.factorial(features - len(s) - 1) / math.factorial(features)
                total += weight * (v[tuple(sorted((*s, j)))] - v[s])
        phi.append(total)
    return phi, v[()]


@pytest.fixture(scope="module")
def model():
    bins, y = data(400)
    trees, _ = H.boosted(bins, y, np.zeros(400, bool), H.Trees(trees=6, max_depth=6, min_leaf=4, learning_rate=0.4), float(y.mean()), 2.0 ** 20)
    return bins, y, [{"tree": i, "feature": t.feature, "bin": t.bin, "left": t.left, "n": t.n, "value": v.tolist()} for i, (t, v) in enumerate(trees)]


@pytest.mark.parametrize("table", [10, 2])
def test_equal_to_all_subsets(model, table, monkeypatch):
    monkeypatch.setattr(AT, "TABLE_FEATURES", table)
    bins, _, trees = model
    phi, expected = AT.shapley(bins, trees, 6)
    for r in (0, 17, 200, 399):
        want, mean = plain(trees, bins[:, r], 6)
        assert np.allclose(phi[:, r], want) and math.isclose(expected, mean, abs_tol=1e-9)


def test_values_sum_to_the_prediction(spark, model):
    bins, y, _ = model
    rows = spark.createDataFrame([(i, bins[:, i].tobytes(), [float(y[i])], 0) for i in range(400)], "row bigint, bins binary, y array<double>, part int").repartition(4)
    fit = TT.fitted(rows, {"m": H.Trees(trees=8, max_depth=5, max_leaves=9, min_leaf=5, learning_rate=0.3)}, [1])
    phi = {r.row: r for r in AT.attributions(rows, fit.trees, 6, ["row"]).collect()}
    pred = {r.row: r.y_pred for r in TT.predictions(rows, fit.trees, ["row"]).collect()}
    assert len(phi) == 400 and all(math.isclose(sum(p.phi) + p.expected, pred[i], rel_tol=1e-9, abs_tol=1e-9) for i, p in phi.items())
    # the expectation is the mean prediction of the training rows
    assert math.isclose(phi[0].expected, sum(pred.values()) / 400, rel_tol=1e-9, abs_tol=1e-9)
    ranked = AT.mean_absolute(AT.attributions(rows, fit.trees, 6, []), list("abcdef"), 3).collect()
    want = sorted(((sum(abs(p.phi[i]) for p in phi.values()) / 400, c) for i, c in enumerate("abcdef")), reverse=True)[:3]
    assert [r.feature for r in ranked] == [c for _, c in want] and all(math.isclose(r.importance, v, rel_tol=1e-9) for r, (v, _) in zip(ranked, want))
