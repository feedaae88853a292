"""Exact path-dependent Shapley values of histogram trees.

A leaf with value v pays v to a row that meets the conditions of its path. The
expected payment when only the features S are known replaces every unknown
feature's condition by the share r of training rows that went that way, so a leaf is
a product game: v * prod(o_k for k in S) * prod(r_k for the others), with o_k whether
the row meets the conditions on feature k. Its Shapley value for feature j is

    v * (o_j - r_j) * integral over t in [0, 1] of prod over k != j of (r_k (1 - t) + o_k t),

a polynomial in t, which Gauss-Legendre nodes integrate exactly. It depends on the
row only by the pattern of the o_k, so a leaf has a small table of values and a batch
of rows looks its patterns up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.session import for_workers

TABLE_FEATURES = 10  # on a path; with more, only the patterns that occur are worked out


def leaves(tree) -> Iterator[tuple[float, list[int], list[int], list[int], list[float]]]:
    """Of each leaf: value, and for each feature on its path the bins it lies between
    (above the first, not above the second) and the share of rows that went that way."""
    todo = [(0, {})]
    while todo:
        i, path = todo.pop()
        f = tree["feature"][i]
        if f < 0:
            yield tree["value"][i], list(path), [p[0] for p in path.values()], [p[1] for p in path.values()], [p[2] for p in path.values()]
            continue
        lo, hi, share = path.get(f, (-1, 255, 1.0))
        for child, bounds in ((tree["left"][i], (lo, min(hi, tree["bin"][i]))), (tree["left"][i] + 1, (max(lo, tree["bin"][i]), hi))):
            todo.append((child, {**path, f: (*bounds, share * tree["n"][child] / tree["n"][i])}))


def _values(met: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of the features for each pattern (patterns x features)."""
    m = len(share)
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    t = ((nodes + 1) / 2)[:, None, None]
    factor = share * (1 - t) + met * t  # above 0: every way was taken by some row, and t < 1
    rest = factor.prod(axis=2, keepdims=True) / factor
    return value * (met - share) * np.tensordot(weights / 2, rest, 1)


def shapley(bins: np.ndarray, trees: list, features: int) -> tuple[np.ndarray, float]:
    """Values (features x rows) of a batch ``bins`` (features x rows), summed over trees,
    and the expected prediction. They sum to prediction less expectation for every row."""
    out, expected = np.zeros((features, bins.shape[1])), 0.0
    for tree in trees:
        for value, on, lo, hi, share in leaves(tree):
            expected += value * float(np.prod(share))
            if not on or not value:
                continue
            code = np.zeros(bins.shape[1], np.int32)
            for k, (f, a, b) in enumerate(zip(on, lo, hi)):
                code |= ((bins[f] > a) & (bins[f] <= b)).astype(np.int32) << k
            patterns, place = (np.arange(1 << len(on)), code) if len(on) <= TABLE_FEATURES else np.unique(code, return_inverse=True)
            met = (patterns[:, None] >> np.arange(len(on)) & 1).astype(float)
            table = _values(met, np.array(share), value)
            for k, f in enumerate(on):
                out[f] += table[:, k].take(place)
    return out, expected


def _attributing(shared, kept: int, features: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bins = np.ascontiguousarray(np.frombuffer(b"".join(batch.column(kept).to_pylist()), np.uint8).reshape(n, -1).T)
            phi, expected = shapley(bins, shared.value, features)
            ends = np.arange(0, n * features + 1, features, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(kept)), pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.T.ravel())), pa.array(np.full(n, expected))],
                names=[*batch.schema.names[:kept], "phi", "expected"])
    return run


def attributions(rows: DataFrame, trees: DataFrame, features: int, keep: list[str]) -> DataFrame:
    """(keep..., phi, expected): the Shapley values of every row of ``rows`` (keep...,
    bins) under one model: its ``trees``, a table of :mod:`seriesforge.plans.trees`,
    whose size is set by the model's parameters."""
    spark = for_workers(rows.sparkSession)
    model = [r.asDict() for r in trees.select("tree", "feature", "bin", "left", "value", "n").orderBy("tree").collect()]
    flat = rows.select(*keep, "bins")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in flat.schema.fields[:-1])
    return flat.mapInArrow(_attributing(spark.sparkContext.broadcast(model), len(keep), features), f"{kinds}phi array<double>, expected double")


def mean_absolute(phi: DataFrame, names: list[str], top: int) -> DataFrame:
    """(rank, feature, importance), the ``top`` features by mean absolute value;
    equal ones by name. One aggregation."""
    sums = phi.agg(*[F.avg(F.abs(F.col("phi")[i])).alias(f"v{i}") for i in range(len(names))]).first()
    ranked = sorted(((float(sums[f"v{i}"] or 0.0), c) for i, c in enumerate(names)), key=lambda x: (-x[0], x[1]))[:top]
    return phi.sparkSession.createDataFrame([(i + 1, c, v) for i, (v, c) in enumerate(ranked)], "rank int, feature string, importance double")
