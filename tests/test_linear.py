"""Least squares from moments against numpy's, on folds and groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import linear as LN


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for i in range(900):
        a, b = rng.normal(size=2)
        out.append((i, "g" if i % 3 else "h", 2000 + i % 4, float(a), float(b), float(2 * a - b), 5.0, float(3 * a - b + rng.normal()), float(i % 7)))
    return spark.createDataFrame(out, "id int, g string, yr int, a double, b double, ab double, one double, t1 double, t2 double").repartition(6)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_folds_equal_lstsq(rows, by):
    got = {(r.id, r.target): r for r in LN.fold_predictions(rows, ["a", "b", "ab", "one"], ["t1", "t2"], "yr", ["id"], by).collect()}
    data = rows.collect()
    want = 0
    for year in (2001, 2002, 2003):
        for g in ("g", "h") if by else (None,):
            mine = [r for r in data if g is None or r.g == g]
            x = np.array([[1, r.a, r.b] for r in mine if r.yr < year])
            for k, t in enumerate(("t1", "t2")):
                beta = np.linalg.lstsq(x, np.array([r[t] for r in mine if r.yr < year]), rcond=None)[0]
                for r in mine:
                    if r.yr == year:
                        want += 1
                        assert got[r.id, k].y_pred == pytest.approx(beta @ [1, r.a, r.b], abs=1e-8) and got[r.id, k].y_true == r[t]
    assert len(got) == want


def test_moments_do_not_depend_on_partitions(rows):
    table = LN.standardized(rows, ["a", "b"]).withColumn("y", F.array("t1"))
    a, b = ({r.yr: r.products for r in LN.moments(t, ["yr"]).collect()} for t in (table, table.coalesce(1)))
    assert all(np.allclose(a[y], b[y]) for y in a) and len(a) == 4 and len(a[2000]) == 3 * 4


def test_nulls_and_empty(spark, rows):
    some = rows.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    assert all(r.y_pred == r.y_pred for r in LN.fold_predictions(some, ["a"], ["t1"], "yr", ["id"]).collect())
    assert LN.fold_predictions(rows.limit(0), ["a"], ["t1"], "yr", ["id"]).collect() == []
    assert LN.fold_predictions(rows.where("yr = 2000"), ["a"], ["t1"], "yr", ["id"]).collect() == []
