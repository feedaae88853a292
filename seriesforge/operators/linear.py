"""Least squares from mergeable moments.

The sums of products of all columns are the sufficient statistics of a linear fit.
They are gathered for each part of the rows (a year, or train and test) in one pass,
tasks adding up matrices and Spark adding those of all tasks. Running sums over the
parts then are the statistics of every expanding fold, so all folds, all targets and,
with ``by``, all groups are fitted from that one pass. A group's fit is a matrix of
columns x columns; no rows are gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.session import for_workers

TOLERANCE = 1e-9  # a column with less of its square left is a combination of those before it
GROUPS_A_TASK = 256  # matrices that a task holds


def standardized(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with z, an array: 1, then every column less its mean over all rows, by
    its deviation (1 where that is 0); null is the mean. Fits do not change by it, their
    arithmetic does."""
    stats = rows.agg(*[x for i, c in enumerate(columns) for x in (F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}"))]).first()

    def z(i: int, c: str):
        return F.coalesce((F.col(f"`{c}`").cast("double") - F.lit(stats[f"m{i}"] or 0.0)) / F.lit(stats[f"s{i}"] or 1.0), F.lit(0.0))
    return rows.withColumn("z", F.array(F.lit(1.0), *[z(i, c) for i, c in enumerate(columns)]))


def _products(keys: int) -> callable:
    """(keys..., z, y) to (keys..., products): sums of products of z with z and y, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        schema = None

        def flushed() -> Iterator[pa.RecordBatch]:
            columns = [pa.array(list(c), schema.field(i).type) for i, c in enumerate(zip(*sums))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([m.ravel() for m in sums.values()], pa.list_(pa.float64()))], names=[*schema.names[:keys], "products"])
            sums.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            z, y = (batch.column(keys + i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for i in (0, 1))
            both = np.hstack([z, y])
            place: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in range(keys)))):
                place.setdefault(key, []).append(i)
            for key, some in place.items():
                if key not in sums and len(sums) >= GROUPS_A_TASK:
                    yield from flushed()
                sums[key] = sums.get(key, 0) + z[some].T @ both[some]
        if sums:
            yield from flushed()
    return run


def moments(rows: DataFrame, by: list[str], z: str = "z", y: str = "y") -> DataFrame:
    """(by..., products): the matrix of sums of products, row by row, of each group."""
    for_workers(rows.sparkSession)
    flat = rows.select(*by, z, y)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[:-2])
    parts = flat.mapInArrow(_products(len(by)), f"{kinds}, products array<double>").select(*by, F.posexplode("products").alias("place", "value"))
    cells = parts.groupBy(*by, "place").agg(F.sum("value").alias("value"))
    return cells.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda c: c["value"]).alias("products"))  # columns x columns


def solved(products: np.ndarray) -> np.ndarray:
    """Coefficients, features x targets, by elimination in the order of the features.
    One that is a combination of those before it has 0."""
    a = products.copy()
    k = len(a)
    diagonal, kept = np.diag(a[:, :k]).copy(), []
    for j in range(k):
        if a[j, j] > TOLERANCE * diagonal[j]:
            row = a[j] / a[j, j]
            a -= np.outer(a[:, j], row)
            a[j] = row
            kept.append(j)
    out = np.zeros((k, a.shape[1] - k))
    out[kept] = a[kept, k:]
    return out


def _folds(features: int, keys: list[str], part: str) -> callable:
    def run(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values(part)
        total, out = None, []
        for p, products in zip(parts[part], parts["products"]):
            if total is not None:
                out.append((p, solved(total).T.tolist()))
            now = np.array(products).reshape(features, -1)
            total = now if total is None else total + now
        kind = {part: parts[part].dtype}  # a group with one part has no fold
        columns = {**{k: [v] * len(out) for k, v in zip(keys, key)}, part: [p for p, _ in out], "coefficients": [c for _, c in out]}
        return pd.DataFrame({c: pd.Series(v, dtype=kind.get(c, object)) for c, v in columns.items()})
    return run


def fold_coefficients(sums: DataFrame, features: int, part: str, by: list[str]) -> DataFrame:
    """(by..., part, coefficients): for every part but the first the fit of all rows of
    the parts before it, an array of coefficients for each target."""
    kinds = ", ".join(f"`{c}` {sums.schema[c].dataType.simpleString()}" for c in [*by, part])
    keyed = sums if by else sums.withColumn("__all", F.lit(True))
    return keyed.groupBy(*(by or ["__all"])).applyInPandas(_folds(features, by, part), f"{kinds}, coefficients array<array<double>>")


def fold_predictions(rows: DataFrame, columns: list[str], targets: list[str], part: str, keep: list[str], by: list[str] | None = None) -> DataFrame:
    """(keep..., part, target, y_true, y_pred): every row of every part but the first,
    predicted for each of the ``targets`` (numbered from 0) by the fit of the parts
    before its own; of its group ``by``, if given."""
    by = by or []
    table = standardized(rows, columns).withColumn("__y", F.array(*[F.col(f"`{t}`").cast("double") for t in targets]))
    table = table.select(*dict.fromkeys([*keep, *by, part]), "z", "__y")
    fits = fold_coefficients(moments(table, [*by, part], "z", "__y"), len(columns) + 1, part, by)
    scored = table.join(fits, [*by, part])
    each = F.posexplode(F.arrays_zip("__y", "coefficients")).alias("target", "one")
    long = scored.select(*dict.fromkeys([*keep, part]), "z", each)
    value = F.aggregate(F.zip_with("z", "one.coefficients", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return long.select(*dict.fromkeys([*keep, part]), "target", F.col("one.__y").alias("y_true"), value.alias("y_pred"))
