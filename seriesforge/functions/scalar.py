"""Scalar column functions (F1-F17, D3, D4 and the semantic traps T1-T17).

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest positive double step used as the MAPE denominator floor.
MAPE_EPS = 2.220446049250313e-16


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """A NaN read from text is a missing value, not a number."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def normalize_name(c) -> Column:
    """F1: lower-case, spaces to underscores."""
    return F.regexp_replace(F.lower(col(c)), " ", "_")


def normalize_name_py(name: str) -> str:
    return str(name).lower().replace(" ", "_")


def tolerant_date(c, fmt: str | None = None) -> Column:
    """unparsable text becomes NULL instead of failing under ANSI mode."""
    c = col(c)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c)


def tolerant_double(c) -> Column:
    """``errors='coerce'`` for numbers; NaN text also becomes NULL."""
    return nan_to_null(col(c).try_cast("double"))


def weekday0(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col(c))


def day_name(c) -> Column:
    return F.date_format(col(c), "EEEE")


def is_weekend(c) -> Column:
    """Saturday or Sunday as 0/1 int."""
    return (F.weekday(col(c)) >= 5).cast("int")


def cyclic_sin(c, period: float) -> Column:
    """F5"""
    return F.sin(F.lit(2.0 * math.pi) * col(c) / F.lit(float(period)))


def cyclic_cos(c, period: float) -> Column:
    return F.cos(F.lit(2.0 * math.pi) * col(c) / F.lit(float(period)))


def clip_lower(c, lower=0) -> Column:
    """Clip at ``lower`` but keep NULL (``greatest`` would not).
    The bound literal takes the column's type (decimal stays decimal)."""
    c = col(c)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def flag_gt(c, threshold: float) -> Column:
    """``(x > t).astype(int)``; a missing x gives 0."""
    return F.coalesce(col(c) > F.lit(threshold), F.lit(False)).cast("int")


def weather_condition(rain) -> Column:
    """rain > 5 Rain, > 0 Clouds, else Clear; missing counts as 0."""
    r = F.coalesce(col(rain), F.lit(0.0))
    return (F.when(r > 5, "Rain").when(r > 0, "Clouds").otherwise("Clear"))


def correlation_strength(r) -> Column:
    """strength text by absolute correlation."""
    a = F.abs(col(r))
    return (F.when(a > 0.7, "Very Strong").when(a > 0.5, "Strong")
            .when(a > 0.3, "Moderate").otherwise("Weak"))


def correlation_sign(r) -> Column:
    return F.when(col(r) > 0, "positive").when(col(r) < 0, "negative").otherwise("none")


def confidence_bucket(spread) -> Column:
    """< 2 high, < 3 medium, else low."""
    s = col(spread)
    return F.when(s < 2, "high").when(s < 3, "medium").otherwise("low")


def mape_tier(mape) -> Column:
    """< 3 Excellent, 3-5 Good, 5-10 Reasonable, > 10 Poor."""
    m = col(mape)
    return (F.when(m < 3, "Excellent").when(m <= 5, "Good")
            .when(m <= 10, "Reasonable").otherwise("Poor"))


def skew_label(s) -> Column:
    """A13"""
    s = col(s)
    return (F.when(F.abs(s) < 0.5, "Fairly symmetric")
            .when(s > 0, "Right-skewed").otherwise("Left-skewed"))


def kurtosis_label(k) -> Column:
    k = col(k)
    return (F.when(F.abs(k) < 0.5, "Normal tails")
            .when(k > 0, "Heavy tails").otherwise("Light tails"))


def interval_bounds(pred, width, default: float, z: float = 1.0):
    """``pred -/+ z * coalesce(width, default)`` rounded to 2."""
    w = F.coalesce(col(width), F.lit(float(default))) * F.lit(float(z))
    return F.round(col(pred) - w, 2), F.round(col(pred) + w, 2)


def pct_change_or_zero(new, base) -> Column:
    """Change % from a base; 0 when the base is missing or 0."""
    b = col(base)
    return F.when(b.isNull() | (b == 0), F.lit(0.0)).otherwise(
        (col(new) - b) / b * F.lit(100.0))


def pct_change_positive_base(new, base) -> Column:
    """Change % only when the base is > 0, else NULL (shown as '-')."""
    b = col(base)
    return F.when(b > 0, (col(new) - b) / b * F.lit(100.0))


def mape_term(y, yhat) -> Column:
    """|y - yhat| / max(|y|, eps)."""
    return F.abs(col(y) - col(yhat)) / F.greatest(F.abs(col(y)), F.lit(MAPE_EPS))


def tie_stable_round(x, scale: int) -> Column:
    """floor(x * 10^s + 0.5) / 10^s in plain double arithmetic: any engine
    that computes the same double gets the same rounded value, ties included
    (decimal-string rounding and scaled rounding disagree on exact ties).
    Values beyond 1e15 and non-finite values pass through."""
    p = float(10 ** scale)
    r = F.floor(x * F.lit(p) + F.lit(0.5)).cast("double") / F.lit(p)
    return F.when(F.abs(x) < F.lit(1e15), r + F.lit(0.0)).otherwise(x)


def tie_stable_round_sql(x: str, scale: int) -> str:
    p = float(10 ** scale)  # D suffix: double literals (plain 10000.0 is a decimal in Spark SQL)
    return (f"CASE WHEN abs({x}) < 1e15D THEN CAST(floor({x} * {p}D + 0.5D) AS DOUBLE) / {p}D + 0.0D "
            f"ELSE {x} END")


def round_doubles(df, scale: int = 4, scales: dict | None = None):
    """Output normalisation at the oracle boundary: decimals and floats to
    rounded doubles (:func:`tie_stable_round`), small ints to bigint. Built
    as one ``selectExpr`` (one call into the JVM for all columns)."""
    scales = scales or {}
    exprs = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        q = f"`{f.name}`"
        if t in ("double", "float", "decimal"):
            x = f"CAST({q} AS DOUBLE)"
            exprs.append(f"{tie_stable_round_sql(x, scales.get(f.name, scale))} AS {q}")
        elif t in ("integer", "short", "byte"):
            exprs.append(f"CAST({q} AS BIGINT) AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)
