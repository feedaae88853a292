"""Exact ranks and positions of groups that outgrow one task.

``row_number`` over a group sorts the whole group in one task. Here rows are laid
out by range partitions of (keys, order) instead, and a row's place is its place
inside its partition plus the counts of the partitions before it: one range
exchange, and a table of one row for each key and partition. Range bounds come
from a sample, so the laid-out table is checkpointed before anything reads it
twice.

Two forms:

* :func:`value_ranks`: one row for each distinct value with its count. Equal
  values are combined before the shuffle, so a value that holds a third of all
  rows is one row. Quantiles, normal scores and tests follow from the counts.
* :func:`row_positions`: every row with its position by the order columns. Rows
  that are equal in keys and order stay in one partition (sorted with spill);
  their order is arbitrary but fixed.

Null and repeated keys are keys like any other; an empty table has no ranks.
Helper columns start with ``__``, as in the other operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions import scalar as S
from seriesforge.session import cut_lineage

#: Positions that one value's explosion step makes at a time.
BLOCK = 65536


def _with_earlier(laid: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """``laid`` with, for each key and partition, __first, the weights __earlier of
    the partitions before it, and the key's ``total``."""
    parts = laid.groupBy(*keys, "__part").agg(F.sum(weight).cast("long").alias("__n"), F.min("__nth").alias("__first"))
    of_key = Window.partitionBy(*keys)  # at most one row a partition
    before = of_key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__key{i}" for i in range(len(keys))]
    sums = parts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__part").alias("__of"), "__first",
                        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__earlier"), F.sum("__n").over(of_key).alias("total"))
    cond = F.col("__part") == F.col("__of")
    for k, n in zip(keys, names):
        cond = cond & F.col(k).eqNullSafe(F.col(n))
    return laid.join(sums, cond).drop(*names, "__of")


def _laid_out(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    by = [*keys, *order]
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    return cut_lineage(laid.select(*df.columns, F.shiftright("__id", 33).alias("__part"), F.expr("__id & 8589934591L").alias("__nth")))


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n, below, total): each distinct non-null value of a group, how
    often it occurs, how many rows are smaller, and the group's non-null rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    laid = _laid_out(counts, keys, [value])
    # inside a range partition, whose size the exchange bounds
    w = Window.partitionBy("__part", *keys).orderBy("__nth").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(w), F.lit(0))
    return _with_earlier(laid, keys, F.col("n")).select(*keys, value, "n", (F.col("__earlier") + inside).alias("below"), "total")


def row_positions(df: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """``df`` with its rows numbered from 0 inside each group by ``order`` (nulls first)."""
    laid = _laid_out(df, keys, order)
    place = F.col("__earlier") + F.col("__nth") - F.col("__first")
    return _with_earlier(laid, keys, F.lit(1)).select(*df.columns, place.alias(name))


def exact_quantiles(ranks: DataFrame, keys: list[str], value: str, levels: list[float]) -> DataFrame:
    """(keys, n, q: array) by linear interpolation, equal to ``percentile``; two
    numbers a level are kept for a group, no map of its values."""
    v = F.col(value).cast("double")
    aggs = []
    for i, p in enumerate(levels):
        at = (F.col("total") - 1).cast("double") * F.lit(float(p))
        for name, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((F.col("below") <= place) & (place < F.col("below") + F.col("n")), v)).alias(f"__{name}{i}"))
    g = ranks.groupBy(*keys, "total") if keys else ranks.groupBy("total")
    found = g.agg(*aggs)

    def level(i: int, p: float) -> Column:
        at = (F.col("total") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        return F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi)

    return found.select(*keys, F.col("total").alias("n"), F.array(*[level(i, p) for i, p in enumerate(levels)]).alias("q"))


def expand_ranks(ranks: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, position, total): one row for every row that was counted,
    position from 1. A value of many rows is spread in blocks over all tasks."""
    step = F.lit(BLOCK).cast("long")
    blocks = ranks.select(*keys, value, "n", "below", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)).alias("__from"))
    blocks = blocks.repartition(*keys, value, "__from")
    upto = F.least(F.col("__from") + BLOCK, F.col("n"))
    return blocks.select(*keys, value, F.explode(F.sequence(F.col("below") + F.col("__from") + 1, F.col("below") + upto)).alias("position"), "total")


# Wichura's algorithm AS 241 (PPND16), normal quantiles to about
# 1e-16; numerator and denominator coefficients from degree 0 to 7.
CENTRE = (
    [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
     45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
    [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610])
MIDDLE = (
    [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9])
TAIL = (
    [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
     0.0265321895265761230930, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15])


def normal_quantile(p) -> Column:
    """Inverse of the standard normal distribution function, 0 < p < 1."""
    p = S.col(p)

    def ratio(table, r):
        top, bottom = F.lit(table[0][7]), F.lit(table[1][7])
        for a, b in zip(table[0][6::-1], table[1][6::-1]):
            top, bottom = top * r + F.lit(a), bottom * r + F.lit(b)
        return top / bottom

    q = p - F.lit(0.5)
    far = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    outer = F.when(far <= 5.0, ratio(MIDDLE, far - F.lit(1.6))).otherwise(ratio(TAIL, far - F.lit(5.0)))
    return F.when(F.abs(q) <= 0.425, q * ratio(CENTRE, F.lit(0.180625) - q * q)).when(q < 0, -outer).otherwise(outer)


def qq_rows(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A20, one point a row: (keys, position, sample, theoretical) with Blom's
    normal scores, the quantiles of (position - 3/8) / (n + 1/4)."""
    points = expand_ranks(value_ranks(df, keys, value), keys, value)
    p = (F.col("position") - F.lit(0.375)) / (F.col("total") + F.lit(0.25))
    return points.select(*keys, "position", F.col(value).cast("double").alias("sample"), normal_quantile(p).alias("theoretical"))


def order_normality(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A21 by order statistics (Shapiro-Francia): w is the squared correlation of
    the ordered values with their normal scores, z Royston's normalised log(1 - w),
    is_normal whether z stays below the 5 % bound. Every row counts. Also the line of
    the Q-Q plot. Groups of fewer than five rows, or of one value, have no verdict (null)."""
    points = qq_rows(df, keys, value)
    g = points.groupBy(*keys) if keys else points
    stats = g.agg(F.count(F.lit(1)).alias("n"), F.covar_samp("sample", "theoretical").alias("__c"),
                  (F.var_samp("sample") * F.var_samp("theoretical")).alias("__v"),
                  F.regr_slope("sample", "theoretical").alias("slope"), F.regr_intercept("sample", "theoretical").alias("intercept"))
    stats = stats.where("n > 0").withColumn("w", F.try_divide(F.col("__c") * F.col("__c"), F.col("__v")))
    ln = F.log(F.col("n").cast("double"))
    # Royston's (1993) approximation, and the 95 % point of the normal
    mu = F.lit(1.0521) * (F.log(ln) - ln) - F.lit(1.2725)
    sigma = F.lit(1.0308) - F.lit(0.26758) * (F.log(ln) + F.lit(2.0) / ln)
    z = F.when(F.col("n") >= 5, (F.log(F.lit(1.0) - F.col("w")) - mu) / sigma)
    return stats.select(*keys, "n", "w", z.alias("z"), (z <= 1.6448536269514722).cast("int").alias("is_normal"), "slope", "intercept")


def cut_by_rank(df: DataFrame, time: str, train_frac: float = 0.8) -> DataFrame:
    """O4 on any grain: ``df`` with ``is_train``, 1 for the first int(frac * n)
    distinct values of ``time``. Unlike ``split.date_positions`` no window holds all
    of them in one partition. Rows without a time are in neither part and go."""
    ranks = value_ranks(df.select(time).where(F.col(time).isNotNull()).distinct(), [], time)
    place = ranks.select(time, (F.col("below") < F.floor(F.col("total") * F.lit(float(train_frac)))).cast("int").alias("is_train"))
    return df.join(place, time)
