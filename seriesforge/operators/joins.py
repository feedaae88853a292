"""Joins and lookups.

Broadcast policy: a side is hinted for broadcast only when its size is bounded
by construction (calendar rows, 7 horizons). Otherwise the plain join is left
to AQE, which measures the materialised side at run time and switches to a
broadcast hash join only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
- i.e. the size check happens on real statistics, without a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_exogenous(panel: DataFrame, exog: DataFrame, time_col: str = "date",
                   how: str = "inner") -> DataFrame:
    """Panel (keys, date, ...) joined with a per-date table, which has at most
    one row per calendar day and so may be sent to every task; the panel, of any
    size, is not shuffled."""
    return panel.join(F.broadcast(exog), time_col, how)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _seconds(c) -> "F.Column":
    """Seconds since 1970 of a wall-clock time, independent of the session
    time zone (epoch seconds of a cast to TIMESTAMP would shift with it)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), c.cast("timestamp_ntz"))


def nearest_time_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str,
                      keys: list[str] | None = None, truncate: str = "hour",
                      bucket_seconds: int = 86400, out_ts: str = "matched_ts") -> DataFrame:
    """For each left row, the right row whose ``right_ts`` equals the left
    time truncated to ``truncate``, else the nearest one; earlier wins ties.

    Scalable as-of: both sides are cut into time buckets. Inside a
    (keys, bucket) partition a running ``last``/``first`` (ignoring nulls)
    finds the neighbours; a neighbour outside the bucket comes from a small
    per-bucket summary (min/max right time per bucket), windowed per key. No
    cross join, no single-partition window over raw rows.
    ``right`` counts as unique on (keys, right_ts): of rows equal there one is
    used. Without keys the answers are one row per truncated time, at most the
    hours of the calendar, and are sent to every task; the raw rows stay where
    they are.
    """
    keys = list(keys or [])
    bs = F.lit(int(bucket_seconds))
    # every left row of the same truncated time has the same answer: only the
    # distinct (keys, target) pairs - bounded by keys x hours, whatever the
    # number of raw rows of a hot key - go through the as-of step, and the raw
    # rows join back on (keys, target) by an equi-join
    left_t = left.withColumn("__t", _seconds(F.date_trunc(truncate, F.col(left_ts).cast("timestamp_ntz"))))
    lcols = []
    L = left_t.select(*keys, "__t").distinct()
    L = L.withColumn("__b", F.floor(F.col("__t") / bs))
    R = right.select(*keys, _seconds(right_ts).alias("__r"))
    R = R.withColumn("__b", F.floor(F.col("__r") / bs))

    # per-bucket summary (one row per key and bucket that holds left or right
    # rows): nearest right time in earlier / later buckets
    # "following" neighbours use a running frame over the reversed order:
    # Spark recomputes an (current, unbounded following) frame for every row
    ws = Window.partitionBy(*keys).orderBy("__b") if keys else Window.orderBy("__b")
    wsd = Window.partitionBy(*keys).orderBy(F.desc("__b")) if keys else Window.orderBy(F.desc("__b"))
    allb = (L.select(*keys, "__b", F.lit(None).cast("long").alias("__r"))
            .unionByName(R.select(*keys, "__b", "__r"))
            .groupBy(*keys, "__b").agg(F.min("__r").alias("__rmin"), F.max("__r").alias("__rmax")))
    summ = allb.select(
        *keys, "__b",
        F.max("__rmax").over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("__prev_out"),
        F.min("__rmin").over(wsd.rowsBetween(Window.unboundedPreceding, -1)).alias("__next_out"))

    # left rows travel through the union with all their columns
    u = (L.select(*keys, "__b", F.col("__t").alias("__ts"), F.lit(1).alias("__isl"),
                  F.lit(None).cast("long").alias("__r"), *lcols)
         .unionByName(R.select(*keys, "__b", F.col("__r").alias("__ts"), F.lit(0).alias("__isl"), "__r"),
                      allowMissingColumns=True))
    wi = Window.partitionBy(*keys, "__b").orderBy("__ts", "__isl")
    wid = Window.partitionBy(*keys, "__b").orderBy(F.desc("__ts"), F.desc("__isl"))
    run = (Window.unboundedPreceding, Window.currentRow)
    u = u.select("*", F.last("__r", ignorenulls=True).over(wi.rowsBetween(*run)).alias("__prev_in"))
    u = u.select("*", F.last("__r", ignorenulls=True).over(wid.rowsBetween(*run)).alias("__next_in"))
    u = u.where(F.col("__isl") == 1).join(summ, [*keys, "__b"], "left")
    prev = F.coalesce("__prev_in", "__prev_out")
    nxt = F.coalesce("__next_in", "__next_out")
    t = F.col("__ts")
    chosen = (F.when(prev.isNull(), nxt).when(nxt.isNull(), prev)
              .when((t - prev) <= (nxt - t), prev).otherwise(nxt))
    m = u.select(*keys, F.col("__ts").alias("__t"), chosen.alias("__m"))
    rt = right.withColumn("__m", _seconds(right_ts)).dropDuplicates([*keys, "__m"])
    rt = rt.withColumnRenamed(right_ts, out_ts)
    matched = m.join(rt, [*keys, "__m"], "left").drop("__m")
    return left_t.join(matched if keys else F.broadcast(matched), [*keys, "__t"], "left").drop("__t")


def attach_by_position(df: DataFrame, keys: list[str], order_col: str,
                       pos_col: str = "horizon") -> DataFrame:
    """J7 helper: 1-based position of each row inside its key, by ``order_col``."""
    w = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    return df.withColumn(pos_col, F.row_number().over(w))


def next_rows_by_position(anchors: DataFrame, anchor_col: str, table: DataFrame, time_col: str,
                          n: int, pos_col: str = "pos") -> DataFrame:
    """For each anchor row, the first ``n`` rows of a per-date ``table``
    strictly after ``anchor_col``, numbered 1..n.

    Only equi-joins: the table's distinct dates are ranked, and a daily spine
    over the table's span gives for every day the rank of the next date after
    it. Both helper tables are calendar-sized (at most one row per day), so
    their single-partition windows stay bounded whatever the data volume.
    """
    d = table.select(time_col).distinct()
    ranked = d.select(time_col, F.row_number().over(Window.orderBy(time_col)).alias("__rank"))
    bounds = d.agg(F.min(time_col).alias("start"), F.max(time_col).alias("end"))
    spine = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("__day"))
    nxt = (spine.join(ranked, spine["__day"] == ranked[time_col], "left")
           .select("__day", F.last("__rank", ignorenulls=True).over(
               Window.orderBy(F.desc("__day")).rowsBetween(Window.unboundedPreceding, -1)).alias("__next")))
    a = anchors.join(nxt, anchors[anchor_col] == nxt["__day"], "inner").drop("__day")
    a = a.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias(pos_col))
    a = a.withColumn("__rank", F.col("__next") + F.col(pos_col) - 1).drop("__next")
    out = a.join(ranked, "__rank").join(table, time_col).drop("__rank")
    return out
