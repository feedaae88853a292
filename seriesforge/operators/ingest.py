"""Landing, dedupe, pivot and incremental ingest (S3, S4, W10, A1, P1, P4,
I1-I4, U1, U2, F1, F2).

Keep-last is an aggregate (``max_by`` over the ingest sequence), not a
``row_number`` window: the aggregate is computed partially inside every map
task, so a key that holds a third of all rows is reduced to one row per task
before the shuffle instead of being sorted in one task. For fixed-width columns
it is a hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.functions import scalar as S

# The wide energy columns expected after the pivot (target first).
WIDE_COLUMNS = [
    "corrigido_temperatura", "solar", "eolica", "hidrica", "gas_natural", "biomassa",
    "outra_termica", "importacao", "exportacao", "producao_bombagem",
    "consumo_bombagem", "consumo_armazenamento",
]

# the items of an array stay JSON text first: one that is no object must not
# make the parser give up on the others
ROW_PAYLOAD = T.ArrayType(T.StringType())
ROW_ITEM = T.StructType([
    T.StructField("type", T.StringType()),
    # read as text: a quoted number is still a number
    T.StructField("daily_Accumulation", T.StringType()),
])

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def keep_last(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key, the one with the highest ``order_col``.

    A row without an order value comes before all others, so it is kept only
    if its key has no other. Of rows with equal order values one whole row is
    kept. Keys may be NULL; equal NULL keys are one key."""
    rest = [c for c in df.columns if c not in keys]
    order = order_or_lowest(df, order_col)
    if all(isinstance(df.schema[c].dataType, _FIXED_WIDTH) for c in rest):
        return df.groupBy(*keys).agg(*[F.max_by(F.col(c), order).alias(c) for c in rest])
    agg = F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("__last")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"__last.{c}").alias(c) for c in rest])


def order_or_lowest(df: DataFrame, order_col: str):
    """``order_col`` with NULL as the lowest value of its type (``max_by``
    skips rows whose order is NULL)."""
    kind, c = df.schema[order_col].dataType, F.col(order_col)
    if isinstance(kind, T.IntegralType):
        bits = {"byte": 8, "short": 16, "integer": 32, "long": 64}[kind.typeName()]
        return F.coalesce(c, F.lit(-2 ** (bits - 1)).cast(kind))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(c, F.lit(float("-inf")).cast(kind))
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(c, F.lit("0001-01-01").cast(kind))
    return F.struct(c.isNotNull().alias("known"), c.alias("value"))


def land_row_json(payloads: DataFrame, date_col: str = "date_query",
                  payload_col: str = "payload", seq_col: str | None = "ingest_seq",
                  keep: list[str] | None = None) -> DataFrame:
    """S3: one JSON array of ``{"type", "daily_Accumulation"}`` objects per
    date -> long rows ([keep...,] date_query, type, daily_accumulation
    [, ingest_seq]). Items without a type or a value, and items that are no
    objects (numbers, texts, nulls, arrays), are dropped one by one; type is
    lower-cased."""
    extra = list(keep or [])
    cols = [*extra, F.col(date_col).alias("date_query")] + ([F.col(seq_col)] if seq_col else [])
    items = payloads.select(*cols, F.explode(F.from_json(payload_col, ROW_PAYLOAD)).alias("item"))
    items = items.select("*", F.from_json("item", ROW_ITEM).alias("it"))
    rows = items.select(
        *extra, F.col("date_query"), F.lower(F.col("it.type")).alias("type"),
        S.tolerant_double(F.col("it.daily_Accumulation")).alias("daily_accumulation"),
        *([F.col(seq_col)] if seq_col else []))
    return rows.where(F.col("type").isNotNull() & F.col("daily_accumulation").isNotNull())


def columnar_schema(variables: list[str], block: str = "daily") -> T.StructType:
    fields = [T.StructField("time", T.ArrayType(T.StringType()))]
    fields += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType([T.StructField(block, T.StructType(fields))])


def land_columnar_json(payloads: DataFrame, variables: list[str], payload_col: str = "payload",
                       block: str = "daily", keep: list[str] | None = None) -> DataFrame:
    """``{"daily": {"time": [...], "<var>": [...]}}`` -> one row per time
    entry, ``time`` renamed to ``date`` (parsed tolerantly). A payload without
    the block yields no rows."""
    keep = keep or []
    p = payloads.select(*keep, F.from_json(payload_col, columnar_schema(variables, block)).alias("j"))
    z = p.select(*keep, F.explode(F.arrays_zip(
        *[F.col(f"j.{block}.time").alias("time")] +
        [F.col(f"j.{block}.{v}").alias(v) for v in variables])).alias("z"))
    return z.select(*keep, S.tolerant_date(F.col("z.time")).alias("date"),
                    *[S.nan_to_null(F.col(f"z.{v}")).alias(v) for v in variables])


def pivot_wide(long: DataFrame, values: list[str], date_col: str = "date_query",
               type_col: str = "type", value_col: str = "daily_accumulation",
               seq_col: str | None = "ingest_seq", keys: list[str] | None = None) -> DataFrame:
    """A1: long -> wide with a fixed value list (schema known at plan time, no
    distinct-values job). NULL keys/values dropped (P4), names normalised (F1),
    latest row per (date, type) kept (T6/T7)."""
    keys = list(keys or [])
    df = (long.select(*keys, S.tolerant_date(F.col(date_col).cast("string")).alias("date"),
                      S.normalize_name(type_col).alias("type"),
                      S.tolerant_double(F.col(value_col)).alias("value"),
                      *([F.col(seq_col)] if seq_col else []))
          .dropna(subset=["date", "type", "value"]))
    norm = [S.normalize_name_py(v) for v in values]
    if seq_col:
        # dedupe and pivot in one partial aggregation on the date: per pivot
        # value, the value of the row with the highest sequence (rows of other
        # types have a NULL ordering and are skipped by max_by)
        t, seq = F.col("type"), order_or_lowest(df, seq_col)
        return df.groupBy(*keys, "date").agg(
            *[F.max_by("value", F.when(t == F.lit(v), seq)).alias(v) for v in norm])
    return df.groupBy(*keys, "date").pivot("type", norm).agg(F.max("value"))


def select_available(df: DataFrame, wanted: list[str], required: list[str] = (),
                     always: list[str] = ("date",)):
    """Keep the wanted columns that exist, report the missing ones,
    fail before any job if a required one is absent."""
    missing = [c for c in wanted if c not in df.columns]
    absent_required = [c for c in required if c not in df.columns]
    if absent_required:
        raise ValueError(f"required column(s) not found: {absent_required}")
    keep = [c for c in always if c in df.columns] + [c for c in wanted if c in df.columns]
    return df.select(*keep), missing


def high_water_mark(df: DataFrame, time_col: str, keys: list[str] | None = None,
                    default_start: str | None = None) -> DataFrame:
    """Last stored date per key (or overall); ``default_start`` when
    nothing is stored. Only ``time_col`` (and keys) are read from the scan."""
    keys = list(keys or [])
    mark = F.max(time_col)
    if default_start:
        mark = F.coalesce(mark, F.to_date(F.lit(default_start)))
    g = df.select(*keys, time_col)
    return (g.groupBy(*keys) if keys else g).agg(mark.alias("last_date"))


def new_rows(landed: DataFrame, stored: DataFrame | None, time_col: str, keys: list[str],
             default_start: str | None = None, end=None) -> DataFrame:
    """I1/I2 per series: landed rows after the stored mark of their series, or
    from ``default_start`` on (that day included) if it has no stored rows, up to
    ``end`` (included)."""
    mark = None
    if stored is not None:
        mark = high_water_mark(stored, time_col, keys)
        landed = landed.join(mark, keys, "left")
    else:
        landed = landed.withColumn("last_date", F.lit(None).cast("date"))
    if default_start:
        landed = landed.withColumn("last_date", F.coalesce("last_date", F.date_sub(F.to_date(F.lit(default_start)), 1)))
    bounded = delta_after(landed, time_col, F.coalesce("last_date", F.to_date(F.lit("0001-01-01"))),
                          None if end is None else F.lit(end).cast("date"))
    return bounded.drop("last_date")


def require_values(long: DataFrame, wanted: list[str], required: list[str], type_col: str = "type") -> list[str]:
    """P1/P2/U3 on landed long rows, before anything is written: the wanted
    values that do not occur; raises if a required one is among them. Only the
    wanted names are looked for, so the answer has at most as many rows."""
    names = {S.normalize_name_py(v) for v in wanted}
    seen = {r[0] for r in long.select(S.normalize_name(type_col).alias("t")).where(F.col("t").isin(list(names))).distinct().collect()}
    absent = [v for v in required if S.normalize_name_py(v) not in seen]
    if absent:
        raise ValueError(f"required column(s) not found: {absent}")
    return [v for v in wanted if S.normalize_name_py(v) not in seen]


def delta_after(df: DataFrame, time_col: str, mark, end=None) -> DataFrame:
    """Rows after the mark up to the end date (both literals or columns)."""
    cond = F.col(time_col) > (F.lit(mark) if not hasattr(mark, "_jc") else mark)
    if end is not None:
        cond &= F.col(time_col) <= (F.lit(end) if not hasattr(end, "_jc") else end)
    return df.where(cond)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq_col: str) -> DataFrame:
    """Old union new aligned by name, latest per key wins."""
    return keep_last(old.unionByName(new, allowMissingColumns=True), keys, seq_col)


def freshness(stages: dict[str, DataFrame], time_col: str, as_of) -> DataFrame:
    """I4: (stage, last_date, expected, stale) where expected = as_of - 1 day."""
    parts = [df.agg(F.max(time_col).alias("last_date")).select(F.lit(name).alias("stage"), "last_date")
             for name, df in stages.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    exp = F.date_sub(F.lit(as_of).cast("date") if not hasattr(as_of, "_jc") else as_of, 1)
    return u.select("stage", "last_date", exp.alias("expected"),
                    F.coalesce(F.col("last_date") != exp, F.lit(True)).cast("int").alias("stale"))


def upsert_partitions(spark, table_path: str, new: DataFrame, keys: list[str], seq_col: str,
                      time_col: str = "date_query", partition_col: str = "month") -> list[str]:
    """I3 at scale: rewrite only the month partitions the new rows touch.

    The affected months (a calendar-sized list) are read back with partition
    pruning, upserted with the new rows, checkpointed into the shared folder
    (so the overwrite never reads the files it replaces), then written with
    dynamic partition overwrite: every other month is left untouched.
    Returns the rewritten months.
    """
    from seriesforge.session import cut_lineage
    from seriesforge.sources.store import exists
    new = new.withColumn(partition_col, F.date_format(time_col, "yyyy-MM"))
    months = sorted(r[0] for r in new.select(partition_col).distinct().collect())  # <= 12 per year
    if not months:
        return []
    if exists(spark, table_path):
        old = spark.read.parquet(table_path).where(F.col(partition_col).isin(months))
        merged = keep_last(old.unionByName(new, allowMissingColumns=True), keys, seq_col)
    else:
        merged = keep_last(new, keys, seq_col)
    merged = cut_lineage(merged.select(*new.columns))
    # rebalance: files of one size, a month of any size is split over tasks
    (merged.hint("rebalance", partition_col).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_path))
    return months
