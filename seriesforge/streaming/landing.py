"""Incremental ingest (I1-I3) as Structured Streaming.

Landed documents (one JSON object per line: ``{"date_query": "YYYY-MM-DD",
"items": [{"type": ..., "daily_Accumulation": ...}, ...]}``) are picked up by
a file stream, parsed like the batch row-JSON landing (S3) and appended to a
log table. Every micro-batch writes its own folder ``batch=<id>`` with
overwrite, so a retried batch replaces exactly its own output (idempotent,
exactly-once with the stream checkpoint). The current table is the log with
the latest record per key - an aggregate (``max_by``) computed partially per
task, so a hot key never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.operators.ingest import keep_last, land_row_json
from seriesforge.sources import store

DOC_SCHEMA = T.StructType([T.StructField("date_query", T.StringType()),
                           T.StructField("items", T.StringType())])
KEYS = ["date_query", "type"]


def parse_documents(lines: DataFrame) -> DataFrame:
    """JSON lines -> long rows (date_query DATE, type, daily_accumulation)."""
    d = lines.select(F.from_json("value", DOC_SCHEMA).alias("d"))
    d = d.select(F.try_to_date(F.col("d.date_query")).alias("date_query"),
                 F.col("d.items").alias("payload"))
    return land_row_json(d, "date_query", "payload", seq_col=None).where(F.col("date_query").isNotNull())


def _append_batch(log_dir: str):
    def write(batch: DataFrame, batch_id: int):
        rows = batch.select("*", F.lit(batch_id).cast("long").alias("ingest_batch"),
                            F.monotonically_increasing_id().alias("ingest_row"))
        rows.write.mode("overwrite").parquet(store.join(log_dir, f"batch={batch_id}"))
    return write


def start_landing_stream(spark: SparkSession, landing_dir: str, log_dir: str, checkpoint: str,
                         available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; ``available_now`` processes what is there and stops."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = parse_documents(r.load(landing_dir))
    w = rows.writeStream.foreachBatch(_append_batch(log_dir)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def log_table(spark: SparkSession, log_dir: str) -> DataFrame:
    return spark.read.parquet(log_dir)


def current_table(spark: SparkSession, log_dir: str) -> DataFrame:
    """Latest record per (date_query, type) across all batches."""
    log = log_table(spark, log_dir).withColumn("ingest_order", F.struct("ingest_batch", "ingest_row"))
    return keep_last(log.select(*KEYS, "daily_accumulation", "ingest_order"), KEYS, "ingest_order") \
        .drop("ingest_order")


def high_water_mark(spark: SparkSession, log_dir: str, default_start: str) -> DataFrame:
    """I1 on the log: last landed date (one column read)."""
    if not store.exists(spark, log_dir):
        return spark.createDataFrame([(default_start,)], "last_date string") \
            .select(F.to_date("last_date").alias("last_date"))
    return log_table(spark, log_dir).agg(
        F.coalesce(F.max("date_query"), F.to_date(F.lit(default_start))).alias("last_date"))


def compact(spark: SparkSession, log_dir: str, out_dir: str) -> None:
    """Write the current table to a new folder, partitioned by month."""
    cur = current_table(spark, log_dir).withColumn("month", F.date_format("date_query", "yyyy-MM"))
    cur.hint("rebalance", "month").write.mode("error").partitionBy("month").parquet(out_dir)
