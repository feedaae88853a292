"""Helpers that the operators of this subpackage share.

Intermediate results that several later steps read are written once as Parquet
into the folder that the cluster names in ``spark.checkpoint.dir`` (every
executor and the driver see it, and it outlives a lost executor), so lineage is
cut and no step is computed twice. A table read back also has no partitioning
of its own: both sides of a later join get an exchange, which is what lets
adaptive execution split a hot key.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.session import checkpoint_dir


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Local sessions: Python workers import this package from where it lies. On
    a cluster it is installed, or shipped with --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write ``df`` into the shared folder and return the table read back; rows that
    differ in ``by``, its last columns, lie in different files."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.mode("overwrite").parquet(path, partitionBy=[*by] or None)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def drop_stored(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` returned and nothing will read again."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that start inside hand Python at most so many rows at a time. For rows
    that hold whole groups: a batch of them lies in memory twice in the executor and
    again in the worker, in every task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Joins that start inside hash their smaller side, not sort both, wherever each
    of its partitions is at most one of the size that adaptive execution aims at."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files of finished jobs now. Spark's cleaner removes them
    once the driver's garbage collection finds that nothing refers to them; a
    driver with memory to spare may not collect for the whole run."""
    spark.sparkContext._jvm.System.gc()


def utf8(text: str) -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(text).cast("string").cast("binary"), F.lit(b""))


def hidden(df: DataFrame, stem: str) -> str:
    """A helper column name that clashes with no column of ``df``."""
    name, taken = f"_{stem}", {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
