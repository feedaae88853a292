"""Folders on whatever file system their URI names (local, ``file://``, HDFS,
object stores), through Hadoop's own FileSystem, as Spark itself reads and
writes them. Only names are listed here, never data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from seriesforge.session import checkpoint_dir


def join(root: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), *names])


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, none if there is no such folder."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete version folders ``v=<n>``: those whose writer
    left its success marker."""
    found = [n for n in names(spark, folder) if n.startswith("v=") and n[2:].isdigit()]
    return sorted(int(n[2:]) for n in found if exists(spark, join(folder, n, "_SUCCESS")))


def next_version(spark: SparkSession, folder: str) -> str:
    """Path of a version folder past all there are, complete or not."""
    taken = [int(n[2:]) for n in names(spark, folder) if n.startswith("v=") and n[2:].isdigit()]
    return join(folder, f"v={max(taken, default=0) + 1}")


def write_version(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version folder and return its path."""
    path = next_version(df.sparkSession, folder)
    w = df.write.mode("error")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return path


def read_latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last complete version, None if there is none."""
    vs = versions(spark, folder)
    return spark.read.parquet(join(folder, f"v={vs[-1]}")) if vs else None


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it
    back: lineage is cut, and nothing is computed twice. ``path_of`` names the folder."""
    spark = df.sparkSession
    path = join(checkpoint_dir(spark), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.path_of = path
    return table


def remove(*tables: DataFrame) -> None:
    """Delete tables of :func:`staged` that nothing reads any more."""
    for table in tables:
        p, fs = _path(table.sparkSession, table.path_of)
        fs.delete(p, True)
