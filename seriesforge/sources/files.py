"""File scans and sinks.

Parquet is the default store; CSV is read with an explicit schema (no
inference pass) and every double gets NaN -> NULL (T1), every date column is
parsed tolerantly (T10). Sinks always write a whole folder, never append to
one in place, so a failed job leaves the previous version intact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.functions.scalar import nan_to_null, tolerant_date


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             date_cols: list[str] = (), date_format: str | None = None) -> DataFrame:
    """Header CSV with a given schema. Date columns may be declared as
    strings in ``schema`` and are parsed with ``try_to_date``; numbers that do
    not parse become NULL (PERMISSIVE mode), ``NaN`` becomes NULL."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("nanValue", "NaN").csv(path))
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in date_cols:
            out.append(tolerant_date(c.cast("string"), date_format).alias(f.name))
        elif f.dataType.typeName() in ("double", "float"):
            out.append(nan_to_null(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    return df.select(*[nan_to_null(f.name).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                sort_by: list[str] | None = None) -> None:
    """Overwrite a folder; with ``sort_by`` (O1) its files taken in the
    order of their names are sorted as a whole."""
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_latest(df: DataFrame, keys: list[str], time_col: str, path: str) -> None:
    """Latest row per series, one aggregate."""
    from seriesforge.operators.forecast import latest_row
    from seriesforge.spec import SeriesSpec
    write_table(latest_row(df, SeriesSpec(tuple(keys), time_col)), path)


def write_documents(docs: DataFrame, path: str, doc_col: str = "document") -> None:
    """One JSON document per line."""
    docs.select(doc_col).write.mode("overwrite").text(path)
