"""Session helpers: sensible defaults, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "seriesforge", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` stays ``None`` so the launcher decides.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there (a static setting: it cannot be
    changed at run time). Only when neither it nor the context's checkpoint
    folder is set (tests, local runs) do we make one of our own, and only on
    a local master.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "folder there (never a machine-local temporary folder)")
    d = tempfile.mkdtemp(prefix="seriesforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def for_workers(spark: SparkSession) -> SparkSession:
    """Python workers import this package from where it lies, unless the session
    says otherwise. On a cluster it is installed, or shipped with --py-files."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
