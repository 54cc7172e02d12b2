"""Shared storage for intermediate tables: written once, read again, lineage cut."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a purely local session (``local`` or ``local[n]``) may leave it unset;
    a temporary folder then serves. A cluster without the setting is an error,
    as its executors could not see each other's files.
    """
    base = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    base = os.path.join(tempfile.gettempdir(), "checkpoints")
    return f"file://{base}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cartoscope/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a table scan.

    Lost executors cost at most the tasks that read it, never its lineage.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that :func:`store` returned and nothing reads any more."""
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/cartoscope/"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()):
            path.getFileSystem(conf).delete(path, True)
