"""Folders for what a job writes to read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder for a job's files, under the cluster's shared checkpoint folder.

    Where that is unset, a local session gets one under the temporary folder; a
    cluster is refused, as its executors would not see one another's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/talkloom-files-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and read again: computed once, lineage cut durably."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as Hadoop has it; for any store that Spark reaches."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where
