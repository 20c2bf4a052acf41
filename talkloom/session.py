"""The session that the library is tested and benchmarked with."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

#: The folder that holds this package.
HOME = str(Path(__file__).resolve().parent.parent)


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session; on a cluster the deployment's own settings apply."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("talkloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package, wherever the driver
    was started; on a cluster it is shipped or installed as any other."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, HOME])
