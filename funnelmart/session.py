"""Session settings the package is meant to run with."""

from __future__ import annotations

import atexit
import os
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

from funnelmart.sources.tables import remove

SHARED_FOLDER = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# On one machine tables are small: with small row groups all cores can share in reading them.
LOCAL_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.driver.memory": "12g",
    "spark.hadoop.parquet.block.size": str(4 << 20),
}

_folders: set[str] = set()


def local_session(cpus: int | str = "*", app: str = "funnelmart", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    partitions = "8" if cpus == "*" else str(cpus)
    for name, value in {
        **SETTINGS,
        **LOCAL_SETTINGS,
        "spark.sql.shuffle.partitions": partitions,
        **extra,
    }.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Have Python workers look for this package where the driver found it.

    Needed where it is neither installed nor on the workers' path; a cluster gets it by ``--py-files``.
    """
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parent.parent)
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def shared_folder(spark: SparkSession) -> str:
    """The application's folder, which every executor can reach.

    It lies in the folder that the session names in ``spark.checkpoint.dir``, else in the warehouse, and
    is removed when Python exits.
    """
    root = spark.conf.get(SHARED_FOLDER, None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/funnelmart/{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(remove_at_exit, spark, folder)
    return folder


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        remove(spark, folder)
    except (Py4JError, OSError):  # the engine has ended first
        pass
