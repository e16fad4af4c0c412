"""Sessions and the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from .config import DEFAULTS, load


def get_session(config: dict | None = None) -> SparkSession:
    """The active session if there is one; else a new one. A master that spark-submit set is kept."""
    if (active := SparkSession.getActiveSession()) is not None:
        return active
    config = config or load()
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(config["app_name"])
    if not SparkConf().contains("spark.master"):
        builder = builder.master(config["master"])
    for key, value in (DEFAULTS["spark"] | config["spark"]).items():
        builder = builder.config(key, value)
    return builder.enableHiveSupport().getOrCreate() if config.get("hive") else builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where the session has none and runs on one machine."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_ledgerflow_tables", None)
    if not where:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir isn't set: driver and executors share no folder")
        where = sc._ledgerflow_tables = "file://" + tempfile.mkdtemp(prefix="ledgerflow-")
    return where.rstrip("/")
