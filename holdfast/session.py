"""A session with the settings that the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "holdfast", master: str | None = None, shuffle_partitions: int | None = None, hive: bool = False, **conf: str) -> SparkSession:
    """ANSI and adaptive execution on, skewed joins split, Arrow for pandas functions, UTC."""
    builder = SparkSession.builder.appName(name).config(
        map={
            "spark.sql.ansi.enabled": "true",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.sql.session.timeZone": "UTC",
        }
        | conf
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (builder.enableHiveSupport() if hive else builder).getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if they can see that folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [x for x in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
