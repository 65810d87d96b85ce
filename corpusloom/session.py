"""Session defaults for local use, and access to the input tables.

Library code never changes the settings of a session it is handed; ``local_session`` is for tests, the bench and
interactive use only.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def _find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever their working folder.

    On machines without that folder the package comes with ``--py-files`` or is installed."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), ROOT]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    A table larger than a few splits is returned as it is; only a scan that would leave cores idle under an expensive
    Python stage is redistributed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
