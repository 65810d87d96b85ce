"""Intermediate tables in the folder that all executors share.

``spark.checkpoint.dir`` names that folder. Where it is unset a temporary one is made, but only in local mode: on a
cluster a folder of one machine would lose data without a word, so it is refused. Iterative operators cut their lineage
by writing a Parquet table there: it is columnar and compressed, survives the loss of any executor, and its readers get
a plain scan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rows of a few numbers or short strings a table is broadcast; beyond, joins shuffle.
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="corpusloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def _place(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it. The files go with ``discard`` or when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, target = _place(spark, path)
    fs.deleteOnExit(target)
    table = spark.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/corpusloom/{label}-{uuid.uuid4().hex}"
    fs, target = _place(spark, path)
    fs.deleteOnExit(target)
    return path


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialised tables that nothing reads any more; other tables are left alone."""
    for table in tables:
        if path := getattr(table, "_folder", None):
            fs, target = _place(table.sparkSession, path)
            fs.delete(target, True)


def broadcast_if_small(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast if it has at most ``most`` rows. It is counted, so it should be materialised."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table
