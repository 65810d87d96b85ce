"""The stream-shaped parts of curation: incremental processing of new files, and completion traces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def process_new_files(spark: SparkSession, source: str, target: str, name: str, transform: Callable[[DataFrame], DataFrame],
                      schema: StructType, by: list[str] = (), files_per_batch: int = 1000, checkpoint: str | None = None) -> StreamingQuery:
    """Run ``transform`` over the Parquet files that earlier calls under ``name`` haven't seen, append, and stop.

    ``checkpoint``, by default a hidden folder in ``target``, remembers what is done, so a failed call is repeated and a
    finished one is not, whichever session makes it. It must outlive the session as the target does.
    ``transform`` must be row-local or carry its own watermark.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = transform(stream).writeStream.format("parquet").outputMode("append").option("path", target)
    writer = writer.option("checkpointLocation", f"{checkpoint or target.rstrip('/') + '/_streams'}/{name}").trigger(availableNow=True)
    return (writer.partitionBy(*by) if by else writer).start()


def first_completions(events: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Completion events without the repeats that arrive within ``late``; usable on a stream or a table."""
    done = events.filter(F.col("event") == "done")
    if not events.isStreaming:
        return done.groupBy(*keys).agg(F.min(time).alias(time))
    return done.withWatermark(time, late).dropDuplicatesWithinWatermark(keys).select(*keys, time)


def completions_per_window(events: DataFrame, by: list[str], time: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Completions per group and tumbling window; on a stream, windows close ``late`` behind the newest event."""
    done = events.filter(F.col("event") == "done")
    if events.isStreaming:
        done = done.withWatermark(time, late)
    counted = done.groupBy(*by, F.window(time, window).alias("w")).agg(F.count("*").alias("n"))
    return counted.select(*by, F.col("w.start").alias("window_start"), "n")


def merge_completions(spark: SparkSession, source: DataFrame, state: str, keys: list[str], order: list[str], name: str, checkpoint: str | None = None) -> StreamingQuery:
    """Keep in ``state`` the last completion of every key, by merging each micro-batch into a new version; the stream's
    ``checkpoint`` is by default a hidden folder in ``state``.

    Versions are numbered by batch, so a repeated batch writes the same one again; ``current_completions`` reads the last.
    """
    from corpusloom.operators.tracking import last_event

    def merge(batch: DataFrame, number: int) -> None:
        before = _version(spark, state, number - 1)
        known = batch if before is None else before.unionByName(batch)
        last_event(known, keys, order).write.mode("overwrite").parquet(f"{state}/v{number:09d}")

    writer = source.filter(F.col("event") == "done").writeStream.foreachBatch(merge).trigger(availableNow=True)
    return writer.option("checkpointLocation", f"{checkpoint or state.rstrip('/') + '/_streams'}/{name}").start()


def _version(spark: SparkSession, state: str, most: int | None = None) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(state)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = [int(n[1:]) for n in names if n.startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS"))]
    numbers = [n for n in numbers if most is None or n <= most]
    return spark.read.parquet(f"{state}/v{max(numbers):09d}") if numbers else None


def current_completions(spark: SparkSession, state: str) -> DataFrame | None:
    return _version(spark, state)
