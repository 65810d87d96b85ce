"""Progress of sharded work from event traces and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups


def last_event(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest event of each key, whole; ties by the remaining columns. An aggregation, so hot keys combine early."""
    rest = [c for c in events.columns if c not in keys and c not in order]
    picked = events.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_e"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_e.{c}").alias(c) for c in events.columns])


def winners(events: DataFrame, keys: list[str], order: list[str], event: str = "event") -> DataFrame:
    """The last ``done`` event of each shard: whose output counts. Repeated events are idempotent."""
    return last_event(events.filter(F.col(event) == "done"), keys, order)


def merged_winners(trace: DataFrame, database: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Winners known to either; where both know a shard the trace counts."""
    t = trace.select(*keys, *[F.col(f).alias(f"t_{f}") for f in fields], F.lit(True).alias("_t"))
    d = database.select(*keys, *[F.col(f).alias(f"d_{f}") for f in fields])
    picked = [F.when(F.col("_t"), F.col(f"t_{f}")).otherwise(F.col(f"d_{f}")).alias(f) for f in fields]
    return t.join(d, keys, "full_outer").select(*keys, *picked)


def winning_rows(rows: DataFrame, won: DataFrame, keys: list[str], worker: str, run: str | None = None) -> DataFrame:
    """Part rows written by the worker that won their shard (and in its run, where the winner names one)."""
    named = won.select(*keys, F.col(worker).alias("_w"), *([F.col(run).alias("_r")] if run else []))
    same = F.col(worker) == F.col("_w")
    if run:
        same = same & (F.col("_r").isNull() | F.col(run).eqNullSafe(F.col("_r")))
    return rows.join(named, keys).filter(same).select(*rows.columns)


def complete_groups(assigned: DataFrame, done: DataFrame, group: list[str], item: list[str]) -> DataFrame:
    """Per group: assigned and done items, and whether all that is assigned is done."""
    flags = assigned.select(*group, *item).distinct().join(done.select(*group, *item).distinct().withColumn("_d", F.lit(1)), [*group, *item], "left")
    return flags.groupBy(*group).agg(F.count("*").alias("n_assigned"), F.count("_d").alias("n_done"), (F.count("*") == F.count("_d")).alias("complete"))


def without_open_work(jobs: DataFrame, direction: str, status: str = "status") -> DataFrame:
    """Directions of which no job is unfinished."""
    unfinished = jobs.filter(F.col(status) != "done").select(direction)
    return jobs.select(direction).distinct().join(unfinished, direction, "left_anti")


def progress(assigned: DataFrame, done: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Per group: assigned, done, remaining, and the percentage done to two places."""
    flags = assigned.select(*dict.fromkeys([*by, *keys])).distinct().join(done.select(*keys).distinct().withColumn("_d", F.lit(1)), keys, "left")
    out = flags.groupBy(*by).agg(F.count("*").alias("assigned"), F.count("_d").alias("done"))
    return out.withColumn("remaining", F.col("assigned") - F.col("done")).withColumn("completion_pct", F.round(100.0 * F.col("done") / F.col("assigned"), 2))


def stale(jobs: DataFrame, started: str, expected_seconds: str, now: Column, multiplier: float = 3.0) -> DataFrame:
    """Running jobs that have taken more than a multiple of their expected time, set back to pending."""
    age = F.unix_timestamp(now) - F.unix_timestamp(started)
    over = (F.col("status") == "running") & (age > multiplier * F.col(expected_seconds))
    return jobs.withColumn("reset", F.coalesce(over, F.lit(False))).withColumn("status", F.when(F.col("reset"), "pending").otherwise(F.col("status")))


def gpu_seconds(events: DataFrame, by: list[str]) -> DataFrame:
    """GPU seconds over all attempts: time times devices of every event that reports any."""
    return events.groupBy(*by).agg(F.sum(F.coalesce(F.col("gpu_seconds_delta") * F.col("gpu_count"), F.lit(0.0))).alias("gpu_seconds"))


def pending_manifest(jobs: DataFrame, directions: DataFrame, direction: str, shard: str, statuses: list[str]) -> DataFrame:
    """Jobs in one of the ``statuses`` with the languages of their direction and the range of rows ``start_idx`` up to
    ``end_idx`` that the shard covers; jobs of directions that nobody knows are left out."""
    open_ = jobs.filter(F.col("status").isin(*statuses)).select(direction, shard)
    start = F.col(shard) * F.col("shard_size")
    return open_.join(directions, direction).select(direction, shard, "src_lang", "tgt_lang", start.alias("start_idx"), (start + F.col("shard_size")).alias("end_idx"))


def probe(wanted: DataFrame, done: DataFrame, group: list[str], item: list[str]) -> DataFrame:
    """Per group: items requested, items done, requested ones that are missing, and done ones that nobody requested."""
    a, b = (df.select(*group, *item).distinct().withColumn(flag, F.lit(True)) for df, flag in ((wanted, "_w"), (done, "_d")))
    both = a.join(b, [*group, *item], "full_outer")
    return both.groupBy(*group).agg(
        F.count("_w").alias("n_requested"), F.count("_d").alias("n_done"), F.count_if(F.col("_w").isNotNull() & F.col("_d").isNull()).alias("n_missing"), F.count_if(F.col("_w").isNull()).alias("n_unrequested")
    )


def rate_windows(events: DataFrame, keys: list[str], time: str, seconds: int, block: int = 3600) -> DataFrame:
    """``events`` with ``n``: the events of the same key in the ``seconds`` whole seconds up to and with their own.

    Events are counted by second first. Windows run within blocks of time, each preceded by the end of the block before,
    so that a key that has most events is spread over its blocks."""
    second = F.unix_timestamp(time)
    counted = events.groupBy(*keys, second.alias("_s")).agg(F.count("*").alias("_c"))
    own = F.floor(F.col("_s") / block)
    both = F.when(F.pmod(F.col("_s"), F.lit(block)) > block - seconds, F.array(own, own + 1)).otherwise(F.array(own))
    spread = counted.withColumn("_own", own).withColumn("_b", F.explode(both))
    window = Window.partitionBy(*keys, "_b").orderBy("_s").rangeBetween(-(seconds - 1), 0)
    sums = spread.withColumn("n", F.sum("_c").over(window)).filter("_b = _own").select(*keys, "_s", "n")
    return join_groups(events.withColumn("_s", second), sums, [*keys, "_s"]).drop("_s")
