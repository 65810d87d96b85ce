"""Queries on progress, completeness and queues. Events stand in for the trace of a work queue: a purchase is a
completion, an error a failure, a click a claim; a direction is a group of users and a shard a group of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import budget
from corpusloom.operators import tracking as tr
from corpusloom.operators.dedup import missing_keys
from corpusloom.plans.registry import query
from corpusloom.plans.views import SCORES, scores
from corpusloom.session import table
from corpusloom.streaming.ingest import completions_per_window, first_completions

_EVENTS = """trace AS (SELECT event_id, ts, 'd' || (user_id % 8) AS direction_key, (event_id % 50) AS shard_id, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'claim' END AS event,
'w' || (event_id % 3) AS worker_id, CASE WHEN event_id % 4 > 0 THEN value END AS gpu_seconds_delta, 1 + event_id % 4 AS gpu_count FROM events WHERE event_type IN ('purchase', 'error', 'click'))"""


def trace(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").filter(F.col("event_type").isin("purchase", "error", "click"))
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("claim")
    return e.select(
        "event_id", "ts", F.concat(F.lit("d"), F.col("user_id") % 8).alias("direction_key"), (F.col("event_id") % 50).alias("shard_id"), kind.alias("event"), F.concat(F.lit("w"), F.col("event_id") % 3).alias("worker_id"),
        F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("gpu_seconds_delta"), (1 + F.col("event_id") % 4).alias("gpu_count"),
    )


KEYS = ["direction_key", "shard_id"]
_STATE = f"{_EVENTS}, state AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY direction_key, shard_id ORDER BY ts DESC, event_id DESC) AS k FROM trace) WHERE k = 1)"
_WON = f"{_EVENTS}, won AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY direction_key, shard_id ORDER BY ts DESC, event_id DESC) AS k FROM trace WHERE event = 'done') WHERE k = 1)"


@query(f"WITH {_STATE} SELECT direction_key, shard_id, event, worker_id, event_id FROM state")
def shard_states(spark: SparkSession, d: str) -> DataFrame:
    return tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"]).select(*KEYS, "event", "worker_id", "event_id")


@query(f"WITH {_STATE} SELECT event, count(*) AS n FROM state GROUP BY 1")
def queue_counts(spark: SparkSession, d: str) -> DataFrame:
    return tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"]).groupBy("event").agg(F.count("*").alias("n"))


@query(f"WITH {_EVENTS} SELECT direction_key, coalesce(sum(gpu_seconds_delta * gpu_count), 0) AS gpu_seconds FROM trace GROUP BY 1")
def gpu_seconds(spark: SparkSession, d: str) -> DataFrame:
    return tr.gpu_seconds(trace(spark, d), ["direction_key"])


@query(f"WITH {_WON} SELECT direction_key, shard_id, worker_id FROM won")
def shard_winners(spark: SparkSession, d: str) -> DataFrame:
    return tr.winners(trace(spark, d), KEYS, ["ts", "event_id"]).select(*KEYS, "worker_id")


@query(f"""WITH {_WON}, db AS (SELECT direction_key, shard_id, 'db' AS worker_id FROM (SELECT DISTINCT direction_key, shard_id FROM trace) WHERE shard_id % 2 = 0)
SELECT coalesce(w.direction_key, d.direction_key) AS direction_key, coalesce(w.shard_id, d.shard_id) AS shard_id, CASE WHEN w.direction_key IS NOT NULL THEN w.worker_id ELSE d.worker_id END AS worker_id
FROM won w FULL JOIN db d ON w.direction_key = d.direction_key AND w.shard_id = d.shard_id""")
def merged_winners(spark: SparkSession, d: str) -> DataFrame:
    t = trace(spark, d)
    db = t.select(*KEYS).distinct().filter("shard_id % 2 = 0").withColumn("worker_id", F.lit("db"))
    return tr.merged_winners(tr.winners(t, KEYS, ["ts", "event_id"]), db, KEYS, ["worker_id"])


@query(f"WITH {_WON} SELECT t.event_id FROM trace t JOIN won w ON w.direction_key = t.direction_key AND w.shard_id = t.shard_id AND w.worker_id = t.worker_id")
def winning_rows(spark: SparkSession, d: str) -> DataFrame:
    t = trace(spark, d)
    return tr.winning_rows(t, tr.winners(t, KEYS, ["ts", "event_id"]), KEYS, "worker_id").select("event_id")


@query(f"""WITH {_WON}, assigned AS (SELECT DISTINCT direction_key, shard_id FROM trace)
SELECT a.direction_key, count(*) AS n_assigned, count(w.shard_id) AS n_done, count(*) = count(w.shard_id) AS complete FROM assigned a LEFT JOIN won w ON w.direction_key = a.direction_key AND w.shard_id = a.shard_id GROUP BY 1""")
def complete_directions(spark: SparkSession, d: str) -> DataFrame:
    t = trace(spark, d)
    return tr.complete_groups(t, t.filter("event = 'done'"), ["direction_key"], ["shard_id"])


@query(f"WITH {_STATE} SELECT DISTINCT direction_key FROM state s WHERE NOT EXISTS (SELECT 1 FROM state o WHERE o.direction_key = s.direction_key AND o.event = 'failed' AND o.shard_id % 25 = 0)")
def directions_without_open_work(spark: SparkSession, d: str) -> DataFrame:
    """A failure of every 25th shard is open work."""
    state = tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"])
    jobs = state.withColumn("status", F.when((F.col("event") != "failed") | (F.col("shard_id") % 25 != 0), "done").otherwise("open"))
    return tr.without_open_work(jobs, "direction_key")


@query(f"""WITH {_WON}, assigned AS (SELECT DISTINCT worker_id, direction_key, shard_id FROM trace)
SELECT a.worker_id, count(*) AS assigned, count(w.shard_id) AS done, count(*) - count(w.shard_id) AS remaining, round(100.0::DOUBLE * count(w.shard_id) / count(*), 2) AS completion_pct
FROM assigned a LEFT JOIN won w ON w.direction_key = a.direction_key AND w.shard_id = a.shard_id GROUP BY 1""")
def progress_summary(spark: SparkSession, d: str) -> DataFrame:
    t = trace(spark, d)
    return tr.progress(t, t.filter("event = 'done'"), ["worker_id"], KEYS)


@query(f"WITH {_EVENTS} SELECT direction_key, shard_id FROM (SELECT 'd' || a AS direction_key, s AS shard_id FROM range(8) x(a), range(50) y(s)) EXCEPT SELECT direction_key, shard_id FROM trace WHERE event = 'done'")
def missing_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of a manifest that nothing completed."""
    manifest = spark.range(8 * 50).select(F.concat(F.lit("d"), F.floor(F.col("id") / 50)).alias("direction_key"), (F.col("id") % 50).alias("shard_id"))
    return missing_keys(manifest, trace(spark, d).filter("event = 'done'"), KEYS)


@query(f"""WITH {_STATE} SELECT direction_key, shard_id, CASE WHEN event = 'claim' AND date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') > 3 * 3600 THEN 'pending' WHEN event = 'claim' THEN 'running' ELSE event END AS status,
event = 'claim' AND date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') > 3 * 3600 AS reset FROM state""")
def stale_claims(spark: SparkSession, d: str) -> DataFrame:
    state = tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"]).withColumn("status", F.when(F.col("event") == "claim", "running").otherwise(F.col("event")))
    return tr.stale(state.withColumn("expected", F.lit(3600.0)), "ts", "expected", F.lit("2024-02-01 00:00:00").cast("timestamp")).select(*KEYS, "status", "reset")


@query(f"WITH {_EVENTS} SELECT direction_key, shard_id, min(ts) AS ts FROM trace WHERE event = 'done' GROUP BY 1, 2")
def first_completions_query(spark: SparkSession, d: str) -> DataFrame:
    return first_completions(trace(spark, d), KEYS, "ts")


@query(f"WITH {_EVENTS} SELECT direction_key, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM trace WHERE event = 'done' GROUP BY 1, 2")
def completions_per_hour(spark: SparkSession, d: str) -> DataFrame:
    return completions_per_window(trace(spark, d), ["direction_key"], "ts")


@query(f"""WITH {SCORES} SELECT pair_id, direction_key, qe_model FROM scores s WHERE NOT EXISTS (SELECT 1 FROM bitext b WHERE b.pair_id = s.pair_id)""")
def orphan_scores(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "bitext").select("pair_id")
    return scores(spark, d).join(known, "pair_id", "left_anti").select("pair_id", "direction_key", "qe_model")


#: Corpora that differ only in case, white space, hyphens, underscores or full stops are one.
_CORPUS = r"nullif(lower(regexp_replace(corpus, '[\s\-_.]+', '', 'g')), '')"


@query(f"""WITH RECURSIVE sizes AS (SELECT {_CORPUS} AS corpus, count(*) AS n_rows FROM bitext GROUP BY 1), ordered AS (SELECT *, row_number() OVER (ORDER BY n_rows DESC, corpus IS NULL, corpus) AS k FROM sizes),
packed AS (SELECT 0::BIGINT AS k, [0, 0, 0, 0]::BIGINT[] AS loads, 0::BIGINT AS place UNION ALL
SELECT p.k + 1, list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN n_rows ELSE 0 END), list_position(loads, list_min(loads)) FROM packed p JOIN ordered o ON o.k = p.k + 1)
SELECT (place - 1)::INT AS chunk, corpus, n_rows FROM packed JOIN ordered USING (k)""")
def balanced_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Corpora packed into four chunks by size, largest first."""
    corpus = F.lower(F.regexp_replace("corpus", r"(?U)[\s\-_.]+", ""))
    rows = table(spark, d, "bitext").select(F.when(corpus != "", corpus).alias("corpus"), F.lit(1).alias("n_rows"))
    return budget.pack_groups(rows, "corpus", "n_rows", 4)


_SLOTS, _QUOTA = 12, 7


@query(f"""WITH {_STATE}, numbered AS (SELECT direction_key, shard_id, row_number() OVER (ORDER BY n DESC, direction_key, shard_id) - 1 AS k FROM (SELECT *, count(*) OVER (PARTITION BY direction_key) AS n FROM state))
SELECT direction_key, shard_id, CASE WHEN k < {_QUOTA * _SLOTS} THEN k // {_QUOTA} ELSE k % {_SLOTS} END::INT AS slot, CASE WHEN k < {_QUOTA * _SLOTS} THEN k % {_QUOTA} ELSE {_QUOTA} + (k - {_QUOTA * _SLOTS}) // {_SLOTS} END::INT AS seq FROM numbered""")
def assigned_slots(spark: SparkSession, d: str) -> DataFrame:
    """All shards dealt to twelve slots of seven, what is left over round the slots."""
    return budget.assign_slots(tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"]).select(*KEYS), *KEYS, _QUOTA, _SLOTS)


_DIRECTIONS = "directions AS (SELECT 'd' || i AS direction_key, 's' || i AS src_lang, 't' || i AS tgt_lang, 1000 + 10 * i AS shard_size FROM range(1, 8) x(i))"


def _directions(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(1, 8).select(F.concat(F.lit("d"), i).alias("direction_key"), F.concat(F.lit("s"), i).alias("src_lang"), F.concat(F.lit("t"), i).alias("tgt_lang"), (1000 + 10 * i).alias("shard_size"))


@query(f"WITH {_STATE}, {_DIRECTIONS} SELECT s.direction_key, s.shard_id, d.src_lang, d.tgt_lang, s.shard_id * d.shard_size AS start_idx, (s.shard_id + 1) * d.shard_size AS end_idx FROM state s JOIN directions d USING (direction_key) WHERE s.event IN ('failed', 'claim')")
def pending_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Unfinished shards with what their directions know, and the rows each covers."""
    state = tr.last_event(trace(spark, d), KEYS, ["ts", "event_id"])
    return tr.pending_manifest(state.withColumnRenamed("event", "status"), _directions(spark), "direction_key", "shard_id", ["failed", "claim"])


@query(f"""WITH {_WON}, wanted AS (SELECT 'd' || a AS direction_key, s AS shard_id FROM range(8) x(a), range(5, 60) y(s))
SELECT coalesce(q.direction_key, w.direction_key) AS direction_key, count(q.shard_id) AS n_requested, count(w.shard_id) AS n_done, count(*) FILTER (q.shard_id IS NOT NULL AND w.shard_id IS NULL) AS n_missing, count(*) FILTER (q.shard_id IS NULL) AS n_unrequested
FROM wanted q FULL JOIN won w ON w.direction_key = q.direction_key AND w.shard_id = q.shard_id GROUP BY 1""")
def manifest_probe(spark: SparkSession, d: str) -> DataFrame:
    """A manifest against what the trace says is done, both ways."""
    wanted = spark.range(8 * 55).select(F.concat(F.lit("d"), F.floor(F.col("id") / 55)).alias("direction_key"), (F.col("id") % 55 + 5).alias("shard_id"))
    return tr.probe(wanted, trace(spark, d).filter("event = 'done'"), ["direction_key"], ["shard_id"])


@query(f"""WITH {_EVENTS} SELECT worker_id, event_id, count(*) OVER (PARTITION BY worker_id ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS n FROM trace""")
def rate_windows(spark: SparkSession, d: str) -> DataFrame:
    """Calls of each worker within a minute up to each call."""
    return tr.rate_windows(trace(spark, d), ["worker_id"], "ts", 60).select("worker_id", "event_id", "n")


@query(f"WITH {_WON} SELECT event_id FROM trace t WHERE EXISTS (SELECT 1 FROM won w WHERE w.direction_key = t.direction_key AND w.shard_id = t.shard_id)")
def committed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of shards that a checkpoint has."""
    t = trace(spark, d)
    return t.join(t.filter("event = 'done'").select(*KEYS), KEYS, "left_semi").select("event_id")


@query(f"WITH {_WON} SELECT event_id FROM trace t WHERE NOT EXISTS (SELECT 1 FROM won w WHERE w.direction_key = t.direction_key AND w.shard_id = t.shard_id)")
def uncommitted_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that compaction may still append."""
    t = trace(spark, d)
    return t.join(t.filter("event = 'done'").select(*KEYS), KEYS, "left_anti").select("event_id")


@query("SELECT DISTINCT src_lang, tgt_lang, CASE WHEN split_part(src_lang, '_', 1) = 'eng' OR split_part(tgt_lang, '_', 1) = 'eng' THEN CASE WHEN src_lang = 'eng_Latn' AND split_part(tgt_lang, '_', 1) IN ('deu', 'fra', 'spa') THEN 'full-' || split_part(tgt_lang, '_', 1) ELSE 'full-en-xx' END ELSE 'none' END AS checker FROM bitext")
def pair_checkers(spark: SparkSession, d: str) -> DataFrame:
    """Which pair classifier scores a direction: its own, the one for English and anything, or none."""
    from corpusloom.functions.values import pair_checker

    return table(spark, d, "bitext").select("src_lang", "tgt_lang").distinct().select("*", pair_checker(F.col("src_lang"), F.col("tgt_lang"), ["deu", "fra", "spa"]).alias("checker"))
