"""At most so many records per contributor, by distributed suitor b-matching.

Every record lists one or more contributors (sources, authors, domains). In each round the records that are still open
propose to all their contributors. A contributor with room for b records holds its b best proposals, the others are
displaced for now. A record held by all its contributors is settled as kept; it uses room at each of them. A record
with a contributor that has no room left is settled as removed and withdraws elsewhere, which may let others in. Rounds
go on until no record is open. In every round the best open record of all is settled, so it ends, and the result is the
one of taking records in order of quality while all their contributors have room.

Which proposals a contributor holds is decided by an exact cutoff on (score, id) from histogram refinement, so a
contributor of any size costs no more than its bins; its records are never brought together. Open records become fewer
in every round, but a chain of records that each wait for the next settles one link a round. So once no more than
``TAIL_EDGES`` proposals are open the rest is settled in one step: in order of quality, on that bounded remainder alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.cutoff import kth_value
from corpusloom.operators.keys import join_table
from corpusloom.storage import broadcast_if_small, discard, materialize

#: Open proposals up to which the rest is settled by the driver, after the first round.
TAIL_EDGES = 50_000


def cap_contributors(records: DataFrame, caps: DataFrame, id_col: str, contributors: str, score: str) -> DataFrame:
    """``id_col`` and ``kept`` of every record.

    ``records`` has one row per ``id_col`` (bigint), an array ``contributors`` and a double ``score``, higher is
    better; records without a score come last, ties go to the smaller id. ``caps`` has ``contributor`` and ``cap``. A
    contributor without a cap (or with a null one) is never capped; nor is a record whose array is null, empty or holds
    only nulls. A contributor named twice by a record counts once. NaN counts as no score.
    """
    base = records.select(
        F.col(id_col).alias("id"), F.array_distinct(F.array_compact(F.coalesce(contributors, F.array().cast("array<string>")))).alias("c"),
        F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")).alias("score"),
    )
    base = materialize(base, "cap-records")
    room = materialize(caps.filter("cap is not null").groupBy("contributor").agg(F.min("cap").cast("bigint").alias("room")), "cap-room")
    capped = broadcast_if_small(room.select("contributor"))
    edges = base.select("id", F.explode("c").alias("contributor"), "score").join(capped, "contributor", "left_semi")
    edges = materialize(edges, "cap-raw")
    # Infinite scores and missing ones take places next to the finite range, so that bins stay finite.
    span = edges.filter("abs(score) < double('inf')").agg(F.coalesce(F.min("score"), F.lit(0.0)), F.coalesce(F.max("score"), F.lit(0.0))).first()
    step = max(1.0, abs(span[0]), abs(span[1]))
    value = (
        F.when(F.col("score").isNull(), span[0] - 2 * step).when(F.col("score") == float("-inf"), span[0] - step)
        .when(F.col("score") == float("inf"), span[1] + step).otherwise(F.col("score"))
    )
    open_ = edges.select("id", "contributor", value.alias("v"), (-F.col("id")).alias("order"))
    removed: list[DataFrame] = []
    n_open, rounds = open_.count(), 0
    while n_open and (not rounds or n_open > TAIL_EDGES):
        rounds += 1
        held = _held(open_, room)
        # Of each record: is it held everywhere? All of a record's edges are few, so this group is small.
        displaced = materialize(held.filter("not held").select("id").distinct(), "cap-displaced")
        used = open_.join(displaced, "id", "left_anti").groupBy("contributor").agg(F.count("*").alias("used"))
        before = room
        room = materialize(room.join(used, "contributor", "left").select("contributor", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")), "cap-room")
        waiting = open_.join(displaced, "id", "left_semi")
        full = broadcast_if_small(materialize(room.filter("room <= 0").select("contributor"), "cap-full"))
        gone = materialize(waiting.join(full, "contributor", "left_semi").select("id").distinct(), "cap-removed")
        removed.append(gone)
        last, open_ = open_, materialize(waiting.join(gone, "id", "left_anti"), "cap-edges")
        discard(last, before, displaced)
        n_open = open_.count()
    if n_open:
        removed.append(_settle(open_, room))
    out = base.select("id")
    if not removed:
        return out.select(F.col("id").alias(id_col), F.lit(True).alias("kept"))
    gone = removed[0]
    for more in removed[1:]:
        gone = gone.union(more)
    gone = gone.withColumn("gone", F.lit(True))
    return out.join(gone, "id", "left").select(F.col("id").alias(id_col), F.col("gone").isNull().alias("kept"))


def _settle(open_: DataFrame, room: DataFrame) -> DataFrame:
    """The ids removed of at most ``TAIL_EDGES`` open proposals: records in order of quality, kept while all their
    contributors have room."""
    left = {r.contributor: r.room for r in room.join(F.broadcast(open_.select("contributor").distinct()), "contributor", "left_semi").collect()}
    wanted = open_.groupBy("id").agg(F.collect_list("contributor").alias("c"), F.max("v").alias("v")).collect()
    gone = []
    for r in sorted(wanted, key=lambda r: (-r.v, r.id)):
        if all(left[c] > 0 for c in r.c):
            for c in r.c:
                left[c] -= 1
        else:
            gone.append((r.id,))
    return open_.sparkSession.createDataFrame(gone, f"id {open_.schema['id'].dataType.simpleString()}")


def _held(open_: DataFrame, room: DataFrame) -> DataFrame:
    """Each open proposal with ``held``: whether it is among the best that its contributor has room for."""
    demand = open_.groupBy("contributor").agg(F.count("*").alias("n")).join(room, "contributor")
    tight = materialize(demand.filter("n > room").select("contributor", F.col("room").alias("k")), "cap-tight")
    by_score = kth_value(open_, "contributor", "v", tight)
    # Within the cutoff's score the smaller ids are held: the rank there is what the better scores leave.
    ties = join_table(open_, by_score, ["contributor"]).filter("v = cutoff").select("contributor", "order")
    ties = materialize(ties, "cap-ties")
    left = by_score.join(tight, "contributor").select("contributor", (F.col("k") - F.col("above")).alias("k"))
    by_id = kth_value(ties, "contributor", "order", left).select("contributor", F.col("cutoff").alias("last"))
    discard(ties)
    limits = tight.join(by_score.select("contributor", "cutoff"), "contributor", "left").join(by_id, "contributor", "left")
    inside = F.col("k").isNull() | (
        (F.col("k") > 0) & ((F.col("v") > F.col("cutoff")) | ((F.col("v") == F.col("cutoff")) & (F.col("order") >= F.col("last"))))
    )
    return join_table(open_, limits, ["contributor"], "left").select("id", "contributor", inside.alias("held"))
