"""Plans over small tables: allocation of tokens, packing of work and its division among slots."""

from __future__ import annotations

import heapq
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import row_numbers

#: Names that one plan may pack; a plan has one row a source, not one a record.
PLAN_NAMES = 1_000_000


def water_fill(quota: int, caps: list[int]) -> list[int]:
    """The quota split as evenly as the caps allow, in whole units. Caps below the water level are met; what an even
    split of the rest leaves over goes to the largest caps, a unit each."""
    ranked = sorted((cap, i) for i, cap in enumerate(caps))
    poured = [0, *accumulate(cap for cap, _ in ranked)]
    full = sum(poured[k] + cap * (len(caps) - k) <= quota for k, (cap, _) in enumerate(ranked))
    share = {i: cap for cap, i in ranked[:full]}
    if open_ := [i for _, i in ranked[full:]]:
        level, over = divmod(max(quota - poured[full], 0), len(open_))
        share |= {i: level + (k >= len(open_) - over) for k, i in enumerate(open_)}
    return [share[i] for i in range(len(caps))]


def largest_remainder(total: int, weights: list[int]) -> list[int]:
    """Whole units in proportion to the weights that sum to the total, in exact arithmetic; zeros if there is nothing
    to divide, or nothing to divide by. Of equal remainders the earlier is rounded up."""
    if total <= 0 or sum(weights) <= 0:
        return [0 for _ in weights]
    parts = [divmod(total * w, sum(weights)) for w in weights]
    missing = total - sum(units for units, _ in parts)
    raised = set(heapq.nsmallest(missing, range(len(parts)), key=lambda i: (-parts[i][1], i)))
    return [units + (i in raised) for i, (units, _) in enumerate(parts)]


def allocate(quota: int, caps: list[int]) -> list[int]:
    """Even within the caps; what a quota has beyond all of them repeats the sources in proportion to their caps."""
    beyond = largest_remainder(quota - sum(caps), caps)
    return [a + b for a, b in zip(water_fill(min(quota, sum(caps)), caps), beyond)]


def english_side(source_pair: str | None) -> bool | None:
    """Whether English is the source of a pair; None if it is on neither side or the name is no pair."""
    sides = (source_pair or "").split("-")
    if len(sides) != 2 or "eng_Latn" not in sides:
        return None
    return sides[0] == "eng_Latn"


def extraction_plan(sources: DataFrame, quotas: DataFrame) -> DataFrame:
    """Token and row allocations of each usable source of a dataset's target, and warnings on the others.

    ``sources``: ``dataset, target_pair, source_pair, n_lines, total_tokens``; ``quotas``: ``dataset, target_pair, quota``. Output one
    row a source, ``alloc_tokens`` and ``rows_to_sample`` null where ``warning`` says why.
    """

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("source_pair", kind="stable").reset_index(drop=True)
        side = [english_side(s) for s in frame["source_pair"]]
        warn = [None if e is not None else "no eng side" for e in side]
        for i, (n, t) in enumerate(zip(frame["n_lines"], frame["total_tokens"])):
            if warn[i] is None and not (n > 0 and t > 0):
                warn[i] = "empty stats"
        good = [i for i, w in enumerate(warn) if w is None]
        shares = allocate(int(frame["quota"].iloc[0]), [int(frame["total_tokens"][i]) for i in good])
        alloc, rows = [None] * len(frame), [None] * len(frame)
        for i, a in zip(good, shares):
            alloc[i], rows[i] = a, round(a / (frame["total_tokens"][i] / frame["n_lines"][i]))
        out = frame[["dataset", "target_pair", "source_pair"]].copy()
        out["alloc_tokens"], out["rows_to_sample"] = pd.array(alloc, "Int64"), pd.array(rows, "Int64")
        out["eng_is_source"], out["warning"] = pd.array(side, "boolean"), warn
        return out

    joined = sources.join(quotas.select("dataset", "target_pair", "quota"), ["dataset", "target_pair"]).filter("quota is not null")
    return joined.groupBy("dataset", "target_pair").applyInPandas(plan, "dataset string, target_pair string, source_pair string, alloc_tokens bigint, rows_to_sample bigint, eng_is_source boolean, warning string")


def pack_bins(sizes: dict[str, int], bins: int) -> list[list[str]]:
    """Largest first into the lightest bin; ties by name and bin number."""
    heap = [(0, b) for b in range(bins)]
    out: list[list[str]] = [[] for _ in range(bins)]
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, b = heapq.heappop(heap)
        out[b].append(name)
        heapq.heappush(heap, (load + size, b))
    return out


def assign_shards(shards: list[tuple[str, int]], quota: int, slots: int) -> list[tuple[int, int]]:
    """Slot and place in it of each (direction, shard), in order. A direction's shards stay together: a slot takes
    shards until its quota is full, then the next begins. Shards beyond all quotas go round the slots."""
    fill, out, slot = [0] * slots, [], 0
    for k in range(len(shards)):
        while slot < slots and fill[slot] >= quota:
            slot += 1
        at = slot if slot < slots else k % slots
        out.append((at, fill[at]))
        fill[at] += 1
    return out


def pack_groups(sizes: DataFrame, name: str, size: str, bins: int) -> DataFrame:
    """``chunk, name, size``: every name in one of ``bins`` chunks, largest first into the lightest. A null name is a
    name of its own and comes last among equals; repeated names are added up first. A plan of more than ``PLAN_NAMES``
    names is refused."""
    spark, kind = sizes.sparkSession, sizes.schema[name].dataType.simpleString()
    rows = sizes.groupBy(name).agg(F.sum(size).cast("bigint").alias("n")).limit(PLAN_NAMES + 1).collect()
    if len(rows) > PLAN_NAMES:
        raise ValueError(f"more than {PLAN_NAMES} names in a plan")
    loads = [(0, b) for b in range(bins)]
    out = []
    for r in sorted(rows, key=lambda r: (-r.n, r[0] is None, r[0])):
        load, b = loads[0]
        heapq.heapreplace(loads, (load + r.n, b))
        out.append((b, r[0], r.n))
    return spark.createDataFrame(out, f"chunk int, {name} {kind}, {size} bigint")


def assign_slots(shards: DataFrame, direction: str, shard: str, quota: int, slots: int, sparse_floor: float = 1.0) -> DataFrame:
    """``shards`` with ``slot`` and ``seq``, the place in it, both from 0.

    Directions with most shards come first, and a direction's shards stay together: they fill a slot up to ``quota`` and
    go on in the next one; shards beyond all quotas go round the slots. With fewer than ``sparse_floor`` shards a slot
    every direction begins a slot of its own. Slots follow from running numbers, so a plan of any size is computed
    where its rows are."""
    per = shards.groupBy(direction).agg(F.count("*").alias("_n"))
    sized = join_groups(shards, per, [direction])
    within = row_numbers(sized, [direction], [F.col(shard)], "_i").withColumn("_i", F.col("_i") - 1)
    if shards.count() < sparse_floor * slots:
        order = [F.desc("_n"), F.col(direction)]
        starts = row_numbers(per.withColumn("_one", F.lit(0)), [], order, "_at")
        need = F.ceil(F.col("_n") / quota)
        starts = starts.select(direction, (F.sum(need).over(_ordered("_at")) - need).alias("_start"))  # one row a direction
        placed = join_groups(within, starts, [direction]).withColumn("slot", F.pmod(F.col("_start") + F.floor(F.col("_i") / quota), F.lit(slots)))
        return placed.withColumn("seq", F.col("_i") % quota).select(*shards.columns, F.col("slot").cast("int"), F.col("seq").cast("int"))
    numbered = row_numbers(within, [], [F.desc("_n"), F.col(direction), F.col(shard)], "_k").withColumn("_k", F.col("_k") - 1)
    fits = F.col("_k") < quota * slots
    slot = F.when(fits, F.floor(F.col("_k") / quota)).otherwise(F.col("_k") % slots)
    seq = F.when(fits, F.col("_k") % quota).otherwise(quota + F.floor((F.col("_k") - quota * slots) / slots))
    return numbered.select(*shards.columns, slot.cast("int").alias("slot"), seq.cast("int").alias("seq"))


def _ordered(column: str):
    return Window.orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def quota_shards(seconds_per_shard: float, walltime: float, safety: float = 0.9) -> int:
    """Shards that fit a job's wall time; at least one."""
    return max(1, int(walltime * safety / seconds_per_shard))


def estimated_hours(sentences: int, per_hour: float | None) -> float | None:
    return sentences / per_hour if per_hour else None
