"""Removal and statistics of duplicates, and set operations on keys.

Groups of copies are reduced by aggregation, which combines on the map side, never by a window: a text that makes up a
third of the corpus costs no more than its partial results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import row_numbers, running_sum
from corpusloom.storage import materialize


def keep_one(rows: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One whole row per ``keys``: the first (or last) by ``order``, then by all other columns; null keys are equal."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    pick = (F.max if last else F.min)(F.struct(*order, *rest)).alias("_row")
    kept = rows.groupBy(*keys).agg(pick)
    return kept.select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in rows.columns])


def _as_long(rows: DataFrame, column: str) -> Column | None:
    """A column as a number in its order, null as the lowest; None for types that aren't whole numbers."""
    kind = rows.schema[column].dataType.simpleString()
    number = {"timestamp": F.unix_micros, "date": F.unix_date}.get(kind, lambda c: c)(F.col(column))
    return F.coalesce(number.cast("bigint"), F.lit(-(2**63))) if kind in ("timestamp", "date", "bigint", "int", "smallint", "tinyint") else None


def exact_dedup(rows: DataFrame, source: str, target: str, order: list[str]) -> DataFrame:
    """One row per pair of texts, rows with a null text removed; of copies the first by ``order``, then by all other
    columns, stays whole. Copies are dropped where they are read, and each text is shuffled once."""
    return keep_one(rows.filter(F.col(source).isNotNull() & F.col(target).isNotNull()), [source, target], order)


def dedup_by_hash(rows: DataFrame, source: str, target: str, order: list[str]) -> DataFrame:
    """``exact_dedup`` without sorting texts, for texts so long that this matters; it reads ``rows`` twice, and for
    sentences takes twice the time.

    Texts are reduced to 128 bits of hash, and the first time of each is found by a hash aggregation of three numbers.
    Rows are then shuffled once, by hash and time, so that the copies of a text that makes up a third of the corpus
    spread over its times and leave no trace but their first; what is left of equal times is settled in place. Texts
    that share a hash (a third one tells) are compared as such. Where ``order`` doesn't begin with a time or a whole
    number, texts are grouped as they are."""
    whole = rows.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
    time = _as_long(rows, order[0])
    if time is None:
        return keep_one(whole, [source, target], order)
    h = lambda seed: F.xxhash64(F.lit(seed), source, target)
    # Names longer than any column's can't clash with one.
    h1, h2, o, mixed, place = (x + "_" * max(map(len, rows.columns)) for x in ("h1", "h2", "o", "mixed", "place"))
    hashed = whole.withColumns({h1: h(1), h2: h(2), o: time})
    heads = hashed.groupBy(h1, h2).agg(F.min(o).alias(o), (F.min(h(3)) != F.max(h(3))).alias(mixed))
    heads = materialize(heads, "heads")
    near = hashed.join(heads.filter(~F.col(mixed)).drop(mixed), [h1, h2, o])
    rest = [c for c in rows.columns if c not in (source, target, *order)]
    first = F.row_number().over(Window.partitionBy(h1, h2, o).orderBy(*order, *rest))
    kept = near.withColumn(place, first).filter(F.col(place) == 1).select(*rows.columns)
    shared = heads.filter(F.col(mixed)).select(h1, h2)
    if shared.isEmpty():
        return kept
    return kept.unionByName(keep_one(hashed.join(shared, [h1, h2], "left_semi").select(*rows.columns), [source, target], order))


def dedup_counts(rows: DataFrame, by: list[str], source: str, target: str) -> DataFrame:
    """Per group: rows, rows with a null text, distinct text pairs within the group, and rows removed in all."""
    whole = F.col(source).isNotNull() & F.col(target).isNotNull()
    copies = rows.groupBy(*by, source, target).agg(F.count("*").alias("n"))
    return copies.groupBy(*by).agg(
        F.sum("n").alias("input_rows"),
        F.sum(F.when(~whole, F.col("n")).otherwise(0)).alias("null_rows"),
        F.count_if(whole).alias("kept_rows"),
        (F.sum("n") - F.count_if(whole)).alias("removed_rows"),
    )


def duplicate_stats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, groups of copies, rows in them, rows beyond the first, the largest group."""
    copies = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    many = F.col("n") > 1
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_unique"), F.count_if(many).alias("n_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("involved_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"), F.coalesce(F.max("n"), F.lit(0)).alias("max_copies"),
    )


def copies_distribution(rows: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys have how many copies."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).groupBy("copies").agg(F.count("*").alias("n_keys"))


def first_blocks(rows: DataFrame, sequence: list[str], order: list[str], key: str) -> DataFrame:
    """Rows of each key's first contiguous block in every ordered sequence, with ``block_no`` from 1.

    A sequence is what one writer appended (a file, a user, a worker); ``order`` must be total in it. Row numbers, the
    look at the row before and the numbers of blocks are all computed over slices, so that a sequence may be of any
    length. Null keys are a key.
    """
    numbered = materialize(row_numbers(rows, sequence, [F.col(c) for c in order], "_n"), "blocks")
    before = numbered.select(*sequence, (F.col("_n") + 1).alias("_n"), F.col(key).alias("_k"))
    changed = F.when((F.col("_n") > 1) & F.col(key).eqNullSafe(F.col("_k")), 0).otherwise(1)
    marked = join_groups(numbered, before, [*sequence, "_n"], "left").withColumn("_new", changed).drop("_k")
    blocks = materialize(running_sum(marked, sequence, [F.col("_n")], F.col("_new").cast("bigint"), "block_no").drop("_new", "_n"), "blocks")
    first = blocks.groupBy(*sequence, key).agg(F.min("block_no").alias("_first"))
    return join_groups(blocks, first, [*sequence, key]).filter("block_no = _first").drop("_first")


def both_directions(pairs: DataFrame, source_lang: str, target_lang: str, swaps: dict[str, str], pair: tuple[str, str]) -> DataFrame:
    """Rows of a language pair in either direction, those of the reverse one turned by exchanging the columns in ``swaps``."""
    a, b = pair
    forward = pairs.filter((F.col(source_lang) == a) & (F.col(target_lang) == b))
    back = pairs.filter((F.col(source_lang) == b) & (F.col(target_lang) == a))
    other = swaps | {v: k for k, v in swaps.items()} | {source_lang: target_lang, target_lang: source_lang}
    return forward.unionByName(back.select(*[F.col(other.get(c, c)).alias(c) for c in pairs.columns]))


def union_corpora(first: DataFrame, *others: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Union by name, missing columns null; columns are renamed first, and a rename onto an existing column is refused."""
    out = []
    for df in (first, *others):
        todo = {a: b for a, b in (rename or {}).items() if a in df.columns}
        if clash := [b for b in todo.values() if b in df.columns]:
            raise ValueError(f"already there: {clash}")
        out.append(df.withColumnsRenamed(todo))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def missing_keys(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(found.select(*keys), keys, "left_anti")


def common_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_semi")


def not_in_final(rows: DataFrame, final: DataFrame, source: str, target: str) -> DataFrame:
    """Rows whose pair of texts is in ``final`` in neither orientation; exact, with no false positives."""
    known = final.select(F.col(source).alias("_a"), F.col(target).alias("_b"))
    known = known.union(known.select("_b", "_a")).distinct()
    return rows.join(known, F.col(source).eqNullSafe(F.col("_a")) & F.col(target).eqNullSafe(F.col("_b")), "left_anti")


def conflicting(rows: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Keys that occur more than once: ``identical`` if their values agree, else ``conflict``."""
    seen = rows.groupBy(*key).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*values)).alias("kinds"))
    return seen.filter("n > 1").select(*key, "n", F.when(F.col("kinds") == 1, "identical").otherwise("conflict").alias("status"))
