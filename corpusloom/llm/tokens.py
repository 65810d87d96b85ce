"""Token counts, ids and budgets of text columns."""

from __future__ import annotations

from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bytebpe import BYTE_BPE_50K, byte_bpe, ship
from corpusloom.llm.languages import language_of, source_key
from corpusloom.llm.unigram import UnigramVocabulary


def token_count(path: str = BYTE_BPE_50K):
    """UDF: tokens of a text under a byte-level BPE vocabulary, without special tokens; null and empty texts have 0."""
    ship(SparkSession.getActiveSession(), path)
    return _count_udf(path)


@cache
def _count_udf(path: str):
    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return byte_bpe(path).count(texts)

    return count


def token_ids(path: str = BYTE_BPE_50K):
    """UDF: ids of a text under a byte-level BPE vocabulary, without special tokens; null and empty texts have []."""
    ship(SparkSession.getActiveSession(), path)
    return _ids_udf(path)


@cache
def _ids_udf(path: str):
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return byte_bpe(path).encode(texts)

    return encode


def unigram_count(spark: SparkSession, path: str = BYTE_BPE_50K):
    """UDF: tokens on the best path of a text under the unigram vocabulary of a rank file.

    The trie is built once on the driver and broadcast; its size depends on the vocabulary alone (about 2 MB).
    """
    shared = spark.sparkContext.broadcast(UnigramVocabulary.from_ranks(path))

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return shared.value.count(texts)

    return count


def encode_corpus(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """``id_col`` and ``ids`` of every row; repeated rows are encoded each, other columns are left behind."""
    return documents.select(F.col(id_col), token_ids(path)(F.col(text_col)).alias("ids"))


def text_sides(documents: DataFrame, bitext: DataFrame, count) -> DataFrame:
    """``kind, row_id, side, n_tokens``: documents (side 0) and both sides of each row of bitext (1 and 2)."""

    def one(df: DataFrame, kind: str, row_id: str, side: int, text: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(row_id).alias("row_id"), F.lit(side).alias("side"), count(F.col(text)).alias("n_tokens"))

    sides = bitext.select(
        F.col("pair_id").alias("row_id"),
        F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("source_text").alias("text")), F.struct(F.lit(2).alias("side"), F.col("target_text").alias("text")))).alias("s"),
    )
    pairs = sides.select(F.lit("bitext").alias("kind"), "row_id", F.col("s.side").alias("side"), count(F.col("s.text")).alias("n_tokens"))
    return one(documents, "documents", "doc_id", 0, "text").unionByName(pairs)


def budget_by_slice(documents: DataFrame, lang_plan: DataFrame, count) -> DataFrame:
    """Documents and tokens by source, by language and by domain, in one pass.

    ``slice`` is the kind of slice and ``value`` its key, null where the documents have none; sources and domains that
    differ in spelling are one. For languages ``available_tokens`` is the plan's amount (the largest of the plan's
    rows of that language; amounts that are null or below 1 are no amounts), else null.
    """
    counted = documents.select(
        source_key(F.col("source")).alias("source"),
        language_of(F.col("lang")).alias("language"),
        F.lower(F.trim(F.col("domain"))).alias("domain"),
        count(F.col("text")).alias("n"),
    )
    # The three keys are few: the first aggregation shrinks the rows before they are shuffled.
    cube = counted.groupBy("source", "language", "domain").agg(F.count("*").alias("docs"), F.sum("n").alias("n"))
    slices = cube.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("slice"), F.col(k).alias("value")) for k in ("source", "language", "domain")])).alias("s"), "docs", "n"
    )
    total = slices.groupBy("s.slice", "s.value").agg(F.sum("docs").alias("n_docs"), F.sum("n").alias("n_tokens"))
    plan = (
        lang_plan.filter("available_tokens > 0")
        .groupBy(F.lit("language").alias("slice"), language_of(F.col("lang")).alias("value"))
        .agg(F.max("available_tokens").alias("available_tokens"))
    )
    return total.join(plan, ["slice", "value"], "left")


def current_plan(source_plan: DataFrame) -> DataFrame:
    """The row with the latest ``planned_at`` of each dataset, target pair and source pair; amounts that are null or
    negative become 0. Equal times: the row with the larger amounts."""
    amount = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).alias(c)
    keys = ["dataset", "target_pair", "source_pair"]
    picked = source_plan.groupBy(*keys).agg(F.max(F.struct("planned_at", "alloc_tokens", "total_tokens")).alias("r")).select(*keys, "r.*")
    return picked.select(*keys, amount("total_tokens"), amount("alloc_tokens"))


def budget_by_source_pair(bitext: DataFrame, source_plan: DataFrame, count) -> DataFrame:
    """Rows and tokens of each source pair of bitext, beside the ``total_tokens`` of each current row of the plan.

    Source pairs that only one side knows appear with nulls on the other.
    """
    pair = F.concat_ws("-", F.coalesce("src_lang", F.lit("")), F.coalesce("tgt_lang", F.lit("")))
    held = (
        bitext.select(pair.alias("source_pair"), count(F.col("source_text")).alias("s"), count(F.col("target_text")).alias("t"))
        .groupBy("source_pair")
        .agg(F.count("*").alias("n_rows"), F.sum("s").alias("source_tokens"), F.sum("t").alias("target_tokens"))
    )
    plan = current_plan(source_plan).select("source_pair", "dataset", "target_pair", F.col("total_tokens").alias("planned_tokens"))
    return held.join(plan, "source_pair", "full").withColumn("held_tokens", F.col("source_tokens") + F.col("target_tokens"))
