"""Queries on copies, keys, shards and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import dedup
from corpusloom.plans.registry import query
from corpusloom.plans.views import PAIRS, model_name, pairs
from corpusloom.session import table
from corpusloom.sources.readers import valid_pair
from corpusloom.sources.writers import shard_numbers


@query("""SELECT pair_id, source_text, target_text, corpus, ingested_at FROM (
SELECT *, row_number() OVER (PARTITION BY source_text, target_text ORDER BY ingested_at, pair_id) AS n FROM bitext WHERE source_text IS NOT NULL AND target_text IS NOT NULL) WHERE n = 1""")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bitext").select("pair_id", "source_text", "target_text", "corpus", "ingested_at")
    return dedup.exact_dedup(rows, "source_text", "target_text", ["ingested_at", "pair_id"])


@query("""SELECT pair_id, source_text, target_text, corpus, ingested_at FROM (
SELECT *, row_number() OVER (PARTITION BY source_text, target_text ORDER BY ingested_at, pair_id) AS n FROM bitext WHERE source_text IS NOT NULL AND target_text IS NOT NULL) WHERE n = 1""")
def hashed_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The same as ``exact_dedup``, by hashes."""
    rows = table(spark, d, "bitext").select("pair_id", "source_text", "target_text", "corpus", "ingested_at")
    return dedup.dedup_by_hash(rows, "source_text", "target_text", ["ingested_at", "pair_id"])


@query(f"""WITH {PAIRS} SELECT lang_pair, count(*) AS input_rows, count(*) FILTER (source_text IS NULL OR target_text IS NULL) AS null_rows,
count(DISTINCT CASE WHEN source_text IS NOT NULL AND target_text IS NOT NULL THEN (source_text, target_text) END) AS kept_rows,
count(*) - count(DISTINCT CASE WHEN source_text IS NOT NULL AND target_text IS NOT NULL THEN (source_text, target_text) END) AS removed_rows
FROM pairs GROUP BY lang_pair""")
def dedup_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_counts(pairs(spark, d), ["lang_pair"], "source_text", "target_text")


COPIES = "copies AS (SELECT source_text, target_text, count(*) AS n FROM bitext GROUP BY 1, 2)"


@query(f"""WITH {COPIES} SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique, count(*) FILTER (n > 1) AS n_groups,
CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS involved_rows, CAST(sum(n - 1) AS BIGINT) AS extra_rows, max(n) AS max_copies FROM copies""")
def duplicate_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_stats(table(spark, d, "bitext"), ["source_text", "target_text"])


@query(f"WITH {COPIES} SELECT n AS copies, count(*) AS n_keys FROM copies GROUP BY 1")
def copies_distribution(spark: SparkSession, d: str) -> DataFrame:
    return dedup.copies_distribution(table(spark, d, "bitext"), ["source_text", "target_text"])


@query("SELECT pair_id, corpus, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at DESC) AS n FROM bitext) WHERE n = 1")
def keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_one(table(spark, d, "bitext").select("pair_id", "corpus", "ingested_at"), ["pair_id"], ["ingested_at"], last=True)


@query("SELECT pair_id, corpus, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) AS n FROM bitext) WHERE n = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.keep_one(table(spark, d, "bitext").select("pair_id", "corpus", "ingested_at"), ["pair_id"], ["ingested_at"])


@query("""WITH marked AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
blocks AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block_no FROM marked)
SELECT event_id, user_id, event_type, block_no FROM (SELECT *, min(block_no) OVER (PARTITION BY user_id, event_type) AS first_no FROM blocks) WHERE block_no = first_no""")
def block_dedup(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return dedup.first_blocks(events, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type", "block_no")


@query("""SELECT pair_id, ingested_at, source_text, target_text, src_lang, tgt_lang FROM bitext WHERE src_lang = 'eng_Latn' AND tgt_lang = 'deu_Latn'
UNION ALL SELECT pair_id, ingested_at, target_text, source_text, tgt_lang, src_lang FROM bitext WHERE src_lang = 'deu_Latn' AND tgt_lang = 'eng_Latn'""")
def bidirectional_union(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bitext").select("pair_id", "ingested_at", "source_text", "target_text", "src_lang", "tgt_lang")
    return dedup.both_directions(rows, "src_lang", "tgt_lang", {"source_text": "target_text"}, ("eng_Latn", "deu_Latn"))


@query("""SELECT source_text, target_text, corpus, version, similarity_score::DOUBLE AS similarity_score FROM bitext
UNION ALL SELECT lang1_text, lang2_text, corpus, version, NULL FROM eval_sample""")
def corpora_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "bitext").select("source_text", "target_text", "corpus", "version", F.col("similarity_score").cast("double"))
    b = table(spark, d, "eval_sample").select("lang1_text", "lang2_text", "corpus", "version")
    return dedup.union_corpora(a, b, rename={"lang1_text": "source_text", "lang2_text": "target_text"})


@query(f"WITH {PAIRS} SELECT DISTINCT direction_key FROM opus_scored WHERE direction_key NOT IN (SELECT lang_pair FROM pairs WHERE lang_pair IS NOT NULL) OR direction_key IS NULL")
def unknown_directions(spark: SparkSession, d: str) -> DataFrame:
    known = pairs(spark, d).select(F.col("lang_pair").alias("direction_key"))
    return dedup.missing_keys(table(spark, d, "opus_scored"), known, ["direction_key"])


@query(f"WITH {PAIRS} SELECT DISTINCT direction_key FROM opus_scored WHERE direction_key IN (SELECT lang_pair FROM pairs)")
def common_directions(spark: SparkSession, d: str) -> DataFrame:
    known = pairs(spark, d).select(F.col("lang_pair").alias("direction_key"))
    return dedup.common_keys(table(spark, d, "opus_scored"), known, ["direction_key"])


@query(r"""SELECT direction_key, shard_id, qe_model, CAST(sum(n - 1) AS BIGINT) AS to_remove FROM (
SELECT direction_key, shard_id, lower(trim(regexp_replace(qe_model, '\s+', ' ', 'g'))) AS qe_model, pair_id, count(*) AS n FROM opus_scored GROUP BY 1, 2, 3, 4) WHERE n > 1 GROUP BY 1, 2, 3""")
def checkpoint_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "opus_scored").withColumn("qe_model", model_name(F.col("qe_model")))
    many = rows.groupBy("direction_key", "shard_id", "qe_model", "pair_id").agg(F.count("*").alias("n")).filter("n > 1")
    return many.groupBy("direction_key", "shard_id", "qe_model").agg(F.sum(F.col("n") - 1).alias("to_remove"))


@query("""SELECT pair_id, count(*) AS n, CASE WHEN count(DISTINCT (coalesce(src_char_len, -1), coalesce(trg_char_len, -1))) = 1 THEN 'identical' ELSE 'conflict' END AS status
FROM bitext GROUP BY 1 HAVING count(*) > 1""")
def conflicting_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bitext").fillna(-1, ["src_char_len", "trg_char_len"])
    return dedup.conflicting(rows, ["pair_id"], ["src_char_len", "trg_char_len"])


@query(f"""WITH {PAIRS} SELECT pair_id, ingested_at, lang_pair, row_number() OVER w - 1 AS row_index, (row_number() OVER w - 1) // 100 AS shard_id
FROM pairs WINDOW w AS (PARTITION BY lang_pair ORDER BY ingested_at, pair_id)""")
def shard_assignment(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).select("pair_id", "ingested_at", "lang_pair")
    return shard_numbers(rows, ["lang_pair"], [F.col("ingested_at"), F.col("pair_id")], 100)


@query("SELECT pair_id, ingested_at, row_number() OVER (ORDER BY ingested_at, pair_id) - 1 AS row_index, (row_number() OVER (ORDER BY ingested_at, pair_id) - 1) // 1000 AS shard_id FROM bitext")
def global_shards(spark: SparkSession, d: str) -> DataFrame:
    return shard_numbers(table(spark, d, "bitext").select("pair_id", "ingested_at"), [], [F.col("ingested_at"), F.col("pair_id")], 1000)


@query(f"""WITH {PAIRS} SELECT pair_id, lang_pair FROM (SELECT *, row_number() OVER (PARTITION BY lang_pair ORDER BY ingested_at, pair_id) - 1 AS i FROM pairs)
WHERE i >= 10 AND i < 60 AND source_text IS NOT NULL AND target_text IS NOT NULL""")
def shard_range(spark: SparkSession, d: str) -> DataFrame:
    """Rows 10 to 59 of each direction, those with a null text skipped."""
    rows = pairs(spark, d).select("pair_id", "ingested_at", "lang_pair", (F.col("source_text").isNotNull() & F.col("target_text").isNotNull()).alias("whole"))
    numbered = shard_numbers(rows, ["lang_pair"], [F.col("ingested_at"), F.col("pair_id")], 100)
    return numbered.filter(F.col("row_index").between(10, 59) & F.col("whole")).select("pair_id", "lang_pair")


@query("""WITH known AS (SELECT source_text a, target_text b FROM bitext UNION SELECT target_text, source_text FROM bitext)
SELECT sample_id, lang1_text, lang2_text FROM eval_sample e WHERE NOT EXISTS (SELECT 1 FROM known WHERE a IS NOT DISTINCT FROM e.lang1_text AND b IS NOT DISTINCT FROM e.lang2_text)""")
def cross_check(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "eval_sample").select("sample_id", F.col("lang1_text").alias("source_text"), F.col("lang2_text").alias("target_text"))
    left = dedup.not_in_final(rows, table(spark, d, "bitext"), "source_text", "target_text")
    return left.select("sample_id", F.col("source_text").alias("lang1_text"), F.col("target_text").alias("lang2_text"))


@query(f"WITH {PAIRS} SELECT lang_pair, count(*) AS n_rows FROM pairs GROUP BY 1")
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).groupBy("lang_pair").agg(F.count("*").alias("n_rows"))


@query(f"""WITH {PAIRS} SELECT lang_pair, coalesce(regexp_matches(lang_pair, '^[a-z]{{3}}_[A-Z][a-z]{{3}}-[a-z]{{3}}_[A-Z][a-z]{{3}}$'), false) AS valid,
count(*) FILTER (src_lang <> tgt_lang) AS n_cross, count(*) FILTER (src_lang = tgt_lang) AS n_same FROM pairs GROUP BY 1, 2""")
def valid_pairs(spark: SparkSession, d: str) -> DataFrame:
    same = F.col("src_lang") == F.col("tgt_lang")
    return pairs(spark, d).groupBy("lang_pair", valid_pair(F.col("lang_pair")).alias("valid")).agg(F.count_if(~same).alias("n_cross"), F.count_if(same).alias("n_same"))


@query("""SELECT orig_src_lang, orig_tgt_lang, coalesce(a.mapped, orig_src_lang) AS conv_orig_src_lang, coalesce(b.mapped, orig_tgt_lang) AS conv_orig_tgt_lang, count(*) AS n
FROM bitext LEFT JOIN (SELECT split_part(lang, '_', 1) AS code, any_value(lang) AS mapped FROM lang_plan GROUP BY 1) a ON orig_src_lang = a.code
LEFT JOIN (SELECT split_part(lang, '_', 1) AS code, any_value(lang) AS mapped FROM lang_plan GROUP BY 1) b ON orig_tgt_lang = b.code GROUP BY 1, 2, 3, 4""")
def mapped_languages(spark: SparkSession, d: str) -> DataFrame:
    from corpusloom.sources.readers import map_languages

    mapping = table(spark, d, "lang_plan").groupBy(F.split_part("lang", F.lit("_"), F.lit(1)).alias("code")).agg(F.min(F.concat("lang", F.lit("_x"))).alias("three_part"), F.min(F.lit(None).cast("string")).alias("iso3"))
    rows = table(spark, d, "bitext").groupBy("orig_src_lang", "orig_tgt_lang").agg(F.count("*").alias("n"))
    return map_languages(rows, mapping, ["orig_src_lang", "orig_tgt_lang"])
