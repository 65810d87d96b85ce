"""Queries through the sinks and sources: whole tables are written, read back, and compared with what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.values import finite
from corpusloom.operators.dedup import union_corpora
from corpusloom.plans.registry import query
from corpusloom.plans.views import PAIRS, pairs
from corpusloom.session import table
from corpusloom.sources import readers, reports, writers
from corpusloom.storage import scratch

_TEXTS = "pair_id bigint, source_text string, target_text string"


@query("SELECT count(*) FILTER (pair_id % 10 <> 0) AS n_good, count(*) FILTER (pair_id % 10 = 0) AS n_bad, sum(length(source_text)) FILTER (pair_id % 10 <> 0)::BIGINT AS chars FROM bitext")
def jsonl_bad_lines(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines of which every tenth is cut off: the good ones are read, the bad ones counted."""
    line = F.to_json(F.struct("pair_id", "source_text", "target_text"))
    path = scratch(spark, "jsonl")
    table(spark, d, "bitext").select(F.when(F.col("pair_id") % 10 == 0, F.left(line, F.lit(9))).otherwise(line).alias("value")).write.text(path)
    rows = readers.read_jsonl(spark, path, _TEXTS)
    bad = F.col("_corrupt_record").isNotNull()
    return rows.select(bad.alias("bad"), F.length("source_text").alias("n")).agg(F.count_if(~F.col("bad")).alias("n_good"), F.count_if("bad").alias("n_bad"), F.sum(F.when(~F.col("bad"), F.col("n"))).alias("chars"))


@query("SELECT pair_id, source_text, target_text FROM bitext")
def jsonl_to_parquet(spark: SparkSession, d: str) -> DataFrame:
    """All pairs as JSON lines, converted to Parquet."""
    source, target = scratch(spark, "jsonl"), scratch(spark, "parquet")
    table(spark, d, "bitext").select("pair_id", "source_text", "target_text").write.json(source)
    writers.jsonl_to_parquet(spark, source, target, _TEXTS)
    return spark.read.parquet(target)


@query("SELECT CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END AS score FROM opus_scored")
def scorer_files(spark: SparkSession, d: str) -> DataFrame:
    """Every score through a scorer's tab-separated file; the last column is read back."""
    path = scratch(spark, "tsv")
    rows = table(spark, d, "opus_scored").select("pair_id", "qe_model", finite(F.col("qe_score")).alias("score"))
    writers.write_scorer_tsv(rows, path, ["pair_id", "qe_model", "score"])
    return writers.read_scores(spark, path)


@query(f"WITH {PAIRS} SELECT pair_id, lang_pair, corpus, true AS in_bounds FROM pairs WHERE lang_pair IS NOT NULL")
def partitioned_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of at most 100 rows in folders by language pair, read with their folders; each file's rows are counted."""
    path = scratch(spark, "shards")
    writers.write_shards(pairs(spark, d).filter("lang_pair is not null").select("pair_id", "corpus", "lang_pair"), path, 100, ["lang_pair"])
    rows = readers.read_parts(spark, path)
    sizes = rows.groupBy("file_path").agg(F.count("*").alias("n"))
    return rows.join(sizes, "file_path").select("pair_id", "lang_pair", "corpus", (F.col("n") <= 100).alias("in_bounds"))


@query(f"""WITH {PAIRS}, sized AS (SELECT pair_id, lang_pair, ingested_at, coalesce(octet_length(encode(source_text)), 0) + coalesce(octet_length(encode(target_text)), 0) AS size FROM pairs WHERE lang_pair IS NOT NULL)
SELECT pair_id, lang_pair, (sum(size) OVER (PARTITION BY lang_pair ORDER BY ingested_at, pair_id) - size)::BIGINT // 4000 AS file_no FROM sized""")
def rotated_shards(spark: SparkSession, d: str) -> DataFrame:
    """Files of about 4,000 bytes of text in each language pair, by the bytes before each row, written and read back."""
    path = scratch(spark, "rotated")
    size = F.coalesce(F.octet_length("source_text"), F.lit(0)) + F.coalesce(F.octet_length("target_text"), F.lit(0))
    rows = pairs(spark, d).filter("lang_pair is not null").select("pair_id", "lang_pair", "ingested_at", size.alias("bytes"))
    writers.write_rotated(rows, path, ["lang_pair"], [F.col("ingested_at"), F.col("pair_id")], F.col("bytes"), 4000)
    return spark.read.parquet(path).select("pair_id", "lang_pair", F.col("file_no").cast("bigint").alias("file_no"))


@query("SELECT pair_id, corpus, (SELECT count(*) FROM bitext) AS manifest_rows FROM bitext")
def published_rows(spark: SparkSession, d: str) -> DataFrame:
    """A table published twice under one name: the second version is read, with its manifest."""
    path, rows = scratch(spark, "published"), table(spark, d, "bitext").select("pair_id", "corpus")
    writers.publish(rows.filter("pair_id % 2 = 0"), path, run="first")
    manifest = writers.publish(rows, path, expected=rows.count(), run="second")
    return spark.read.parquet(path).withColumn("manifest_rows", F.lit(manifest["rows"]).cast("bigint"))


@query(f"""WITH {PAIRS}, files AS (SELECT DISTINCT lang_pair AS home, conv_src_lang || '-' || conv_tgt_lang AS new_home, coalesce(corpus, 'none') AS name FROM pairs WHERE lang_pair IS NOT NULL AND conv_src_lang IS NOT NULL AND conv_tgt_lang IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY new_home, name ORDER BY (home <> new_home)::INT, home) - 1 AS n FROM files)
SELECT home, new_home, name, CASE WHEN n = 0 THEN name ELSE name || '.moved-' || n END AS new_name FROM placed""")
def rehomed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of language pairs whose codes were corrected, with the names they get where they move."""
    rows = pairs(spark, d).select(F.col("lang_pair").alias("home"), F.concat("conv_src_lang", F.lit("-"), "conv_tgt_lang").alias("new_home"), F.coalesce("corpus", F.lit("none")).alias("name"))
    return writers.rehome_plan(rows.dropna().distinct(), "home", "new_home", "name")


@query(f"WITH {PAIRS}, n AS (SELECT lang_pair, count(*) AS n FROM pairs WHERE lang_pair IS NOT NULL GROUP BY 1) SELECT lang_pair, CASE WHEN n > 20 THEN n + 1000 ELSE n END AS n_rows FROM n")
def chunked_stats(spark: SparkSession, d: str) -> DataFrame:
    """CSV statistics with a later chunk that corrects some rows: the last row of a key counts."""
    path = scratch(spark, "stats")
    n = pairs(spark, d).filter("lang_pair is not null").groupBy("lang_pair").agg(F.count("*").alias("n_rows"))
    n.coalesce(1).write.option("header", "true").csv(f"{path}/s.chunk0.csv")  # one row a pair
    n.filter("n_rows > 20").withColumn("n_rows", F.col("n_rows") + 1000).coalesce(1).write.option("header", "true").csv(f"{path}/s.chunk1.csv")
    return readers.read_stats(spark, f"{path}/s.chunk*.csv", ["lang_pair"]).select("lang_pair", F.col("n_rows").cast("bigint").alias("n_rows"))


@query("SELECT 2 * count(*) AS n_rows, true AS verified FROM bitext")
def verified_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two corpora with different names of their text columns, merged, written and verified by rows and columns."""
    path = scratch(spark, "merged")
    a = table(spark, d, "bitext").select("source_text", "target_text", "corpus")
    b = table(spark, d, "bitext").select(F.col("source_text").alias("src_text"), F.col("target_text").alias("tgt_text"), "version")
    union_corpora(a, b, rename=readers.OLD_TEXT_NAMES).write.parquet(path)
    n = writers.verify_union([a, b], spark.read.parquet(path), readers.OLD_TEXT_NAMES)
    return spark.createDataFrame([(n, True)], "n_rows bigint, verified boolean")


@query(f"WITH {PAIRS} SELECT DISTINCT lang_pair AS removed FROM pairs WHERE lang_pair LIKE 'eng_Latn-%'")
def removed_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Parts of every language pair, of which those from English have been merged and may go."""
    parts, merged = scratch(spark, "parts"), scratch(spark, "merged")
    names = [r.lang_pair for r in pairs(spark, d).filter("lang_pair is not null").select("lang_pair").distinct().collect()]  # one row a pair
    for n in names:
        for folder in [parts, merged] if n.startswith("eng_Latn-") else [parts]:
            spark.range(1).coalesce(1).write.parquet(f"{folder}/{n}")
    return spark.createDataFrame([(n,) for n in writers.remove_merged_inputs(spark, parts, merged, dry_run=False)], "removed string")


@query(f"WITH {PAIRS} SELECT lang_pair, count(*)::VARCHAR AS n_rows FROM pairs WHERE lang_pair IS NOT NULL GROUP BY 1")
def workbook_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts through a workbook: written, and read back as text."""
    path = scratch(spark, "workbook")
    counted = pairs(spark, d).filter("lang_pair is not null").groupBy("lang_pair").agg(F.count("*").alias("n_rows"))
    reports.write_workbook(counted, f"{path}/counts.xlsx")
    return readers.read_workbook(spark, f"{path}/counts.xlsx", ["lang_pair", "n_rows"])


@query("SELECT '| ' || dataset || ' | ' || target_pair || ' | ' || CASE WHEN quota IS NULL THEN '' ELSE quota::VARCHAR END || ' |' AS line FROM (SELECT DISTINCT dataset, target_pair, quota FROM pair_plan)")
def plan_report(spark: SparkSession, d: str) -> DataFrame:
    """The lines of a Markdown table of the quotas."""
    rows = table(spark, d, "pair_plan").select("dataset", "target_pair", "quota").distinct()
    return reports.markdown_lines(rows).select("line")


@query("SELECT corpus, src_lang AS source, tgt_lang AS target, count(*) AS pairs FROM bitext WHERE corpus IS NOT NULL GROUP BY 1, 2, 3")
def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue's JSON answer with one entry a corpus and language pair, written to a file and read."""
    path = scratch(spark, "catalogue")
    entries = table(spark, d, "bitext").filter("corpus is not null").groupBy("corpus", F.col("src_lang").alias("source"), F.col("tgt_lang").alias("target")).agg(F.count("*").alias("pairs"))
    answer = entries.agg(F.to_json(F.struct(F.collect_list(F.struct(*entries.columns)).alias("corpora"))).alias("value"))  # one row a corpus and pair
    answer.coalesce(1).write.text(path)
    return readers.read_catalogue(spark, path, "corpus string, source string, target string, pairs bigint")
