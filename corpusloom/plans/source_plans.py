"""Queries on ingestion: scripts, codes, zipped results, roll-ups of complete work, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.joins import pick_groups, positional_join
from corpusloom.operators.stats import score_summary
from corpusloom.operators.tracking import complete_groups
from corpusloom.plans.hash_sql import hashed_text
from corpusloom.plans.registry import query
from corpusloom.plans.views import PAIRS, SCORES, pairs, predictions, predictions_sql, scores
from corpusloom.session import spread, table
from corpusloom.sources.readers import majority_script, normalised_code

_NAMES = {"Arab": "Arabic", "Cyrl": "Cyrillic", "Deva": "Devanagari", "Grek": "Greek", "Hang": "Hangul", "Hani": "Han", "Hebr": "Hebrew", "Latn": "Latin", "Thai": "Thai"}
_SCRIPTS = f"""sums AS (SELECT lang, {", ".join(f"sum(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '\\p{{{n}}}', '', 'g'))) AS {c}" for c, n in _NAMES.items())}, sum(length(regexp_replace(coalesce(text, ''), '[^\\p{{L}}]', '', 'g'))) AS letters FROM documents GROUP BY 1),
scripts AS (SELECT lang, CASE WHEN greatest({", ".join(_NAMES)}) = 0 THEN 'Zyyy' {" ".join(f"WHEN {c} = greatest({', '.join(_NAMES)}) THEN '{c}'" for c in _NAMES)} END AS script, greatest({", ".join(_NAMES)}) / nullif(letters, 0)::DOUBLE AS share FROM sums)"""


def _scripts(spark: SparkSession, d: str) -> DataFrame:
    return majority_script(spread(table(spark, d, "documents").select("lang", "text", "doc_id")), ["lang"], "text", ["doc_id"])


def _codes(scripts: DataFrame) -> DataFrame:
    return scripts.select("lang", normalised_code(F.col("lang"), F.col("script"), {"en": "eng_Latn"}).alias("code"))


@query(f"WITH {_SCRIPTS} SELECT * FROM scripts")
def script_detection(spark: SparkSession, d: str) -> DataFrame:
    """Script of all texts of each label."""
    return _scripts(spark, d)


@query(f"""WITH {_SCRIPTS} SELECT lang, CASE WHEN lang = 'en' THEN 'eng_Latn' WHEN regexp_matches(lang, '^[a-z]{{3}}_[A-Z][a-z]{{3}}$') THEN lang WHEN regexp_matches(lang, '^[a-z]{{3}}$') THEN lang || '_' || script ELSE 'und_Zyyy' END AS code FROM scripts""")
def normalised_codes(spark: SparkSession, d: str) -> DataFrame:
    return _codes(_scripts(spark, d))


@query(f"WITH {predictions_sql()} SELECT pair_id, ingested_at, lang_pair, src_id_glotlid, src_id_conlid FROM preds")
def zipped_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Two models' outputs for the same rows, put side by side, their pair checked."""
    rows = predictions(spark, d)
    key = ["pair_id", "ingested_at"]
    return positional_join(rows.select(*key, "lang_pair", "src_id_glotlid"), rows.select(*key, "lang_pair", "src_id_conlid"), key, ["lang_pair"])


@query(f"""WITH {SCORES}, shards AS (SELECT direction_key, shard_id, count(*) AS n, count(qe_score) AS n_scored FROM scores WHERE direction_key IS NOT NULL GROUP BY 1, 2)
SELECT direction_key, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n_scored) AS BIGINT) AS n_scored FROM shards GROUP BY 1 HAVING min(n_scored) > 0""")
def complete_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Sums of the directions of which every shard has a score."""
    shards = scores(spark, d).filter("direction_key is not null").groupBy("direction_key", "shard_id").agg(F.count("*").alias("n"), F.count("qe_score").alias("scored"))
    whole = complete_groups(shards, shards.filter("scored > 0"), ["direction_key"], ["shard_id"]).filter("complete").select("direction_key")
    return shards.join(whole, "direction_key", "left_semi").groupBy("direction_key").agg(F.sum("n").alias("n_rows"), F.sum("scored").alias("n_scored"))


@query("SELECT pair_id, ingested_at, corpus FROM bitext ORDER BY pair_id, ingested_at LIMIT 5")
def preview(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bitext").select("pair_id", "ingested_at", "corpus").orderBy("pair_id", "ingested_at").limit(5)


@query("SELECT * EXCLUDE (url, version, orig_src_lang, orig_tgt_lang) FROM bitext")
def kept_columns(spark: SparkSession, d: str) -> DataFrame:
    """Pairs without the columns that only tell where they came from."""
    return table(spark, d, "bitext").drop("url", "version", "orig_src_lang", "orig_tgt_lang")


@query(f"""WITH {PAIRS}, stats AS (SELECT lang_pair, count(*) AS n_rows, avg(similarity_score::DOUBLE) AS mean FROM pairs WHERE lang_pair IS NOT NULL GROUP BY 1), {hashed_text('stats', 'drawn', 0, 'lang_pair', 17)}
(SELECT 'worst' AS why, lang_pair, n_rows, mean FROM stats ORDER BY mean NULLS LAST, lang_pair LIMIT 5) UNION ALL (SELECT 'biggest', lang_pair, n_rows, mean FROM stats ORDER BY n_rows DESC, lang_pair LIMIT 5)
UNION ALL (SELECT 'random', lang_pair, n_rows, mean FROM drawn ORDER BY CASE WHEN h < 9223372036854775808::UBIGINT THEN h::HUGEINT ELSE h::HUGEINT - 18446744073709551616::HUGEINT END, lang_pair LIMIT 5)""")
def diagnostic_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Worst, largest and some other language pairs by similarity."""
    stats = score_summary(pairs(spark, d).filter("lang_pair is not null"), ["lang_pair"], "similarity_score")
    return pick_groups(stats.select("lang_pair", "n_rows", "mean"), 5, "lang_pair", "mean", "n_rows")


@query(f"WITH {PAIRS} SELECT lang_pair, src_lang, tgt_lang, count(*) AS n FROM pairs WHERE src_lang <> tgt_lang GROUP BY 1, 2, 3")
def cross_language_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).filter("src_lang <> tgt_lang").groupBy("lang_pair", "src_lang", "tgt_lang").agg(F.count("*").alias("n"))
