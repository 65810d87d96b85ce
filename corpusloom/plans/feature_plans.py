"""Queries on per-row text features and scalar helpers."""

from __future__ import annotations

from hashlib import blake2b

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import values as V
from corpusloom.operators.scoring import score_pairs, trigram_scorer
from corpusloom.plans.hash_sql import mixed
from corpusloom.plans.registry import query
from corpusloom.plans.views import FEATURES, PAIRS, WS, alignments_sql, features, features_sql, pairs, repeats_sql, word_sql
from corpusloom.session import spread, table
from corpusloom.sources.readers import path_fields
from corpusloom.sources.writers import flat

def _lengths_sql(mode: str) -> str:
    # In mode compat the target's language isn't looked at.
    lang = "NULL" if mode == "compat" else "tgt_lang"
    ratio = lambda a, b: f"{'floor' if mode == 'compat' else ''}(greatest({a}, {b})::DOUBLE / greatest(least({a}, {b}), 1))"
    return f"""WITH base AS (SELECT pair_id, ingested_at, length(source_text) AS src_char_len, length(target_text) AS trg_char_len,
{word_sql("source_text", "src_lang", "src", mode)}, {word_sql("target_text", lang, "trg", mode)} FROM bitext)
SELECT *, {ratio("src_char_len", "trg_char_len")} AS char_len_ratio, {ratio("src_word_len", "trg_word_len")} AS word_len_ratio FROM base"""


def _lengths(spark: SparkSession, d: str, mode: str) -> DataFrame:
    s, t = F.col("source_text"), F.col("target_text")
    a = T.word_stats(s, F.col("src_lang"), mode)
    b = T.word_stats(t, None if mode == "compat" else F.col("tgt_lang"), mode)
    rows = spread(table(spark, d, "bitext")).select(
        "pair_id", "ingested_at", F.length(s).alias("src_char_len"), F.length(t).alias("trg_char_len"), *[c.alias(f"src_{k}") for k, c in a.items()], *[c.alias(f"trg_{k}") for k, c in b.items()]
    )
    return rows.select("*", *[T.length_ratio(F.col(f"src_{k}_len"), F.col(f"trg_{k}_len"), mode).alias(f"{k}_len_ratio") for k in ("char", "word")])


@query(_lengths_sql("compat").replace("regexp_matches(NULL, ", "regexp_matches(NULL::VARCHAR, "))
def length_features(spark: SparkSession, d: str) -> DataFrame:
    return _lengths(spark, d, "compat")


@query(_lengths_sql("fixed"))
def length_features_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _lengths(spark, d, "fixed")


@query(f"WITH {features_sql()} SELECT pair_id, ingested_at, {', '.join(FEATURES)}, filter_html_src, filter_html_trg FROM feats")
def pair_features(spark: SparkSession, d: str) -> DataFrame:
    return features(spark, d).select("pair_id", "ingested_at", *FEATURES, "filter_html_src", "filter_html_trg")


@query("SELECT doc_id, coalesce(regexp_matches(text, '<[a-zA-Z][^>]*>'), false) AS filter_html, coalesce(regexp_matches(text, '[0-9]{4}'), false) AS filter_regex FROM documents")
def text_flags(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.html_flag(t).alias("filter_html"), T.regex_flag(t, "[0-9]{4}").alias("filter_regex"))


@query(f"WITH {alignments_sql('bitext')} SELECT pair_id, coalesce(score_numerals, 0) AS score_numerals FROM bitext LEFT JOIN aligned ON a_s = source_text AND a_t = target_text")
def numeral_scores(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "bitext")).select("pair_id", T.numeral_score("source_text", "target_text").alias("score_numerals"))


@query(f"WITH {alignments_sql('bitext')} SELECT pair_id, coalesce(score_lcs_ratio, 0) AS score_lcs_ratio FROM bitext LEFT JOIN aligned ON a_s = source_text AND a_t = target_text")
def lcs_ratios(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "bitext")).select("pair_id", T.lcs_ratio("source_text", "target_text").alias("score_lcs_ratio"))


@query(f"WITH {alignments_sql('bitext')} SELECT pair_id, CASE WHEN coalesce(source_text, '') = '' AND coalesce(target_text, '') = '' THEN 1.0::DOUBLE ELSE coalesce(score_levenshtein, 0) END AS score_levenshtein FROM bitext LEFT JOIN aligned ON a_s = source_text AND a_t = target_text")
def levenshtein_similarities(spark: SparkSession, d: str) -> DataFrame:
    """By characters; a null text counts as empty."""
    return spread(table(spark, d, "bitext")).select("pair_id", T.levenshtein_similarity(F.col("source_text"), F.col("target_text")).alias("score_levenshtein"))


@query(f"SELECT pair_id, CASE WHEN source_text IS NULL THEN 0 ELSE {repeats_sql('source_text')} END::INT AS score_repeat_src, CASE WHEN target_text IS NULL THEN 0 ELSE {repeats_sql('target_text')} END::INT AS score_repeat_trg FROM bitext")
def repetition_scores(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "bitext")).select("pair_id", T.repetition_score("source_text").alias("score_repeat_src"), T.repetition_score("target_text").alias("score_repeat_trg"))


@query(f"""SELECT pair_id, ingested_at, trim(regexp_replace(nfc_normalize(source_text), '[{WS}]+', ' ', 'g')) = trim(regexp_replace(nfc_normalize(target_text), '[{WS}]+', ' ', 'g')) AS same FROM bitext""")
def copied_pairs(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "bitext")).select("pair_id", "ingested_at", T.same_text("source_text", "target_text").alias("same"))


def _share_sql() -> str:
    cases = " ".join(
        f"WHEN '{code}' THEN length(regexp_replace(regexp_replace(text, '[^\\p{{L}}]', '', 'g'), '[^{''.join(rf'\p{{{n}}}' for n in names)}]', '', 'g'))"
        for code, names in T.SCRIPTS.items() if code in ("Latn", "Cyrl", "Grek", "Arab", "Hans", "Thai")
    )
    return f"""SELECT doc_id, length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS letters,
CASE split_part(lang, '_', 2) {cases} END / nullif(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')), 0)::DOUBLE AS share FROM documents WHERE lang LIKE '%\\_%' ESCAPE '\\'"""


@query(_share_sql())
def script_shares(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    rows = table(spark, d, "documents").filter(F.col("lang").contains("_"))
    return rows.select("doc_id", T.letter_count(t).alias("letters"), T.script_share(t, F.substring_index("lang", "_", -1)).alias("share"))


@query(f"""SELECT doc_id, len(regexp_extract_all(text, '[^{WS}]+')) AS n_words,
length(regexp_replace(text, '[{WS}]+', '', 'g')) / greatest(len(regexp_extract_all(text, '[^{WS}]+')), 1)::DOUBLE AS avg_len FROM documents""")
def spaced_words(spark: SparkSession, d: str) -> DataFrame:
    count, mean = T.spaced_words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", count.alias("n_words"), mean.alias("avg_len"))


@query(f"""SELECT source, count(*) AS n_lines, CAST(coalesce(sum(len(regexp_extract_all(text, '[^{WS}]+'))), 0) AS BIGINT) AS n_tokens_space,
CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars_real FROM documents GROUP BY 1""")
def space_token_counts(spark: SparkSession, d: str) -> DataFrame:
    count, _ = T.spaced_words(F.col("text"))
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_lines"), F.coalesce(F.sum(count), F.lit(0)).alias("n_tokens_space"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars_real"))


@query("""SELECT pair_id, qe_model, scored_at, CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END AS finite_score,
CASE WHEN NOT isnan(qe_score) AND NOT isinf(qe_score) THEN least(floor(least(greatest(qe_score, 0), 1) * 20), 19)::INTEGER END AS bin,
1 - CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END / 25 AS metricx_unit, CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END / 100 AS llm_unit,
CASE WHEN lower(trim(qe_src_seen)) IN ('true', 't', '1', 'yes', 'y', 'supported', 'covered') THEN true WHEN lower(trim(qe_src_seen)) IN ('false', 'f', '0', 'no', 'n', 'unsupported', 'uncovered') THEN false END AS src_seen,
try_cast(qe_src_seen AS INTEGER) AS seen_int FROM (SELECT DISTINCT * FROM opus_scored)""")
def score_values(spark: SparkSession, d: str) -> DataFrame:
    f = V.finite(F.col("qe_score"))
    bin_ = F.when(f.isNotNull(), V.score_bin(f, 20))
    return table(spark, d, "opus_scored").distinct().select(
        "pair_id", "qe_model", "scored_at", f.alias("finite_score"), bin_.alias("bin"), V.metricx_to_unit(f).alias("metricx_unit"), V.llm_to_unit(f).alias("llm_unit"),
        V.truth(F.col("qe_src_seen")).alias("src_seen"), F.col("qe_src_seen").try_cast("int").alias("seen_int"),
    )


@query(r"""WITH p AS (SELECT pair_id, '/merged/' || corpus || '/' || src_lang || '-' || tgt_lang || '/' || src_lang || '-' || tgt_lang || CASE WHEN pair_id % 2 = 0 THEN '.part-0001' ELSE '' END || '.parquet' AS path
FROM bitext WHERE corpus <> '' AND src_lang IS NOT NULL AND tgt_lang IS NOT NULL AND pair_id % 3 > 0
UNION ALL SELECT pair_id, '\merged\' || corpus || '\' || src_lang || '-' || tgt_lang || '.parquet' FROM bitext WHERE corpus <> '' AND src_lang IS NOT NULL AND tgt_lang IS NOT NULL AND pair_id % 3 = 0)
SELECT DISTINCT pair_id, split_part(replace(path, '\', '/'), '/', 3) AS model, regexp_replace(regexp_extract(replace(path, '\', '/'), '/([^/]+)[.]parquet$', 1), '[.]part-[0-9]+$', '') AS direction_key,
split_part(regexp_replace(regexp_extract(replace(path, '\', '/'), '/([^/]+)[.]parquet$', 1), '[.]part-[0-9]+$', ''), '-', 1) AS src_lang,
split_part(regexp_replace(regexp_extract(replace(path, '\', '/'), '/([^/]+)[.]parquet$', 1), '[.]part-[0-9]+$', ''), '-', 2) AS tgt_lang FROM p""")
def part_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).filter("corpus <> '' and src_lang is not null and tgt_lang is not null")
    part = F.when(F.col("pair_id") % 2 == 0, ".part-0001").otherwise("")
    nested = F.concat(F.lit("/merged/"), "corpus", F.lit("/"), "lang_pair", F.lit("/"), "lang_pair", part, F.lit(".parquet"))
    flat_ = F.concat(F.lit("\\merged\\"), "corpus", F.lit("\\"), "lang_pair", F.lit(".parquet"))
    paths = rows.select("pair_id", F.when(F.col("pair_id") % 3 > 0, nested).otherwise(flat_).alias("path"))
    return paths.select("pair_id", *[c.alias(k) for k, c in path_fields(F.col("path")).items()]).distinct()


@query("SELECT doc_id, CASE WHEN length(line) <= 80 THEN line ELSE " + "regexp_replace(substr(line, 1, 79), '^[" + WS + "]+|[" + WS + "]+$', '', 'g')" + """ || '…' END AS shown, greatest(1, length(text) // 3) AS tokens_in, 60 + 20 * (doc_id % 7) AS tokens_out,
coalesce(translate(text, E'\\t\\r\\n', '   '), '') AS flat FROM (SELECT *, """ + "regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^[" + WS + "]+|[" + WS + "]+$', '', 'g') AS line FROM documents) WHERE text IS NOT NULL")
def prompt_parts(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").filter(t.isNotNull()).select(
        "doc_id", V.truncated(t, 80).alias("shown"), V.input_token_estimate(t).alias("tokens_in"), V.output_token_estimate(F.col("doc_id") % 7).alias("tokens_out"), flat(t).alias("flat")
    )


@query("""SELECT batch, '' || string_agg('[' || item || '] ' || src_lang || ': ' || replace(source_text, chr(10), ' ') || ' | ' || tgt_lang || ': ' || replace(target_text, chr(10), ' '), chr(10) ORDER BY item) AS block, count(*) AS n FROM (
SELECT *, pair_id // 8 AS batch, pair_id % 8 AS item FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) AS k FROM bitext) WHERE k = 1 AND source_text IS NOT NULL AND target_text IS NOT NULL AND src_lang IS NOT NULL AND tgt_lang IS NOT NULL) GROUP BY batch""")
def prompt_batches(spark: SparkSession, d: str) -> DataFrame:
    """Numbered items of eight pairs a prompt."""
    from corpusloom.operators.dedup import keep_one

    cols = ["pair_id", "ingested_at", "src_lang", "tgt_lang", "source_text", "target_text"]
    rows = keep_one(table(spark, d, "bitext").select(*cols), ["pair_id"], ["ingested_at"]).dropna()
    item = (F.col("pair_id") % 8).alias("item")
    line = F.concat(F.lit("["), F.col("pair_id") % 8, F.lit("] "), "src_lang", F.lit(": "), F.replace("source_text", F.lit("\n"), F.lit(" ")), F.lit(" | "), "tgt_lang", F.lit(": "), F.replace("target_text", F.lit("\n"), F.lit(" ")))
    lines = rows.groupBy(F.floor(F.col("pair_id") / 8).alias("batch")).agg(F.array_sort(F.collect_list(F.struct(item, line.alias("l")))).alias("x"), F.count("*").alias("n"))
    return lines.select("batch", F.array_join(F.transform("x", lambda x: x["l"]), "\n").alias("block"), "n")


@query("""SELECT doc_id, [CASE WHEN doc_id % 5 = 0 THEN NULL ELSE least((doc_id % 130) / 100.0::DOUBLE, 1.0) END, NULL, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 0.5::DOUBLE END] AS clipped,
[CASE WHEN doc_id % 5 = 0 OR doc_id % 130 > 100 THEN NULL ELSE (doc_id % 130) / 100.0::DOUBLE END, NULL, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 0.5::DOUBLE END] AS strict FROM documents""")
def reply_scores(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a model in the forms it answers: with thoughts, in a fence, or not JSON at all."""
    body = F.concat(F.lit('{"results":[{"id":0,"overall_0to100":'), F.col("doc_id") % 130, F.lit('},{"id":2,"overall_0to100":50}]}'))
    n = F.col("doc_id") % 5
    reply = F.when(n == 0, "no idea {").when(n == 1, F.concat(F.lit("<think>{a} b\n</think>"), body)).when(n == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    rows = table(spark, d, "documents").select("doc_id", reply.alias("r"))
    return rows.select("doc_id", V.reply_scores(F.col("r"), 3).alias("clipped"), V.reply_scores(F.col("r"), 3, "null").alias("strict"))


@query(r"""SELECT doc_id, CASE WHEN text = '' THEN NULL WHEN length(text) <= 1000 THEN text ELSE regexp_replace(substr(text, 1, 650), '[ \t\n\f\r]+$', '') || E'\n...\n' || regexp_replace(right(text, 345), '^[ \t\n\f\r]+', '') END AS error FROM documents""")
def trimmed_errors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", V.trimmed_error(F.col("text")).alias("error"))


def _strip_sql(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


_UNLABELLED = r"regexp_replace(regexp_replace(line, '^\s*German\s*:\s*', '', 'i'), '^\s*deu_Latn\s*:\s*', '', 'i')"
_FIRST_LINE = "regexp_extract(" + _strip_sql("'German: ' || text") + r", '^([^\r\n]*)', 1)"


@query(f"SELECT doc_id, {_strip_sql(_UNLABELLED)} AS prediction FROM (SELECT doc_id, {_strip_sql(_FIRST_LINE)} AS line FROM documents)")
def clean_predictions(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("German: "), "text")
    return table(spark, d, "documents").select("doc_id", V.clean_prediction(raw, ["German", "deu_Latn"]).alias("prediction"))


@query(r"""SELECT DISTINCT source, domain, CASE WHEN token = '' THEN 'model' ELSE token END AS safe FROM (
SELECT source, domain, regexp_replace(regexp_replace(regexp_replace(regexp_extract(trim(coalesce(domain, '') || '/' || coalesce(source, '')), '([^/]*)$', 1), '[^0-9A-Za-z_.-]', '_', 'g'), '_+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS token FROM documents)""")
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.coalesce("domain", F.lit("")), F.lit("/"), F.coalesce("source", F.lit("")))
    return table(spark, d, "documents").select("source", "domain", V.safe_name(path).alias("safe")).distinct()


@query("SELECT event_id, (floor(epoch(ts))::BIGINT % 86400) AS seconds FROM events")
def clock_seconds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", V.seconds_of(F.date_format("ts", "HH:mm:ss")).cast("bigint").alias("seconds"))


#: Salts and shards of all pairs of the corpora's languages, by the standard library's BLAKE2b.
_CODES = ["eng_Latn", "deu_Latn", "fra_Latn", "spa_Latn", "por_Latn", "fin_Latn", "swe_Latn", "rus_Cyrl", "ukr_Cyrl", "ell_Grek", "zho_Hans", "arb_Arab"]


def _blake(text: str, size: int, order: str) -> int:
    return int.from_bytes(blake2b(text.encode(), digest_size=size).digest(), order)


SALTS = "salts(lang_pair, salt, shard) AS (VALUES " + ", ".join(f"('{p}', {_blake(f'42:{p}:0', 8, 'little')}::UBIGINT, {_blake(p, 16, 'big') % 16}::BIGINT)" for p in (f"{a}-{b}" for a in _CODES for b in _CODES)) + ")"


@query(f"WITH {PAIRS}, {SALTS}, salted AS (SELECT pair_id, salt, shard FROM pairs LEFT JOIN salts USING (lang_pair)), {mixed('salted', 'drawn', 'salt', 'pair_id')} SELECT pair_id, u, shard FROM drawn")
def row_uniforms(spark: SparkSession, d: str) -> DataFrame:
    """SplitMix64 uniforms and BLAKE2b shards of every pair, the same wherever the row is."""
    rows = pairs(spark, d).select("pair_id", "lang_pair")
    return rows.select("pair_id", V.splitmix_uniform(F.lit(42), "lang_pair", F.lit("0"), "pair_id").alias("u"), V.blake2b_shard("lang_pair", F.lit(16)).alias("shard"))


@query()
def standin_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The scorer contract with the stand-in model, on all pairs."""
    rows = spread(table(spark, d, "bitext")).select("pair_id", "source_text", "target_text")
    return score_pairs(rows, "source_text", "target_text", trigram_scorer, "similarity").select("pair_id", "similarity")
