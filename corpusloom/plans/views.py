"""Views that several queries share, as DataFrames and as the same in SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.tracking import last_event
from corpusloom.session import spread, table

#: White space of the patterns, for SQL.
WS = T.SPACE

PAIRS = "pairs AS (SELECT *, src_lang || '-' || tgt_lang AS lang_pair FROM bitext)"


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bitext").withColumn("lang_pair", F.concat("src_lang", F.lit("-"), "tgt_lang"))


#: All that rows are filtered by.
FEATURES = [
    "src_char_len", "trg_char_len", "char_len_ratio", "src_word_len", "trg_word_len", "word_len_ratio", "score_term_punct", "score_numerals", "score_lcs_ratio", "score_levenshtein",
    "score_repeat_src", "score_repeat_trg", "src_max_word_len", "trg_max_word_len", "src_avg_word_len", "trg_avg_word_len",
]


def features(spark: SparkSession, d: str) -> DataFrame:
    """The features of all pairs with both texts; the expensive part is redistributed if the scan is small."""
    rows = spread(pairs(spark, d).filter("source_text is not null and target_text is not null and lang_pair is not null"))
    s, t = F.col("source_text"), F.col("target_text")
    sides = {"src": (s, F.split_part("lang_pair", F.lit("-"), F.lit(1))), "trg": (t, F.split_part("lang_pair", F.lit("-"), F.lit(2)))}
    stats = {x: T.word_stats(text, lang, "fixed") for x, (text, lang) in sides.items()}
    rows = rows.select("pair_id", "ingested_at", "lang_pair", "source_text", "target_text", F.length(s).alias("src_char_len"), F.length(t).alias("trg_char_len"),
                       F.size(T.words(s)).alias("src_word_len"), F.size(T.words(t)).alias("trg_word_len"))
    return rows.select(
        "*", T.length_ratio(F.col("src_char_len"), F.col("trg_char_len"), "fixed").alias("char_len_ratio"), T.length_ratio(F.col("src_word_len"), F.col("trg_word_len"), "fixed").alias("word_len_ratio"),
        T.terminal_punctuation_score(s, t).alias("score_term_punct"), T.numeral_score(s, t).alias("score_numerals"), T.lcs_ratio(s, t).alias("score_lcs_ratio"), T.levenshtein_similarity(s, t).alias("score_levenshtein"),
        T.repetition_score(s).alias("score_repeat_src"), T.repetition_score(t).alias("score_repeat_trg"),
        *[stats[x][f"{k}_word_len"].alias(f"{x}_{k}_word_len") for k in ("max", "avg") for x in sides],
        T.html_flag(s).alias("filter_html_src"), T.html_flag(t).alias("filter_html_trg"),
    ).drop("source_text", "target_text")


def chars_sql(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: substr({text}, i, 1))"


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence of two lists of characters, row by row."""
    row = f"list_transform({b}, lambda x, k: greatest(row[k + 1], row[k] + (x = ch)::INT))"
    return f"list_reduce({a}, lambda row, ch: list_reduce({row}, lambda done, v: list_append(done, greatest(v, done[-1])), [0]), list_transform(range(0, len({b}) + 1), lambda x: 0))[-1]"


def edits_sql(a: str, b: str) -> str:
    row = f"list_transform({b}, lambda x, k: least(row[k + 1] + 1, row[k] + (x <> ch)::INT))"
    return f"list_reduce({a}, lambda row, ch: list_reduce({row}, lambda done, v: list_append(done, least(v, done[-1] + 1)), [row[1] + 1]), range(0, len({b}) + 1))[-1]"


_DIGITS = [chr(i) for i in range(0x80, 0x20000) if unicodedata.category(chr(i)) == "Nd"]


def digits_sql(text: str) -> str:
    """The digits but zeros of a text as ASCII."""
    found = f"coalesce(list_aggregate(regexp_extract_all({text}, '\\p{{Nd}}'), 'string_agg', ''), '')"
    return f"replace(translate({found}, '{''.join(_DIGITS)}', '{''.join(str(unicodedata.digit(c)) for c in _DIGITS)}'), '0', '')"


def numerals_sql(ds: str, dt: str) -> str:
    """Of two strings of digits."""
    return f"CASE WHEN {ds} = '' OR {dt} = '' THEN ({ds} = {dt})::INT::DOUBLE ELSE 2.0::DOUBLE * {lcs_sql(chars_sql(ds), chars_sql(dt))} / (length({ds}) + length({dt})) END"


def repeats_sql(text: str) -> str:
    """Repeats of the first three characters that follow themselves, spaces between them or not, at least twice."""
    seg = f"substr({text}, i, 3)"
    run = f"regexp_extract(substr({text}, i + 3), '^(?: *' || regexp_escape({seg}) || '){{2,}}')"
    usable = f"length({seg}) = 3 AND NOT regexp_matches({seg}, '^[{WS}]') AND NOT contains({seg}, chr(10)) AND contains(substr({text}, i + 3), {seg})"
    count = f"CASE WHEN {usable} THEN len(regexp_extract_all({run}, regexp_escape({seg}))) ELSE 0 END"
    return f"coalesce(list_filter(list_transform(range(1, length({text}) + 1), lambda i: {count}), lambda n: n > 0)[1], 0)"


_DENSE = "coalesce(regexp_matches({0}, '_({1})$'), false)".format("{0}", "|".join(T.NO_SPACE_SCRIPTS))


def word_sql(text: str, lang: str, name: str, mode: str) -> str:
    words, dense = f"string_split_regex({text}, '[{WS}]+')", _DENSE.format(lang)
    total = f"list_sum(list_transform({words}, lambda w: length(w)))"
    avg = f"floor({total} / len({words}))" if mode == "compat" else f"{total} / len({words})"
    return f"""CASE WHEN {text} IS NULL THEN NULL WHEN {dense} THEN length({text}) ELSE len({words}) END AS {name}_word_len,
CASE WHEN {text} IS NULL THEN NULL WHEN {dense} THEN 1 ELSE list_max(list_transform({words}, lambda w: length(w))) END AS {name}_max_word_len,
CASE WHEN {text} IS NULL THEN NULL WHEN {dense} THEN 1.0 ELSE {avg} END AS {name}_avg_word_len"""


def alignments_sql(rows: str) -> str:
    """``aligned``: numerals, subsequence, edit similarity and repeats of every distinct pair of texts of ``rows``."""
    return f"""texts AS MATERIALIZED (SELECT source_text AS a_s, target_text AS a_t, {chars_sql('source_text')} AS cs, {chars_sql('target_text')} AS ct, {digits_sql('source_text')} AS ds, {digits_sql('target_text')} AS dt
  FROM (SELECT DISTINCT source_text, target_text FROM {rows} WHERE source_text IS NOT NULL AND target_text IS NOT NULL)),
aligned AS MATERIALIZED (SELECT a_s, a_t, ds <> '' OR dt <> '' OR regexp_matches(a_s || a_t, '\\p{{Nd}}') AS has_digits,
  CASE WHEN a_s = '' OR a_t = '' THEN 0.0::DOUBLE ELSE {numerals_sql('ds', 'dt')} END AS score_numerals,
  CASE WHEN a_s = '' OR a_t = '' THEN 0.0::DOUBLE ELSE {lcs_sql('cs', 'ct')}::DOUBLE / least(len(cs), len(ct)) END AS score_lcs_ratio,
  CASE WHEN a_s = '' AND a_t = '' THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - {edits_sql('cs', 'ct')}::DOUBLE / greatest(len(cs), len(ct), 1) END AS score_levenshtein,
  {repeats_sql('a_s')} AS score_repeat_src, {repeats_sql('a_t')} AS score_repeat_trg FROM texts)"""


def features_sql() -> str:
    marks = lambda c: f"(length({c}) - length(regexp_replace({c}, '{T.terminal_class()}', '', 'g')))"
    s, t = marks("source_text"), marks("target_text")
    return rf"""{PAIRS},
lengths AS (SELECT pair_id, ingested_at, lang_pair, source_text, target_text, length(source_text) AS src_char_len, length(target_text) AS trg_char_len,
  len(string_split_regex(source_text, '[{WS}]+')) AS src_word_len, len(string_split_regex(target_text, '[{WS}]+')) AS trg_word_len,
  {word_sql('source_text', "split_part(lang_pair, '-', 1)", 'w_src', 'fixed')}, {word_sql('target_text', "split_part(lang_pair, '-', 2)", 'w_trg', 'fixed')}
  FROM pairs WHERE source_text IS NOT NULL AND target_text IS NOT NULL AND lang_pair IS NOT NULL),
{alignments_sql('lengths')},
feats AS MATERIALIZED (SELECT l.*, w_src_max_word_len AS src_max_word_len, w_trg_max_word_len AS trg_max_word_len, w_src_avg_word_len AS src_avg_word_len, w_trg_avg_word_len AS trg_avg_word_len,
  score_numerals, score_lcs_ratio, score_levenshtein, score_repeat_src, score_repeat_trg,
  greatest(src_char_len, trg_char_len)::DOUBLE / greatest(least(src_char_len, trg_char_len), 1) AS char_len_ratio,
  greatest(src_word_len, trg_word_len)::DOUBLE / greatest(least(src_word_len, trg_word_len), 1) AS word_len_ratio,
  CASE WHEN source_text = '' OR target_text = '' THEN -20.0::DOUBLE ELSE -ln((abs({s} - {t}) + greatest({s} - 1, 0) + greatest({t} - 1, 0) + 1)::DOUBLE) END AS score_term_punct,
  regexp_matches(source_text, '<[a-zA-Z][^>]*>') AS filter_html_src, regexp_matches(target_text, '<[a-zA-Z][^>]*>') AS filter_html_trg
  FROM lengths l JOIN aligned a ON a.a_s = l.source_text AND a.a_t = l.target_text)"""


def model_name(name):
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def scores(spark: SparkSession, d: str) -> DataFrame:
    """The latest run of every pair and model with its direction; NaN and infinite scores are null."""
    raw = table(spark, d, "opus_scored").withColumn("qe_model", model_name(F.col("qe_model")))
    raw = raw.withColumn("qe_score", F.when(~F.isnan("qe_score") & (F.abs("qe_score") < float("inf")), F.col("qe_score")))
    cols = ["pair_id", "qe_model", "scored_at", "qe_score", "direction_key", "qe_src_seen", "qe_tgt_seen", "shard_id", "worker_id"]
    return last_event(raw.select(*cols), ["pair_id", "qe_model"], ["scored_at"])


SCORES = r"""runs AS (SELECT pair_id, lower(trim(regexp_replace(qe_model, '\s+', ' ', 'g'))) AS qe_model, scored_at,
  CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END AS qe_score, direction_key, qe_src_seen, qe_tgt_seen, shard_id, worker_id FROM opus_scored),
scores AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY pair_id, qe_model ORDER BY scored_at DESC, qe_score DESC NULLS LAST,
  direction_key DESC NULLS LAST, qe_src_seen DESC NULLS LAST, qe_tgt_seen DESC NULLS LAST) AS place FROM runs) WHERE place = 1)"""

MODELS = ["cometkiwi-da-xl", "llm-offline", "metricx24", "remedy-9b", "xcomet-xl"]
TRUE = "('true', 't', '1', 'yes', 'y', 'supported', 'covered')"
FALSE = "('false', 'f', '0', 'no', 'n', 'unsupported', 'uncovered')"


def truth_sql(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN {TRUE} THEN true WHEN lower(trim({column})) IN {FALSE} THEN false END"


#: Stand-in predictions of two language models for both sides of a pair: mostly right, with fixed confidences.
LID_PRIMES = {("glotlid", "src"): 7919, ("glotlid", "tgt"): 104729, ("conlid", "src"): 1299709, ("conlid", "tgt"): 15485863}


def with_predictions(rows: DataFrame) -> DataFrame:
    for (model, side), k in LID_PRIMES.items():
        n = F.col("pair_id") * k
        label = F.when((n % 11 == 0) | (F.lit(model == "conlid") & (n % 13 == 0)), "deu_Latn").otherwise(F.col(f"{side}_lang"))
        rows = rows.withColumn(f"{side}_id_{model}", label).withColumn(f"{side}_conf_{model}", (n % 1000) / F.lit(1000.0))
    return rows


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return with_predictions(pairs(spark, d).select("pair_id", "ingested_at", "lang_pair", "src_lang", "tgt_lang"))


def predictions_sql() -> str:
    parts = []
    for (model, side), k in LID_PRIMES.items():
        wrong = f"(pair_id * {k}) % 11 = 0" + (f" OR (pair_id * {k}) % 13 = 0" if model == "conlid" else "")
        parts += [f"CASE WHEN {wrong} THEN 'deu_Latn' ELSE {side}_lang END AS {side}_id_{model}", f"((pair_id * {k}) % 1000) / 1000.0::DOUBLE AS {side}_conf_{model}"]
    return f"{PAIRS}, preds AS (SELECT pair_id, ingested_at, lang_pair, src_lang, tgt_lang, {', '.join(parts)} FROM pairs)"
