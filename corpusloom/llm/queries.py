"""The queries of this package over the test tables, each over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import langid, tokens
from corpusloom.llm.capping import cap_contributors
from corpusloom.llm.cutoff import keep_fraction
from corpusloom.llm.languages import language_of, source_key
from corpusloom.llm.leaks import find_leaks
from corpusloom.llm.mixing import mixing_plan, mixing_report, mixture
from corpusloom.llm.ranking import combined_ranking
from corpusloom.llm.scores import current_scores
from corpusloom.llm.splitting import split_oversized
from corpusloom.session import spread, table
from corpusloom.storage import materialize

#: The share of all pairs that one corpus may have, in percent, and the model whose score decides what is kept.
CAP_PERCENT, CAP_MODEL = 4, "cometkiwi-da-xl"
#: The share that one language may have where languages are contributors too.
LANGUAGE_PERCENT = 10
LEAK_WINDOW, LEAK_ERRORS = 60, 2
PIECE_TOKENS, PIECE_OVERLAP = 2048, 128


# 1 ------------------------------------------------------------------------------------------------------------------
def p1_method(spark: SparkSession, d: str) -> DataFrame:
    """Best-path lengths under the unigram vocabulary of byte_bpe_50k, of every document and side of bitext."""
    return tokens.text_sides(spread(table(spark, d, "documents")), spread(table(spark, d, "bitext")), tokens.unigram_count(spark))


def p1_method_slices(spark: SparkSession, d: str) -> DataFrame:
    """Best-path lengths summed by source, language and domain."""
    return tokens.budget_by_slice(spread(table(spark, d, "documents")), table(spark, d, "lang_plan"), tokens.unigram_count(spark))


def p1_method_source_pairs(spark: SparkSession, d: str) -> DataFrame:
    return tokens.budget_by_source_pair(spread(table(spark, d, "bitext")), table(spark, d, "source_plan"), tokens.unigram_count(spark))


def p1_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.text_sides(spread(table(spark, d, "documents")), spread(table(spark, d, "bitext")), tokens.token_count())


def p1_slices(spark: SparkSession, d: str) -> DataFrame:
    return tokens.budget_by_slice(spread(table(spark, d, "documents")), table(spark, d, "lang_plan"), tokens.token_count())


def p1_source_pairs(spark: SparkSession, d: str) -> DataFrame:
    return tokens.budget_by_source_pair(spread(table(spark, d, "bitext")), table(spark, d, "source_plan"), tokens.token_count())


# 2 ------------------------------------------------------------------------------------------------------------------
def p2_ranking(spark: SparkSession, d: str) -> DataFrame:
    scores = current_scores(table(spark, d, "opus_scored"), table(spark, d, "qe_models"))
    return combined_ranking(scores, "pair_id", "qe_model", "qe_score")


# 3 ------------------------------------------------------------------------------------------------------------------
def _capped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``pair_id, contributors, score`` of each pair with ``kept``, and the caps."""
    pairs = table(spark, d, "bitext").groupBy("pair_id").agg(F.collect_set(source_key(F.col("corpus"))).alias("contributors"))
    scores = current_scores(table(spark, d, "opus_scored"), table(spark, d, "qe_models"), CAP_MODEL).select("pair_id", F.col("qe_score").alias("score"))
    records = materialize(pairs.filter("pair_id is not null").join(scores, "pair_id", "left"), "capped-pairs")
    n = records.count()  # one row a pair
    caps = records.select(F.explode("contributors").alias("contributor")).distinct().withColumn("cap", F.lit(n * CAP_PERCENT // 100).cast("bigint"))
    return records, cap_contributors(records, caps, "pair_id", "contributors", "score")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d)[1].filter("not kept").select("pair_id")


def _several(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Pairs with three contributors each, their corpus and both their languages, decided, and the caps."""
    rows = table(spark, d, "bitext").filter("pair_id is not null")
    named = lambda kind, c: F.concat(F.lit(f"{kind}:"), c)
    who = F.array_compact(F.array(named("corpus", source_key(F.col("corpus"))), named("lang", F.col("src_lang")), named("lang", F.col("tgt_lang"))))
    pairs = rows.groupBy("pair_id").agg(F.array_distinct(F.flatten(F.collect_set(who))).alias("contributors"))
    scores = current_scores(table(spark, d, "opus_scored"), table(spark, d, "qe_models"), CAP_MODEL).select("pair_id", F.col("qe_score").alias("score"))
    records = materialize(pairs.join(scores, "pair_id", "left"), "several")
    n = records.count()
    share = F.when(F.col("contributor").startswith("corpus:"), CAP_PERCENT).otherwise(LANGUAGE_PERCENT)
    caps = records.select(F.explode("contributors").alias("contributor")).distinct().withColumn("cap", F.floor(F.lit(n) * share / 100).cast("bigint"))
    return records, cap_contributors(records, caps, "pair_id", "contributors", "score")


def p3_contributors(spark: SparkSession, d: str) -> DataFrame:
    """The pairs that must go so that neither a corpus nor a language, on either side, exceeds its cap."""
    return _several(spark, d)[1].filter("not kept").select("pair_id")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of each corpus, how many are kept, and the lowest and the highest valid score among them."""
    records, decided = _capped(spark, d)
    return (
        records.join(decided, "pair_id").select(F.explode("contributors").alias("corpus"), "kept", "score").groupBy("corpus")
        .agg(F.count("*").alias("n_pairs"), F.count_if("kept").alias("n_kept"), F.min(F.when(F.col("kept"), F.col("score"))).alias("min_kept_score"), F.max(F.when(F.col("kept"), F.col("score"))).alias("max_kept_score"))
    )


# 4 ------------------------------------------------------------------------------------------------------------------
def _segments(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "bitext")
    labelled = pairs.select(F.explode(F.array(F.struct(F.col("src_lang").alias("lang"), F.col("source_text").alias("text")), F.struct(F.col("tgt_lang").alias("lang"), F.col("target_text").alias("text")))).alias("x"))
    model = langid.fit(labelled.select(language_of(F.col("x.lang")).alias("lang"), F.col("x.text").alias("text")))
    side = lambda n: F.struct(F.lit(n).alias("side"), F.col(f"lang{n}_code").alias("code"), F.col(f"lang{n}_text").alias("text"))
    sides = spread(table(spark, d, "eval_sample")).select("sample_id", F.explode(F.array(side(1), side(2))).alias("x"))
    sides = sides.select("sample_id", "x.side", "x.text", language_of(F.col("x.code")).alias("named"))
    return langid.segments(sides, model, ["sample_id", "side", "named"]).distinct()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    wrong = F.col("named").isNull() | (F.col("named") != F.col("lang"))
    return _segments(spark, d).filter(wrong).select("sample_id", "side", "segment_no", "lang").distinct()


def p4_segments(spark: SparkSession, d: str) -> DataFrame:
    return _segments(spark, d)


def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    """The language of each side: the one with most words, with the word-weighted confidence of its segments."""
    by = _segments(spark, d).groupBy("sample_id", "side", "lang").agg(F.sum("n_words").alias("n"), F.sum(F.col("n_words") * F.col("confidence")).alias("c"))
    best = by.groupBy("sample_id", "side").agg(F.max(F.struct("n", "c", "lang")).alias("b"), F.sum("n").alias("n_words"), F.count("*").alias("n_languages"))
    return best.select("sample_id", "side", F.col("b.lang").alias("lang"), (F.col("b.c") / F.col("n_words")).alias("confidence"), "n_languages", "n_words")


# 5 ------------------------------------------------------------------------------------------------------------------
def _records(spark: SparkSession, d: str) -> DataFrame:
    """Each pair of bitext once, by its latest row, with its source pair and its tokens on both sides."""
    count = tokens.token_count()
    pair = F.concat_ws("-", "src_lang", "tgt_lang")
    sized = spread(table(spark, d, "bitext")).select("pair_id", "ingested_at", pair.alias("source_pair"), count(F.col("source_text")).alias("s"), count(F.col("target_text")).alias("t"))
    latest = sized.groupBy("pair_id").agg(F.max(F.struct("ingested_at", "source_pair", (F.col("s") + F.col("t")).alias("size"))).alias("r"))
    return latest.select(F.col("r.source_pair").alias("source_pair"), F.col("pair_id").alias("record_id"), F.col("r.size").alias("size"))


def _mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing_plan(table(spark, d, "source_plan"), table(spark, d, "pair_plan"))


def p5_method(spark: SparkSession, d: str) -> DataFrame:
    """The mixed records themselves, drawn from the whole of bitext: one row per copy, shuffled over all of them."""
    return mixture(_records(spark, d), _mix(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing_report(_records(spark, d), _mix(spark, d)).filter("falls_short").select("dataset", "target_pair", "source_pair")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing_report(_records(spark, d), _mix(spark, d))


# 6 ------------------------------------------------------------------------------------------------------------------
def _kept(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    models = table(spark, d, "qe_models")
    scores = current_scores(table(spark, d, "opus_scored"), models).drop("higher_is_better")
    return keep_fraction(scores, "qe_model", "qe_score", models)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, d)[1].select("pair_id", "qe_model")


def p6_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, d)[0]


# 7 ------------------------------------------------------------------------------------------------------------------
def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(spread(table(spark, d, "documents")))


# 8 ------------------------------------------------------------------------------------------------------------------
def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(spread(table(spark, d, "documents")), table(spark, d, "eval_items"), window=LEAK_WINDOW, errors=LEAK_ERRORS)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).filter("edits = 0").select("doc_id", "item_id")


# 9 ------------------------------------------------------------------------------------------------------------------
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split_oversized(spread(table(spark, d, "documents")), limit=PIECE_TOKENS, overlap=PIECE_OVERLAP, with_text=False)
    return pieces.filter("piece_no = 2").select("doc_id")


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized(spread(table(spark, d, "documents")), limit=PIECE_TOKENS, overlap=PIECE_OVERLAP)


QUERIES = {
    f.__name__: f
    for f in (
        p1_method, p1_method_slices, p1_method_source_pairs, p1_tokens, p1_slices, p1_source_pairs, p2_ranking, p3_found, p3_contributors, p3_report, p4_found, p4_segments, p4_texts,
        p5_method, p5_found, p5_report, p6_found, p6_cutoffs, p7_ids, p8_found, p8_leaks, p9_found, p9_pieces,
    )
}

_CURRENT = r"""
latest AS (
  SELECT pair_id, m, CASE WHEN isnan(qe_score) THEN NULL ELSE qe_score END AS s,
         row_number() OVER (PARTITION BY pair_id, m ORDER BY scored_at DESC, CASE WHEN isnan(qe_score) THEN NULL ELSE qe_score END DESC NULLS LAST) AS place
  FROM (SELECT *, lower(regexp_replace(qe_model, '^\s+|\s+$', '', 'g')) AS m FROM opus_scored)),
current AS (
  SELECT l.pair_id, q.qe_model, l.s AS qe_score, q.higher_is_better, q.keep_permille
  FROM latest l JOIN qe_models q ON q.qe_model = l.m
  WHERE place = 1 AND s IS NOT NULL AND NOT isinf(s) AND s BETWEEN q.min_score AND q.max_score)"""

_KEPT = f"""WITH {_CURRENT},
sized AS (
  SELECT *, CASE WHEN higher_is_better THEN qe_score ELSE -qe_score END AS v, count(*) OVER (PARTITION BY qe_model) AS n,
         row_number() OVER (PARTITION BY qe_model ORDER BY CASE WHEN higher_is_better THEN qe_score ELSE -qe_score END DESC) AS place FROM current),
cut AS (SELECT qe_model, v AS cutoff, n, (n * keep_permille + 999) // 1000 AS k FROM sized WHERE place = (n * keep_permille + 999) // 1000)"""

_CAPPED = rf"""WITH {_CURRENT},
pairs AS (
  SELECT DISTINCT pair_id, nullif(lower(regexp_replace(corpus, '[\s\-_.]+', '', 'g')), '') AS corpus FROM bitext),
scored AS (
  SELECT p.pair_id, p.corpus, c.qe_score FROM pairs p
  LEFT JOIN (SELECT * FROM current WHERE qe_model = 'cometkiwi-da-xl') c ON c.pair_id = p.pair_id WHERE p.corpus IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY qe_score DESC NULLS LAST, pair_id) AS place,
         (SELECT count(DISTINCT pair_id) * 4 // 100 FROM bitext) AS cap FROM scored)"""

_PLAN = """WITH latest AS (
  SELECT *, row_number() OVER (PARTITION BY dataset, target_pair, source_pair ORDER BY planned_at DESC, alloc_tokens DESC NULLS LAST, total_tokens DESC NULLS LAST) AS place FROM source_plan),
targets AS (SELECT dataset, target_pair, max(max_repeat) AS max_repeat FROM pair_plan GROUP BY 1, 2)"""

ORACLE = {
    "p2_ranking": f"""WITH {_CURRENT},
vals AS (SELECT pair_id, qe_model, CASE WHEN higher_is_better THEN qe_score ELSE -qe_score END AS v FROM current),
mid AS (SELECT qe_model, quantile_disc(v, 0.5) AS middle FROM vals GROUP BY 1),
away AS (SELECT v.*, m.middle, abs(v.v - m.middle) AS d FROM vals v JOIN mid m USING (qe_model)),
spread AS (
  SELECT qe_model, CASE WHEN quantile_disc(d, 0.5) > 0 THEN quantile_disc(d, 0.5) * CAST(1.4826 AS DOUBLE) WHEN avg(d) > 0 THEN avg(d) * CAST(1.2533 AS DOUBLE) END AS s FROM away GROUP BY 1),
squashed AS (SELECT pair_id, -ln(1 + exp(-greatest(least(coalesce((v - middle) / s, 0), 30), -30))) AS p FROM away JOIN spread USING (qe_model)),
mean AS (SELECT pair_id, count(*) AS n_models, round(exp(sum(p) / count(*)), 9) AS combined FROM squashed GROUP BY 1)
SELECT pair_id, n_models, combined, rank() OVER (ORDER BY combined DESC) AS rank FROM mean""",
    "p3_found": f"{_CAPPED} SELECT pair_id FROM placed WHERE place > cap",
    "p3_report": f"""{_CAPPED} SELECT corpus, count(*) AS n_pairs, CAST(count(*) FILTER (place <= cap) AS BIGINT) AS n_kept,
min(qe_score) FILTER (place <= cap) AS min_kept_score, max(qe_score) FILTER (place <= cap) AS max_kept_score FROM placed GROUP BY 1""",
    "p5_found": f"""{_PLAN} SELECT dataset, target_pair, source_pair FROM latest JOIN targets USING (dataset, target_pair)
WHERE place = 1 AND greatest(coalesce(alloc_tokens, 0), 0) > greatest(coalesce(max_repeat, 0), 0) * greatest(coalesce(total_tokens, 0), 0)""",
    "p6_found": f"{_KEPT} SELECT pair_id, qe_model FROM sized JOIN cut USING (qe_model) WHERE v >= cutoff",
    "p6_cutoffs": f"""{_KEPT} SELECT qe_model, any_value(cut.n) AS n_records, CAST(any_value(k) AS BIGINT) AS k,
any_value(CASE WHEN higher_is_better THEN cutoff ELSE -cutoff END) AS cutoff, count(*) AS n_kept FROM sized JOIN cut USING (qe_model) WHERE v >= cutoff GROUP BY 1""",
    "p8_found": r"""WITH docs AS (SELECT doc_id, regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{N}]', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
items AS (SELECT DISTINCT item_id, regexp_replace(lower(nfc_normalize(text)), '[^\p{L}\p{N}]', '', 'g') AS t FROM eval_items WHERE text IS NOT NULL),
short AS (SELECT item_id, t FROM items WHERE length(t) BETWEEN 1 AND 59),
wi AS (SELECT DISTINCT item_id, substr(t, i, 60) AS w FROM (SELECT *, unnest(range(1, length(t) - 58)) AS i FROM items WHERE length(t) >= 60)),
wd AS (SELECT DISTINCT doc_id, substr(t, i, 60) AS w FROM (SELECT *, unnest(range(1, length(t) - 58)) AS i FROM docs WHERE length(t) >= 60))
SELECT DISTINCT doc_id, item_id FROM wd JOIN wi USING (w)
UNION SELECT doc_id, item_id FROM docs JOIN short ON contains(docs.t, short.t)""",
}
