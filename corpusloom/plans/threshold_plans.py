"""Queries on feature statistics, thresholds, filters and language re-identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import lid, stats
from corpusloom.operators import thresholds as th
from corpusloom.plans.registry import query
from corpusloom.plans.views import FEATURES, LID_PRIMES, PAIRS, features, features_sql, pairs, predictions, predictions_sql, scores, SCORES
from corpusloom.session import table
from corpusloom.storage import materialize

_LONG = f"long AS (UNPIVOT (SELECT pair_id, lang_pair, {', '.join(f'{f}::DOUBLE AS {f}' for f in FEATURES)} FROM feats) ON {', '.join(FEATURES)} INTO NAME feature VALUE value)"
_TAILS = ", ".join(f"quantile_cont(value, {p}) AS {n}" for n, p in stats.TAILS.items())
_EDA = f"""{features_sql()}, {_LONG},
eda AS (SELECT lang_pair, feature, count(value) AS count, count(*) - count(value) AS missing, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std, {_TAILS} FROM long GROUP BY 1, 2)"""


def _eda(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = materialize(features(spark, d), "features")
    return rows, stats.describe(rows, ["lang_pair"], FEATURES)


@query(f"WITH {_EDA} SELECT * FROM eda")
def eda_describe(spark: SparkSession, d: str) -> DataFrame:
    return _eda(spark, d)[1]


@query(f"WITH {_EDA} SELECT feature, count(value) AS count, count(*) - count(value) AS missing, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std FROM long GROUP BY 1")
def eda_pooled(spark: SparkSession, d: str) -> DataFrame:
    return stats.pooled(_eda(spark, d)[1])


@query(f"WITH {features_sql()} SELECT lang_pair, count(*) AS n, avg(filter_html_src::INT) AS filter_html_src_rate, avg(filter_html_trg::INT) AS filter_html_trg_rate FROM feats GROUP BY 1")
def flag_rates(spark: SparkSession, d: str) -> DataFrame:
    return stats.flag_rates(features(spark, d), ["lang_pair"], ["filter_html_src", "filter_html_trg"])


@query(f"""WITH {features_sql()}, ranked AS (SELECT lang_pair, {", ".join(f"rank() OVER (PARTITION BY lang_pair ORDER BY {f}) + (count(*) OVER (PARTITION BY lang_pair, {f}) - 1) / 2.0::DOUBLE AS r_{f}" for f in FEATURES)} FROM feats)
""" + " UNION ALL ".join(f"SELECT lang_pair, '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN stddev_pop(r_{a}) > 0 AND stddev_pop(r_{b}) > 0 THEN corr(r_{a}, r_{b}) END AS correlation FROM ranked GROUP BY 1"
                         for i, a in enumerate(FEATURES) for b in FEATURES[i:]))
def feature_spearman(spark: SparkSession, d: str) -> DataFrame:
    return stats.spearman(features(spark, d), ["lang_pair"], FEATURES)


_LOW = " ".join(f"WHEN '{f}' THEN {0.0 if a is None else a}" for f, (a, b) in th.SAFEGUARDS.items())
_HIGH = " ".join(f"WHEN '{f}' THEN {b}" for f, (a, b) in th.SAFEGUARDS.items() if b is not None) + " ELSE 'inf'::DOUBLE"
_BOUNDS = f"""{_EDA}, bounds AS (SELECT lang_pair, feature,
CASE WHEN feature NOT IN {th.UPPER_ONLY} THEN least(p001, mean - 4 * std, CASE feature {_LOW} END::DOUBLE) END AS lower,
CASE WHEN feature NOT IN {th.LOWER_ONLY} THEN greatest(p999, mean + 4 * std, CASE feature {_HIGH} END::DOUBLE) END AS upper FROM eda)"""


@query(f"WITH {_BOUNDS} SELECT * FROM bounds")
def eda_bounds(spark: SparkSession, d: str) -> DataFrame:
    return th.eda_bounds(_eda(spark, d)[1], ["lang_pair"])


_STAGE1 = f"""{_BOUNDS}, wide AS (SELECT lang_pair, {", ".join(f"max(lower) FILTER (feature = '{f}') AS {f}_lo, max(upper) FILTER (feature = '{f}') AS {f}_hi" for f in FEATURES)} FROM bounds GROUP BY 1),
kept AS (SELECT f.* FROM feats f JOIN wide w USING (lang_pair) WHERE NOT filter_html_src AND NOT filter_html_trg
AND {" AND ".join(f"coalesce({f} >= {f}_lo, true) AND coalesce({f} <= {f}_hi, true)" for f in FEATURES)})"""


def _stage1(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows, summary = _eda(spark, d)
    bounds = th.eda_bounds(summary, ["lang_pair"])
    return rows, th.within_bounds(rows, bounds, ["lang_pair"], FEATURES, ["filter_html_src", "filter_html_trg"])


@query(f"WITH {_STAGE1} SELECT pair_id, ingested_at, lang_pair, {', '.join(FEATURES)} FROM kept")
def stage1_filter(spark: SparkSession, d: str) -> DataFrame:
    """Features, adaptive bounds per language pair, and the rows within them."""
    return _stage1(spark, d)[1].select("pair_id", "ingested_at", "lang_pair", *FEATURES)


@query(f"""WITH {_STAGE1} SELECT a.lang_pair, a.n AS rows_before, coalesce(b.n, 0) AS rows_after, coalesce(b.n, 0) / a.n::DOUBLE AS kept_fraction
FROM (SELECT lang_pair, count(*) AS n FROM feats GROUP BY 1) a LEFT JOIN (SELECT lang_pair, count(*) AS n FROM kept GROUP BY 1) b USING (lang_pair)""")
def retention_by_pair(spark: SparkSession, d: str) -> DataFrame:
    return th.retention(*_stage1(spark, d), ["lang_pair"])


@query(f"""WITH {_STAGE1} SELECT a.lang_pair, a.n AS rows_before, coalesce(b.n, 0) AS rows_after, coalesce(b.n, 0) / a.n::DOUBLE AS kept_fraction
FROM (SELECT lang_pair, count(*) AS n FROM feats GROUP BY 1) a LEFT JOIN (SELECT lang_pair, count(*) AS n FROM kept GROUP BY 1) b USING (lang_pair) ORDER BY kept_fraction, lang_pair LIMIT 5""")
def worst_pairs(spark: SparkSession, d: str) -> DataFrame:
    return th.retention(*_stage1(spark, d), ["lang_pair"]).orderBy("kept_fraction", "lang_pair").limit(5)


@query(f"""WITH {_STAGE1}, r AS (SELECT a.lang_pair, a.n, coalesce(b.n, 0) AS m FROM (SELECT lang_pair, count(*) AS n FROM feats GROUP BY 1) a LEFT JOIN (SELECT lang_pair, count(*) AS n FROM kept GROUP BY 1) b USING (lang_pair))
SELECT count(*) AS n_pairs, CAST(sum(n) AS BIGINT) AS rows_before, CAST(sum(m) AS BIGINT) AS rows_after, sum(m) / sum(n)::DOUBLE AS kept_fraction, min(m / n::DOUBLE) AS min_kept, median(m / n::DOUBLE) AS median_kept, max(m / n::DOUBLE) AS max_kept FROM r""")
def retention_totals(spark: SparkSession, d: str) -> DataFrame:
    """One row over one row per language pair."""
    return _totals(th.retention(*_stage1(spark, d), ["lang_pair"]))


def _totals(kept: DataFrame) -> DataFrame:
    return kept.agg(
        F.count("*").alias("n_pairs"), F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after"), (F.sum("rows_after") / F.sum("rows_before")).alias("kept_fraction"),
        F.min("kept_fraction").alias("min_kept"), F.median("kept_fraction").alias("median_kept"), F.max("kept_fraction").alias("max_kept"),
    )


# --- score thresholds -------------------------------------------------------------------------------------------------
_Q = ", ".join(f"quantile_cont(similarity_score::DOUBLE, {p}) AS {n}" for n, p in stats.SCORE_QUANTILES.items())
_SIM = f"""{PAIRS}, sims AS (SELECT lang_pair, count(*) AS n_rows, count(similarity_score) AS n_scored, avg(similarity_score::DOUBLE) AS mean, stddev_pop(similarity_score::DOUBLE) AS std,
min(similarity_score::DOUBLE) AS min, max(similarity_score::DOUBLE) AS max, {_Q} FROM pairs GROUP BY 1)"""
_KNOTS = "[" + ", ".join("{'x': " + n + ", 'p': " + str(p) + "::DOUBLE}" for n, p in [("min", 0.0), *stats.SCORE_QUANTILES.items(), ("max", 1.0)]) + "]"


def _sims(spark: SparkSession, d: str) -> DataFrame:
    return materialize(stats.score_summary(pairs(spark, d), ["lang_pair"], "similarity_score"), "similarity")


@query(f"WITH {_SIM} SELECT * FROM sims WHERE lang_pair IS NOT NULL")
def score_quantiles(spark: SparkSession, d: str) -> DataFrame:
    return _sims(spark, d).filter("lang_pair is not null")


_DATA_T = f"{_SIM}, data_t AS (SELECT *, CASE WHEN p10 IS NOT NULL THEN least(greatest(least(least(greatest(p10, 0.3), 0.95), p50), 0.3), 0.95) END AS threshold FROM sims WHERE lang_pair IS NOT NULL)"


def _kept_sql(table_: str) -> str:
    points = ", ".join(f"('{n}', {p}::DOUBLE)" for n, p in [("min", 0.0), *stats.SCORE_QUANTILES.items(), ("max", 1.0)])
    return f"""knots AS (SELECT lang_pair, x, p, lag(x) OVER w AS x0, lag(p) OVER w AS p0 FROM (UNPIVOT (SELECT lang_pair, min, {', '.join(stats.SCORE_QUANTILES)}, max FROM {table_}) ON min, {', '.join(stats.SCORE_QUANTILES)}, max INTO NAME knot VALUE x)
JOIN (VALUES {points}) v(knot, p) USING (knot) WINDOW w AS (PARTITION BY lang_pair ORDER BY x, p)),
share AS (SELECT t.lang_pair, t.threshold, CASE WHEN t.threshold <= t.min THEN 1.0 WHEN t.threshold >= t.max THEN 0.0
ELSE (SELECT 1 - first(CASE WHEN x = x0 THEN p ELSE p0 + (p - p0) * (t.threshold - x0) / nullif(x - x0, 0) END ORDER BY x, p) FROM knots k WHERE k.lang_pair = t.lang_pair AND k.x >= t.threshold) END::DOUBLE AS kept FROM {table_} t)"""


@query(f"WITH {_DATA_T}, {_kept_sql('data_t')} SELECT lang_pair, threshold, kept FROM share")
def data_threshold(spark: SparkSession, d: str) -> DataFrame:
    found = th.data_threshold(_sims(spark, d).filter("lang_pair is not null"))
    return found.select("lang_pair", "threshold", th.kept_fraction(F.col("threshold")).alias("kept"))


#: The gold pairs are those of one hand-made corpus; the benchmark's MRR is a fixed function of the pair's name.
_GOLD = f"""{_SIM}, gold AS (SELECT lang_pair, avg(similarity_score::DOUBLE) AS gold_mean, stddev_pop(similarity_score::DOUBLE) AS gold_std, quantile_cont(similarity_score::DOUBLE, 0.01) AS gold_p01,
quantile_cont(similarity_score::DOUBLE, 0.25) AS gold_p25 FROM pairs WHERE corpus = 'NewsPairs' AND similarity_score IS NOT NULL GROUP BY 1),
joined AS (SELECT s.*, g.* EXCLUDE (lang_pair), CASE WHEN ascii(s.lang_pair) % 5 > 0 THEN 0.70 + (ascii(s.lang_pair) + ascii(substr(s.lang_pair, 10, 1))) % 30 / 100.0::DOUBLE END AS mrr FROM sims s LEFT JOIN gold g USING (lang_pair) WHERE s.lang_pair IS NOT NULL),
tiers AS (SELECT *, CASE WHEN mrr IS NULL THEN 'no_benchmark' WHEN mrr >= 0.95 THEN 'high' WHEN mrr >= 0.8 THEN 'mid' ELSE 'low' END AS confidence FROM joined),
raws AS (SELECT *, CASE WHEN confidence IN ('low', 'no_benchmark') THEN p01 WHEN gold_mean IS NOT NULL THEN greatest(greatest(gold_p01, gold_mean - 2 * gold_std) - CASE WHEN confidence = 'mid' THEN 0.02 ELSE 0 END, p10) ELSE p10 END AS raw_threshold FROM tiers)"""


def _gold(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).filter("corpus = 'NewsPairs' and similarity_score is not null and lang_pair is not null")
    gold = stats.score_summary(rows, ["lang_pair"], "similarity_score")
    gold = gold.select("lang_pair", F.col("mean").alias("gold_mean"), F.col("std").alias("gold_std"), F.col("p01").alias("gold_p01"), F.col("p25").alias("gold_p25"))
    a, b = F.ascii("lang_pair"), F.ascii(F.substring("lang_pair", 10, 1))
    mrr = F.when(a % 5 > 0, 0.70 + (a + b) % 30 / 100.0)
    return th.gold_threshold(_sims(spark, d).filter("lang_pair is not null").join(gold, "lang_pair", "left").withColumn("mrr", mrr))


@query(f"""WITH {_GOLD} SELECT lang_pair, confidence, raw_threshold, CASE WHEN p10 IS NOT NULL THEN least(least(greatest(raw_threshold, 0.3),
greatest(CASE WHEN gold_mean IS NOT NULL THEN least(0.95, gold_p25) ELSE 0.95 END, 0.3)), p50) END::DOUBLE AS threshold FROM raws""")
def gold_threshold(spark: SparkSession, d: str) -> DataFrame:
    return _gold(spark, d).select("lang_pair", "confidence", "raw_threshold", "threshold")


@query(f"WITH {_DATA_T} SELECT pair_id, ingested_at, lang_pair FROM pairs JOIN data_t USING (lang_pair) WHERE similarity_score IS NOT NULL AND similarity_score::DOUBLE >= threshold")
def threshold_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).select("pair_id", "ingested_at", "lang_pair", F.col("similarity_score").cast("double").alias("s"))
    found = th.data_threshold(_sims(spark, d).filter("lang_pair is not null"))
    return th.above_threshold(rows, found, ["lang_pair"], "s").drop("s")


@query(f"""WITH {_SIM} SELECT lang_pair, (SELECT first(CASE WHEN p = p0 THEN x0 ELSE x0 + (x - x0) * (0.15 - p0) / (p - p0) END ORDER BY p) FROM (
SELECT lag(u.x) OVER (ORDER BY u.p) AS x0, lag(u.p) OVER (ORDER BY u.p) AS p0, u.x, u.p FROM (SELECT unnest({_KNOTS}) AS u)) WHERE p >= 0.15) AS keep_85 FROM sims WHERE lang_pair IS NOT NULL""")
def keep_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """The score that keeps an estimated 85 % of each pair."""
    return _sims(spark, d).filter("lang_pair is not null").select("lang_pair", th.threshold_keeping(0.85).alias("keep_85"))


_BOTH = f"{SCORES}, both_scores AS (SELECT a.pair_id, a.qe_score AS a, b.qe_score / 100 AS b, a.direction_key FROM scores a JOIN scores b USING (pair_id) WHERE a.qe_model = 'cometkiwi-da-xl' AND b.qe_model = 'llm-offline')"


@query(f"""WITH {_BOTH}, diffs AS (SELECT *, a - b AS d FROM both_scores WHERE a IS NOT NULL AND b IS NOT NULL)
SELECT direction_key, count(*) AS n, CASE WHEN count(*) > 1 AND stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN corr(a, b) END AS pearson, avg(d) AS mean_diff, stddev_pop(d) AS std_diff, avg((abs(d) <= 0.05)::INT) AS share_close, median(d) AS median_diff FROM diffs GROUP BY 1""")
def score_agreement(spark: SparkSession, d: str) -> DataFrame:
    rows = scores(spark, d)
    a = rows.filter("qe_model = 'cometkiwi-da-xl'").select("pair_id", "direction_key", F.col("qe_score").alias("a"))
    b = rows.filter("qe_model = 'llm-offline'").select("pair_id", (F.col("qe_score") / 100).alias("b"))
    out = stats.agreement(materialize(a.join(b, "pair_id"), "both"), ["direction_key"], "a", "b")
    moments = out.withColumn("pearson", F.when(F.col("n") > 1, F.nanvl("pearson", F.lit(None).cast("double"))))
    return moments


@query(f"""WITH {SCORES} SELECT direction_key, least(greatest(floor(qe_score * 20), 0), 19)::INT AS bin, count(*) AS n FROM scores WHERE qe_model = 'cometkiwi-da-xl' AND qe_score IS NOT NULL GROUP BY 1, 2""")
def score_histogram(spark: SparkSession, d: str) -> DataFrame:
    return stats.histogram(scores(spark, d).filter("qe_model = 'cometkiwi-da-xl'"), ["direction_key"], "qe_score", 20)


# --- language re-identification ---------------------------------------------------------------------------------------
_PREDS = predictions_sql()
_CONF = f"""{_PREDS}, confs AS ({" UNION ALL ".join(f"SELECT '{m}' AS model, {s}_id_{m} AS lang, {s}_conf_{m} AS c FROM preds" for m, s in LID_PRIMES)}),
thr AS (SELECT model, lang, count(*) AS n, coalesce(stddev_samp(c), 0) AS std, median(c) AS median, greatest(0.3, least(0.9, median(c) - coalesce(stddev_samp(c), 0))) AS threshold FROM confs WHERE lang IS NOT NULL GROUP BY 1, 2)"""


def _confidences(spark: SparkSession, d: str) -> DataFrame:
    preds = predictions(spark, d)
    each = [F.struct(F.lit(m).alias("model"), F.col(f"{s}_id_{m}").alias("lang"), F.col(f"{s}_conf_{m}").alias("c")) for m, s in LID_PRIMES]
    return preds.select(F.explode(F.array(*each)).alias("x")).select("x.*").filter("lang is not null")


@query(f"WITH {_CONF} SELECT lang, count(*) AS n, sum(c) AS total, sum(c * c) AS squares, min(c) AS min, max(c) AS max FROM confs WHERE lang IS NOT NULL GROUP BY 1")
def confidence_moments(spark: SparkSession, d: str) -> DataFrame:
    return stats.confidence_moments(_confidences(spark, d), "lang", "c")


def _thresholds(spark: SparkSession, d: str) -> DataFrame:
    return materialize(lid.confidence_thresholds(_confidences(spark, d), ["model", "lang"], "c"), "lid")


@query(f"WITH {_CONF} SELECT model, lang, n, std, median, threshold FROM thr")
def confidence_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return _thresholds(spark, d)


_RELID = "SELECT pair_id, ingested_at, " + ", ".join(
    f"CASE WHEN {s}_conf_glotlid > coalesce(g{s}.threshold, 'inf'::DOUBLE) AND {s}_conf_conlid > coalesce(c{s}.threshold, 'inf'::DOUBLE) AND {s}_id_glotlid = {s}_id_conlid THEN {s}_id_glotlid ELSE {s}_lang END AS new_{s}" for s in ("src", "tgt")
) + " FROM preds " + " ".join(f"LEFT JOIN (SELECT * FROM thr WHERE model = '{m}') {a}{s} ON {a}{s}.lang = {s}_id_{m}" for s in ("src", "tgt") for m, a in (("glotlid", "g"), ("conlid", "c")))


def _relid(spark: SparkSession, d: str) -> DataFrame:
    rows, found = predictions(spark, d), _thresholds(spark, d)
    for s in ("src", "tgt"):
        rows = lid.agreed_language(rows, found, f"{s}_lang", {m: (f"{s}_id_{m}", f"{s}_conf_{m}") for m in ("glotlid", "conlid")}, f"new_{s}")
    return rows


@query(f"WITH {_CONF} {_RELID}")
def relid_ensemble(spark: SparkSession, d: str) -> DataFrame:
    return _relid(spark, d).select("pair_id", "ingested_at", "new_src", "new_tgt")


@query(f"WITH {_PREDS} SELECT pair_id, ingested_at FROM preds WHERE src_lang = src_id_glotlid AND src_conf_glotlid >= 0.5 AND tgt_lang = tgt_id_glotlid AND tgt_conf_glotlid >= 0.5")
def lid_agreement_filter(spark: SparkSession, d: str) -> DataFrame:
    sides = [(f"{s}_lang", f"{s}_id_glotlid", f"{s}_conf_glotlid") for s in ("src", "tgt")]
    return lid.agreeing(predictions(spark, d), sides, 0.5).select("pair_id", "ingested_at")


@query(f"""WITH {PAIRS} SELECT pair_id, ingested_at, CASE WHEN count(*) OVER (PARTITION BY lang_pair) < 80 THEN '_mixed' ELSE lang_pair END AS route FROM pairs""")
def small_pair_route(spark: SparkSession, d: str) -> DataFrame:
    return lid.route_small(pairs(spark, d), "lang_pair", 80).select("pair_id", "ingested_at", "route")


_TIERS = {"eng_Latn": "high", "deu_Latn": "high", "fra_Latn": "high", "spa_Latn": "high", "rus_Cyrl": "mid", "por_Latn": "mid", "zho_Hans": "mid", "arb_Arab": "mid"}


@query(f"""WITH {PAIRS}, tiers(lang, tier) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _TIERS.items())})
SELECT coalesce(a.tier, 'low') AS src_tier, coalesce(b.tier, 'low') AS tgt_tier, count(*) AS rows_before, count(*) FILTER (similarity_score >= 0.7) AS rows_after, count(*) FILTER (similarity_score >= 0.7) / count(*)::DOUBLE AS rate
FROM pairs LEFT JOIN tiers a ON src_lang = a.lang LEFT JOIN tiers b ON tgt_lang = b.lang GROUP BY 1, 2""")
def tier_retention(spark: SparkSession, d: str) -> DataFrame:
    tier = lambda c: F.coalesce(F.create_map(*[F.lit(x) for kv in _TIERS.items() for x in kv])[F.col(c)], F.lit("low"))
    kept = F.count_if(F.col("similarity_score") >= F.lit(0.7).cast("float"))
    return table(spark, d, "bitext").groupBy(tier("src_lang").alias("src_tier"), tier("tgt_lang").alias("tgt_tier")).agg(F.count("*").alias("rows_before"), kept.alias("rows_after"), (kept / F.count("*")).alias("rate"))
