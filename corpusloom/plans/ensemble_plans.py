"""Queries on scores of several models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.values import truth
from corpusloom.operators import ensemble as en
from corpusloom.operators import retrieval
from corpusloom.operators.scoring import lookup_winner, seen_flags
from corpusloom.plans.registry import query
from corpusloom.plans.views import MODELS, PAIRS, SCORES, pairs, scores, truth_sql
from corpusloom.session import table
from corpusloom.storage import materialize

_S, _T = truth_sql("qe_src_seen"), truth_sql("qe_tgt_seen")
TAUS = [0.6, 0.7, 0.8, 0.9]


@query(f"""WITH {SCORES}, filled AS (SELECT pair_id, qe_model, coalesce(qe_score, 0) AS qe_score FROM scores)
SELECT *, (qe_score - avg(qe_score) OVER w) / nullif(stddev_samp(qe_score) OVER w, 0) AS z_score, percent_rank() OVER (PARTITION BY qe_model ORDER BY qe_score) AS percent_rank FROM filled WINDOW w AS (PARTITION BY qe_model)""")
def zscore_percent_rank(spark: SparkSession, d: str) -> DataFrame:
    return en.normalised(materialize(scores(spark, d).select("pair_id", "qe_model", "qe_score"), "scores"), "qe_model", "qe_score")


_SUMMARY = f"""{SCORES}, summary AS (SELECT qe_model, direction_key, count(*) AS n_rows, count(qe_score) AS n_scored, avg(qe_score) AS mean, min(qe_score) AS min, max(qe_score) AS max, bool_or({_S}) AS src_seen, bool_or({_T}) AS tgt_seen FROM scores GROUP BY 1, 2)"""


@query(f"WITH {_SUMMARY} SELECT * FROM summary")
def direction_summary(spark: SparkSession, d: str) -> DataFrame:
    return en.direction_summary(scores(spark, d), "qe_model", "direction_key", "qe_score")


@query(f"""WITH {_SUMMARY} SELECT 'summary' AS row_type, qe_model, direction_key, NULL AS pair_id, mean AS qe_score FROM summary
UNION ALL SELECT 'detail', qe_model, direction_key, pair_id, qe_score FROM scores""")
def detail_and_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(scores(spark, d), "scores")
    top = en.direction_summary(rows, "qe_model", "direction_key", "qe_score").select(F.lit("summary").alias("row_type"), "qe_model", "direction_key", F.lit(None).cast("bigint").alias("pair_id"), F.col("mean").alias("qe_score"))
    return top.unionByName(rows.select(F.lit("detail").alias("row_type"), "qe_model", "direction_key", "pair_id", "qe_score"))


@query(f"""WITH {SCORES} SELECT qe_model, count(*) AS n_rows, count(*) FILTER (qe_score IS NULL) AS null_scores, count(DISTINCT direction_key) AS directions,
count(DISTINCT CASE WHEN qe_score IS NULL THEN direction_key END) AS directions_with_nulls FROM scores GROUP BY 1""")
def score_validation(spark: SparkSession, d: str) -> DataFrame:
    small = scores(spark, d).groupBy("qe_model", "direction_key").agg(F.count("*").alias("n"), F.count_if(F.col("qe_score").isNull()).alias("missing"))
    return small.groupBy("qe_model").agg(
        F.sum("n").alias("n_rows"), F.sum("missing").alias("null_scores"), F.count("direction_key").alias("directions"),
        F.count(F.when(F.col("missing") > 0, F.col("direction_key"))).alias("directions_with_nulls"),
    )


def _safe(m: str) -> str:
    return m.replace("-", "_").replace(".", "_")


@query(f"WITH {SCORES} SELECT pair_id, " + ", ".join(
    f"max(qe_score) FILTER (qe_model = '{m}') AS {_safe(m)}_score, max(CASE WHEN coalesce({_S}, false) AND coalesce({_T}, false) THEN 1 ELSE 0 END) FILTER (qe_model = '{m}') AS {_safe(m)}_both_seen" for m in MODELS
) + " FROM scores GROUP BY 1")
def wide_scores(spark: SparkSession, d: str) -> DataFrame:
    return en.wide(scores(spark, d), ["pair_id"], "qe_model", "qe_score", MODELS)


@query(f"""WITH {SCORES}, seen AS (SELECT *, coalesce(({_S}) AND ({_T}), false) AS both_seen FROM scores)
SELECT pair_id, count(qe_score) AS n_models, avg(qe_score) AS ens_mean_all, median(qe_score) AS ens_median_all, count(qe_score) FILTER (both_seen) AS n_models_seen, avg(qe_score) FILTER (both_seen) AS ens_mean_seen, median(qe_score) FILTER (both_seen) AS ens_median_seen FROM seen GROUP BY 1""")
def ensemble_mean_median(spark: SparkSession, d: str) -> DataFrame:
    return en.mean_median(scores(spark, d), ["pair_id"], "qe_score")


_WEIGHTS = f"{_SUMMARY}, macro AS (SELECT qe_model, avg(mean) AS macro_mean FROM summary GROUP BY 1), weights AS (SELECT qe_model, macro_mean, macro_mean / (SELECT sum(macro_mean) FROM macro) AS weight FROM macro)"


@query(f"WITH {_WEIGHTS} SELECT * FROM weights")
def model_weights(spark: SparkSession, d: str) -> DataFrame:
    return en.model_weights(en.direction_summary(scores(spark, d), "qe_model", "direction_key", "qe_score"), "qe_model")


_FLAGS = {"both_seen": "both_seen", "src_seen": "s", "tgt_seen": "t", "both_unseen": "NOT s AND NOT t"}


@query(f"""WITH {_WEIGHTS}, x AS (SELECT r.pair_id, r.qe_score, w.weight, coalesce(({_S.replace('qe_src', 'r.qe_src')}) AND ({_T.replace('qe_tgt', 'r.qe_tgt')}), false) AS both_seen, coalesce(m.src_seen, false) AS s, coalesce(m.tgt_seen, false) AS t
FROM scores r JOIN weights w USING (qe_model) JOIN summary m ON m.qe_model = r.qe_model AND m.direction_key IS NOT DISTINCT FROM r.direction_key)
SELECT pair_id, CASE WHEN count(qe_score) = 5 THEN sum(weight * qe_score) END AS ens_wavg_all, """ + ", ".join(
    f"CASE WHEN count(*) FILTER ({c}) = count(qe_score) FILTER ({c}) THEN sum(weight * qe_score) FILTER ({c}) / nullif(sum(weight) FILTER ({c}), 0) END AS ens_wavg_{n}, count(*) FILTER ({c}) AS n_{n}" for n, c in _FLAGS.items()
) + " FROM x GROUP BY 1")
def weighted_ensemble(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(scores(spark, d), "scores")
    summary = materialize(en.direction_summary(rows, "qe_model", "direction_key", "qe_score"), "summary")
    return en.weighted(rows, summary, en.model_weights(summary, "qe_model"), ["pair_id"], "qe_model", "direction_key", "qe_score", len(MODELS))


@query(f"WITH {_SUMMARY} SELECT direction_key, " + ", ".join(f"max(src_seen::INT) FILTER (qe_model = '{m}') AS {_safe(m)}_src_seen, max(tgt_seen::INT) FILTER (qe_model = '{m}') AS {_safe(m)}_tgt_seen" for m in MODELS) + " FROM summary GROUP BY 1")
def direction_flags(spark: SparkSession, d: str) -> DataFrame:
    summary = en.direction_summary(scores(spark, d), "qe_model", "direction_key", "qe_score")
    pick = lambda m, c: F.max(F.when(F.col("qe_model") == m, F.col(c).cast("int"))).alias(f"{_safe(m)}_{c}")
    return summary.groupBy("direction_key").agg(*[pick(m, c) for m in MODELS for c in ("src_seen", "tgt_seen")])


_COVERED = f"""{SCORES}, covered AS (SELECT qe_model, direction_key, split_part(direction_key, '-', 1) AS src_lang, split_part(direction_key, '-', 2) AS tgt_lang, qe_score,
coalesce({_S}, false) AS s, coalesce({_T}, false) AS t FROM scores WHERE direction_key <> '' AND direction_key LIKE '%-%'),
grouped AS (SELECT *, CASE WHEN s AND t THEN 'both-covered' WHEN s OR t THEN 'one-covered' ELSE 'both-uncovered' END AS coverage_status,
CASE WHEN lower(split_part(src_lang, '_', 1)) IN ('eng', 'en') OR lower(split_part(tgt_lang, '_', 1)) IN ('eng', 'en') THEN 'english-centric' ELSE 'non-english-centric' END AS english_centric_status FROM covered)"""


def _scale_sql(n: str) -> str:
    return f"""count(DISTINCT qe_model) AS models_scored, count(DISTINCT direction_key) AS directions_scored, count(DISTINCT qe_model || '|' || direction_key) AS model_direction_pairs_scored, {n} AS sentence_pairs_scored,
count(DISTINCT src_lang) AS source_langs, count(DISTINCT tgt_lang) AS target_langs, count(qe_score) AS non_null_scores, {n} - count(qe_score) AS null_scores, """ + ", ".join(
        f"count(*) FILTER (qe_score >= {t}) AS retained_{en.tau_name(t)}, round(100.0::DOUBLE * count(*) FILTER (qe_score >= {t}) / nullif({n}, 0), 4) AS retained_{en.tau_name(t)}_pct" for t in TAUS)


def _covered(spark: SparkSession, d: str) -> DataFrame:
    rows = scores(spark, d).filter("direction_key <> '' and direction_key like '%-%'")
    rows = rows.withColumn("src_lang", F.split_part("direction_key", F.lit("-"), F.lit(1))).withColumn("tgt_lang", F.split_part("direction_key", F.lit("-"), F.lit(2)))
    return rows.withColumn("coverage_status", en.coverage(truth(F.col("qe_src_seen")), truth(F.col("qe_tgt_seen")))).withColumn("english_centric_status", en.english_centric(F.col("src_lang"), F.col("tgt_lang")))


@query(f"WITH {_COVERED} SELECT {_scale_sql('count(*)')} FROM grouped")
def scale_summary(spark: SparkSession, d: str) -> DataFrame:
    return en.scale(en.per_direction(_covered(spark, d), [], TAUS), [], TAUS)


@query(f"WITH {_COVERED} SELECT qe_model, {_scale_sql('count(*)').replace('count(DISTINCT qe_model) AS models_scored, ', '')} FROM grouped GROUP BY 1")
def retention_at_tau(spark: SparkSession, d: str) -> DataFrame:
    return en.scale(en.per_direction(_covered(spark, d), [], TAUS), ["qe_model"], TAUS).drop("models_scored")


def _categories_sql(category: str, names: list[str]) -> str:
    return f"""WITH {_COVERED}, categories({category}, sort_order) AS (VALUES {", ".join(f"('{n}', {i})" for i, n in enumerate(names, 1))})
SELECT {category}, sort_order, {_scale_sql("count(direction_key)")} FROM categories LEFT JOIN grouped USING ({category}) GROUP BY 1, 2"""


@query(_categories_sql("coverage_status", ["both-covered", "one-covered", "both-uncovered", "no-model"]))
def coverage_groups(spark: SparkSession, d: str) -> DataFrame:
    return en.by_category(_covered(spark, d), "coverage_status", ["both-covered", "one-covered", "both-uncovered", "no-model"], TAUS)


@query(_categories_sql("english_centric_status", ["english-centric", "non-english-centric"]))
def english_centric(spark: SparkSession, d: str) -> DataFrame:
    return en.by_category(_covered(spark, d), "english_centric_status", ["english-centric", "non-english-centric"], TAUS)


_SUPPORT = "support(model, lang, seen) AS (VALUES ('m0', 'eng_Latn', true), ('m0', 'deu_Latn', true), ('m0', 'swe_Latn', false), ('m1', 'eng_Latn', true), ('m1', 'fra_Latn', true))"


def _support(spark: SparkSession) -> DataFrame:
    rows = [("m0", "eng_Latn", True), ("m0", "deu_Latn", True), ("m0", "swe_Latn", False), ("m1", "eng_Latn", True), ("m1", "fra_Latn", True)]
    return spark.createDataFrame(rows, "model string, lang string, seen boolean")


@query(f"""WITH {_SUPPORT}, p AS (SELECT pair_id, ingested_at, src_lang, tgt_lang, 'm' || (pair_id % 3) AS model FROM bitext)
SELECT pair_id, ingested_at, p.model, a.seen AS src_seen, b.seen AS tgt_seen FROM p LEFT JOIN support a ON a.model = p.model AND a.lang = src_lang LEFT JOIN support b ON b.model = p.model AND b.lang = tgt_lang""")
def support_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bitext").select("pair_id", "ingested_at", "src_lang", "tgt_lang", F.concat(F.lit("m"), F.col("pair_id") % 3).alias("model"))
    return seen_flags(rows, _support(spark), "model", "src_lang", "tgt_lang").select("pair_id", "ingested_at", "model", "src_seen", "tgt_seen")


@query(f"""WITH {SCORES}, old AS (SELECT pair_id, qe_model, CASE WHEN isnan(qe_score) OR isinf(qe_score) THEN NULL ELSE qe_score END AS qe_score FROM (SELECT *, row_number() OVER (PARTITION BY pair_id, lower(trim(regexp_replace(qe_model, '\\s+', ' ', 'g'))) ORDER BY scored_at) AS k FROM (SELECT DISTINCT pair_id, lower(trim(regexp_replace(qe_model, '\\s+', ' ', 'g'))) AS qe_model, scored_at, qe_score FROM opus_scored)) WHERE k = 1)
SELECT qe_model, count(*) AS n, count(*) FILTER (o.qe_score IS DISTINCT FROM s.qe_score) AS n_changed, count(*) FILTER (o.qe_score IS NULL AND s.qe_score IS NOT NULL) AS n_filled FROM scores s JOIN old o USING (pair_id, qe_model) GROUP BY 1""")
def rescored_changes(spark: SparkSession, d: str) -> DataFrame:
    """First against latest score of every pair and model."""
    from corpusloom.operators.dedup import keep_one
    from corpusloom.plans.views import model_name

    raw = table(spark, d, "opus_scored").select("pair_id", model_name(F.col("qe_model")).alias("qe_model"), "scored_at", F.when(~F.isnan("qe_score") & (F.abs("qe_score") < float("inf")), F.col("qe_score")).alias("old"))
    old = keep_one(raw, ["pair_id", "qe_model"], ["scored_at"]).drop("scored_at")
    joined = scores(spark, d).join(old, ["pair_id", "qe_model"])
    changed = ~F.col("old").eqNullSafe(F.col("qe_score"))
    return joined.groupBy("qe_model").agg(F.count("*").alias("n"), F.count_if(changed).alias("n_changed"), F.count_if(F.col("old").isNull() & F.col("qe_score").isNotNull()).alias("n_filled"))


_RATES = {"metricx24": 1_200_000.0, "cometkiwi-da-xl": 180_000.0}


@query(f"""WITH {PAIRS}, winners AS (SELECT direction_key, CASE WHEN hash_ % 2 = 0 THEN ' metricx24 ' ELSE '' END AS winner_model FROM (SELECT DISTINCT lang_pair AS direction_key, ascii(lang_pair) AS hash_ FROM pairs WHERE lang_pair LIKE 'eng%' OR lang_pair LIKE 'fra%')),
n AS (SELECT lang_pair, count(*) AS sentences FROM pairs WHERE lang_pair IS NOT NULL GROUP BY 1)
SELECT lang_pair, sentences, coalesce(nullif(trim(winner_model), ''), 'cometkiwi-da-xl') AS winner_model, sentences / CASE coalesce(nullif(trim(winner_model), ''), 'cometkiwi-da-xl') WHEN 'metricx24' THEN 1200000.0::DOUBLE ELSE 180000.0::DOUBLE END AS est_hours FROM n LEFT JOIN winners ON direction_key = lang_pair""")
def lookup_models(spark: SparkSession, d: str) -> DataFrame:
    counted = pairs(spark, d).filter("lang_pair is not null").groupBy("lang_pair").agg(F.count("*").alias("sentences"))
    known = counted.filter("lang_pair like 'eng%' or lang_pair like 'fra%'").select(F.col("lang_pair").alias("direction_key"), F.when(F.ascii("lang_pair") % 2 == 0, " metricx24 ").otherwise("").alias("winner_model"))
    return lookup_winner(counted, known, "lang_pair", "cometkiwi-da-xl", "sentences", _RATES)


# --- retrieval and benchmark tables -----------------------------------------------------------------------------------
_VEC = "vec AS (SELECT a.vec_id, a.label, a.embedding AS va, b.embedding AS vb FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").alias("va")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("vb")), "vec_id")


@query(f"WITH {_VEC} SELECT vec_id, least(greatest(list_cosine_similarity(va::DOUBLE[], vb::DOUBLE[]), -1), 1) AS similarity FROM vec")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    from corpusloom.functions.values import cosine

    return _vectors(spark, d).select("vec_id", cosine(F.col("va"), F.col("vb")).alias("similarity"))


_MRR = f"""{_VEC}, sims AS (SELECT x.label, x.vec_id, y.vec_id AS other, list_cosine_similarity(x.va::DOUBLE[], y.vb::DOUBLE[]) AS s FROM vec x JOIN vec y ON x.label = y.label WHERE x.vec_id % 50 = 0),
ranks AS (SELECT label, vec_id, 1 + count(*) FILTER (other <> vec_id AND s > own + 1e-12) AS rank FROM (SELECT *, max(CASE WHEN other = vec_id THEN s END) OVER (PARTITION BY label, vec_id) AS own FROM sims) GROUP BY 1, 2)"""


def _ranks(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set of a search, every fiftieth id, against all rows of its group."""
    return retrieval.diagonal_ranks(_vectors(spark, d), ["label"], "vec_id", "va", "vb", queries=F.col("vec_id") % 50 == 0)


@query(f"WITH {_MRR} SELECT label, vec_id, rank FROM ranks")
def retrieval_ranks(spark: SparkSession, d: str) -> DataFrame:
    return _ranks(spark, d)


@query(f"WITH {_MRR} SELECT label, count(*) AS n, avg(1.0::DOUBLE / rank) AS mrr, avg(rank) AS avg_rank FROM ranks GROUP BY 1")
def retrieval_mrr(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.retrieval_summary(_ranks(spark, d), ["label"])


#: Benchmark results stand in for models that aren't here: fixed arithmetic over nations.
_BENCH = "bench AS (SELECT m AS model, n_name AS pair, ((n_nationkey * k * 37) % 100) / 100.0::DOUBLE AS mrr, ((n_nationkey * k * 53) % 40)::DOUBLE AS avg_rank, s::DOUBLE AS seconds FROM nation, (VALUES ('m0', 3, 30), ('m1', 7, 20), ('ensemble-a', 3, 10)) v(m, k, s))"


def _bench(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").withColumn("v", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(k).alias("k"), F.lit(s).alias("s")) for m, k, s in (("m0", 3, 30), ("m1", 7, 20), ("ensemble-a", 3, 10))])))
    n = F.col("n_nationkey")
    return rows.select(F.col("v.m").alias("model"), F.col("n_name").alias("pair"), ((n * F.col("v.k") * 37) % 100 / 100.0).alias("mrr"), ((n * F.col("v.k") * 53) % 40).cast("double").alias("avg_rank"), F.col("v.s").cast("double").alias("seconds"))


_BEST = f"{_BENCH}, best AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY mrr DESC, (model LIKE 'ensemble%')::INT, seconds, model) AS k FROM bench) WHERE k = 1)"


@query(f"WITH {_BEST} SELECT * FROM best")
def best_model(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.best_model(_bench(spark, d), ["pair"])


@query(f"WITH {_BEST} SELECT model, count(*) AS wins, 100.0::DOUBLE * count(*) / (SELECT count(*) FROM best) AS wins_pct FROM best GROUP BY 1")
def model_wins(spark: SparkSession, d: str) -> DataFrame:
    best = retrieval.best_model(_bench(spark, d), ["pair"])
    total = best.agg(F.count("*").alias("t"))  # one row
    return best.groupBy("model").agg(F.count("*").alias("wins")).crossJoin(F.broadcast(total)).select("model", "wins", (100.0 * F.col("wins") / F.col("t")).alias("wins_pct"))


@query(f"WITH {_BENCH} (SELECT 'top' AS side, model, pair, mrr FROM bench ORDER BY mrr DESC, pair, model LIMIT 20) UNION ALL (SELECT 'bottom', model, pair, mrr FROM bench ORDER BY mrr, pair, model LIMIT 20)")
def top_bottom_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = _bench(spark, d).select("model", "pair", "mrr")
    top = rows.orderBy(F.desc("mrr"), "pair", "model").limit(20).select(F.lit("top").alias("side"), "*")
    return top.unionByName(rows.orderBy("mrr", "pair", "model").limit(20).select(F.lit("bottom").alias("side"), "*"))


@query(f"""WITH {_BENCH}, a AS (SELECT * FROM bench WHERE length(pair) % 2 = 0), b AS (SELECT model, pair, mrr / 2 AS mrr, avg_rank FROM bench WHERE length(pair) % 3 = 0)
SELECT model, pair, coalesce((a.mrr + b.mrr) / 2, a.mrr, b.mrr) AS mrr, coalesce((a.avg_rank + b.avg_rank) / 2, a.avg_rank, b.avg_rank) AS avg_rank FROM a FULL JOIN b USING (model, pair)""")
def merged_benchmarks(spark: SparkSession, d: str) -> DataFrame:
    rows = _bench(spark, d)
    b = rows.filter(F.length("pair") % 3 == 0).withColumn("mrr", F.col("mrr") / 2)
    return retrieval.merged_results(rows.filter(F.length("pair") % 2 == 0), b, ["model", "pair"], ["mrr", "avg_rank"])


#: Translation metrics of a variant, dataset and direction stand in for evaluation runs.
_METRICS = "metrics AS (SELECT 'v' || (l_linenumber % 3) AS variant, l_returnflag AS dataset, l_linestatus AS direction, 'l' || (l_suppkey % 5) AS language, l_partkey % 97 AS iteration, l_quantity AS bleu, l_discount AS chrf, l_orderkey, l_linenumber FROM lineitem)"


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("v"), F.col("l_linenumber") % 3).alias("variant"), F.col("l_returnflag").alias("dataset"), F.col("l_linestatus").alias("direction"), F.concat(F.lit("l"), F.col("l_suppkey") % 5).alias("language"),
        (F.col("l_partkey") % 97).alias("iteration"), F.col("l_quantity").alias("bleu"), F.col("l_discount").alias("chrf"), "l_orderkey", "l_linenumber",
    )


_MACRO = f"""{_METRICS}, l4 AS (SELECT variant, language, dataset, direction, avg(bleu) AS bleu, avg(chrf) AS chrf FROM metrics GROUP BY 1, 2, 3, 4), l3 AS (SELECT variant, language, dataset, avg(bleu) AS bleu, avg(chrf) AS chrf FROM l4 GROUP BY 1, 2, 3),
l2 AS (SELECT variant, language, avg(bleu) AS bleu, avg(chrf) AS chrf FROM l3 GROUP BY 1, 2), macro AS (SELECT variant, avg(bleu) AS bleu, avg(chrf) AS chrf FROM l2 GROUP BY 1)"""


@query(f"WITH {_MACRO} SELECT * FROM macro")
def macro_metrics(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.macro_average(_metrics(spark, d), ["variant", "language", "dataset", "direction"], ["bleu", "chrf"])


@query(f"""WITH {_MACRO}, r AS (SELECT variant, rank() OVER (ORDER BY bleu DESC) AS bleu_rank, rank() OVER (ORDER BY chrf DESC) AS chrf_rank FROM macro)
SELECT *, (bleu_rank + chrf_rank) / 2.0::DOUBLE AS mean_rank, rank() OVER (ORDER BY (bleu_rank + chrf_rank) / 2.0::DOUBLE) AS overall_rank FROM r""")
def competition_ranks(spark: SparkSession, d: str) -> DataFrame:
    macro = retrieval.macro_average(_metrics(spark, d), ["variant", "language", "dataset", "direction"], ["bleu", "chrf"])
    return retrieval.competition_ranks(macro.select("variant", F.round("bleu", 12).alias("bleu"), F.round("chrf", 12).alias("chrf")), "variant", ["bleu", "chrf"])


@query(f"WITH {_METRICS} SELECT variant, language, iteration, l_orderkey, bleu FROM (SELECT *, row_number() OVER (PARTITION BY variant, language ORDER BY iteration DESC, l_orderkey DESC, l_linenumber DESC) AS k FROM metrics) WHERE k = 1")
def latest_iteration(spark: SparkSession, d: str) -> DataFrame:
    from corpusloom.operators.tracking import last_event

    rows = _metrics(spark, d).select("variant", "language", "iteration", "l_orderkey", "l_linenumber", "bleu")
    return last_event(rows, ["variant", "language"], ["iteration", "l_orderkey", "l_linenumber"]).drop("l_linenumber")


@query("""WITH alias(code, name) AS (VALUES ('zho_Hans', 'zh'), ('zho_Hans', 'zh_CN'), ('arb_Arab', 'ar')), x AS (SELECT pair_id, ingested_at, tgt_lang FROM bitext)
SELECT pair_id, ingested_at, coalesce(name, tgt_lang) AS dataset_lang FROM x LEFT JOIN alias ON code = tgt_lang""")
def aliased_languages(spark: SparkSession, d: str) -> DataFrame:
    aliases = spark.createDataFrame([("zho_Hans", "zh"), ("zho_Hans", "zh_CN"), ("arb_Arab", "ar")], "code string, name string")
    joined = table(spark, d, "bitext").select("pair_id", "ingested_at", "tgt_lang").join(F.broadcast(aliases), F.col("code") == F.col("tgt_lang"), "left")
    return joined.select("pair_id", "ingested_at", F.coalesce("name", "tgt_lang").alias("dataset_lang"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND regexp_matches(o_orderpriority, '^[12]-')")
def completed_results(spark: SparkSession, d: str) -> DataFrame:
    """Finished runs whose name fits a pattern."""
    return table(spark, d, "orders").filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").rlike("^[12]-")).select("o_orderkey", "o_orderstatus")


@query()
def corpus_metrics(spark: SparkSession, d: str) -> DataFrame:
    """BLEU and chrF++ of a pair's text against its copy in the evaluation sample, per language pair."""
    from corpusloom.operators.metrics import corpus_metrics as metrics

    rows = table(spark, d, "eval_sample").select("lang1_code", F.col("lang1_text").alias("h"), F.col("lang2_text").alias("r"))
    return metrics(rows, ["lang1_code"], "h", "r")
