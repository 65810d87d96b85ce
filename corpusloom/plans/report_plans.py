"""Queries of calibration, known token totals, volume tiers, embeddings, manifests and models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import values as V
from corpusloom.functions.text import SPACE
from corpusloom.operators import joint, retrieval, stats
from corpusloom.operators.keys import join_groups, join_table
from corpusloom.operators.prefix import exact_quantiles
from corpusloom.operators.scoring import reassign_large
from corpusloom.plans.ensemble_plans import _vectors
from corpusloom.plans.joint_plans import _HIST, _JOINT, _SCORED, BINS, _base, _rounded
from corpusloom.plans.registry import query
from corpusloom.plans.views import PAIRS, SCORES, pairs, scores
from corpusloom.session import spread, table
from corpusloom.storage import materialize

# --- calibration ------------------------------------------------------------------------------------------------------
_KNOTS = f"""{PAIRS}, sims AS (SELECT lang_pair, similarity_score::DOUBLE AS v FROM pairs WHERE similarity_score IS NOT NULL AND NOT isnan(similarity_score) AND NOT isinf(similarity_score) AND lang_pair IS NOT NULL),
points AS (SELECT DISTINCT lang_pair, unnest(quantile_cont(v, {[i / 256 for i in range(257)]})) AS x FROM sims GROUP BY lang_pair),
knots AS MATERIALIZED (SELECT p.lang_pair, p.x, (count(*) FILTER (s.v < p.x - 1e-12) + count(*) FILTER (s.v <= p.x + 1e-12)) / (2.0::DOUBLE * count(*)) AS p FROM points p JOIN sims s USING (lang_pair) GROUP BY 1, 2)"""


def _knots(spark: SparkSession, d: str) -> DataFrame:
    return joint.fit_cdfs(pairs(spark, d).filter("similarity_score is not null and lang_pair is not null"), ["lang_pair"], "similarity_score")


@query(f"WITH {_KNOTS} SELECT lang_pair, (row_number() OVER (PARTITION BY lang_pair ORDER BY x) - 1)::INT AS knot, x, p FROM knots")
def calibration_knots(spark: SparkSession, d: str) -> DataFrame:
    return _knots(spark, d).select("lang_pair", F.posexplode(F.arrays_zip("x", "p")).alias("knot", "k")).select("lang_pair", "knot", "k.x", "k.p")


@query(f"""WITH {_KNOTS}, steps AS (SELECT *, lead(x) OVER w AS x1, lead(p) OVER w AS p1, min(x) OVER (PARTITION BY lang_pair) AS lowest, max(x) OVER (PARTITION BY lang_pair) AS highest FROM knots WINDOW w AS (PARTITION BY lang_pair ORDER BY x)),
shifted AS (SELECT pair_id, ingested_at, lang_pair, similarity_score::DOUBLE * 1.1::DOUBLE - 0.05::DOUBLE AS v FROM pairs WHERE lang_pair IS NOT NULL)
SELECT pair_id, ingested_at, CASE WHEN v IS NULL OR isnan(v) THEN 0.5 WHEN v < (SELECT min(x) FROM knots k WHERE k.lang_pair = s.lang_pair) THEN 0.0 WHEN v > (SELECT max(x) FROM knots k WHERE k.lang_pair = s.lang_pair) THEN 1.0
ELSE coalesce((SELECT any_value(CASE WHEN x1 IS NULL OR v = x THEN p ELSE p + (p1 - p) * (v - x) / (x1 - x) END) FROM steps k WHERE k.lang_pair = s.lang_pair AND k.x <= v AND (k.x1 IS NULL OR v < k.x1)), 0.5) END::DOUBLE AS calibrated FROM shifted s""")
def calibrated_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The fitted distributions applied to values that aren't those they were fitted on."""
    rows = pairs(spark, d).filter("lang_pair is not null").select("pair_id", "ingested_at", "lang_pair", (F.col("similarity_score").cast("double") * 1.1 - 0.05).alias("v"))
    joined = join_table(rows, _knots(spark, d).select("lang_pair", "x", "p"), ["lang_pair"], "left")
    return joined.select("pair_id", "ingested_at", joint.cdf_at(F.col("v"), F.col("x"), F.col("p")).alias("calibrated"))


# --- known totals and tiers -------------------------------------------------------------------------------------------
_TOTALS = "totals AS (SELECT source_pair AS lang_pair, max(total_tokens)::DOUBLE AS known FROM source_plan WHERE total_tokens > 0 GROUP BY 1)"
_SCALED = f"""{_HIST}, {_TOTALS}, own AS (SELECT lang_pair, sum(tokens)::DOUBLE AS own FROM hist GROUP BY 1),
scaled AS (SELECT h.lang_pair, llm_present, bin, rows, tokens * coalesce(CASE WHEN known > 0 AND own > 0 THEN known / own END, 1.0::DOUBLE) AS tokens FROM hist h JOIN own USING (lang_pair) LEFT JOIN totals USING (lang_pair))"""


def _scaled(spark: SparkSession, d: str) -> DataFrame:
    hist = materialize(joint.score_histogram(_rounded(spark, d), ["lang_pair", "llm_present"], "joint_score", "size", BINS), "hist")
    totals = table(spark, d, "source_plan").filter("total_tokens > 0").groupBy(F.col("source_pair").alias("lang_pair")).agg(F.max("total_tokens").alias("known"))
    return joint.scale_to_totals(hist, totals, ["lang_pair"], "tokens", "known")


@query(f"WITH {_SCALED} SELECT * FROM scaled")
def token_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Characters of each bin scaled to the tokens that are known of the pair."""
    return _scaled(spark, d)


#: Edges and rates of volume tiers that the test tables fall into on all sides.
_EDGES, _RATES = (200.0, 1500.0, 8000.0), (0.90, 0.70, 0.50, 0.30)
_TIER = f"CASE WHEN e < {_EDGES[0]} THEN {_RATES[0]} WHEN e < {_EDGES[1]} THEN {_RATES[1]} WHEN e < {_EDGES[2]} THEN {_RATES[2]} ELSE {_RATES[3]} END::DOUBLE"


@query(f"""WITH {PAIRS}, sized AS (SELECT lang_pair, (count(*) * 100)::DOUBLE AS e, (count(*) FILTER (similarity_score >= 0.6) * 100)::DOUBLE AS eligible FROM pairs WHERE lang_pair IS NOT NULL GROUP BY 1),
based AS (SELECT *, e * {_TIER} AS b FROM sized), target AS (SELECT 0.55::DOUBLE * sum(eligible) AS t FROM based),
steps AS (SELECT lang_pair, eligible, b, eligible / b AS full_at, coalesce(sum(eligible) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled, sum(b) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_base FROM based WINDOW o AS (ORDER BY eligible / b, lang_pair)),
level AS (SELECT max((t - filled) / open_base) FILTER (filled + full_at * open_base >= t) AS c FROM steps, target)
SELECT lang_pair, least(eligible, greatest(c, 0) * b) AS budget FROM steps, level""")
def tiered_budgets(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of all volume tiers share a target; some run full before it is reached."""
    n = pairs(spark, d).filter("lang_pair is not null").groupBy("lang_pair").agg(
        (F.count("*") * 100).cast("double").alias("original"), (F.count_if(F.col("similarity_score") >= F.lit(0.6).cast("float")) * 100).cast("double").alias("eligible")
    )
    n = materialize(n, "volumes")
    target = 0.55 * (n.agg(F.sum("eligible")).first()[0] or 0.0)
    return joint.allocate_budget(n, "lang_pair", "original", "eligible", target, replace(joint.JointConfig(), volume_edges=_EDGES, volume_rates=_RATES))


@query(f"""WITH {_SCORED} SELECT lang_pair, count(*) AS rows_in, count(*) FILTER (reasons = 0) AS eligible, count(*) FILTER (reasons > 0) AS rejected, true AS conserved FROM marked GROUP BY 1""")
def conservation_checks(spark: SparkSession, d: str) -> DataFrame:
    """Rows in, eligible and rejected by language pair, counted on their own sides."""
    rows = materialize(_base(spark, d).select("lang_pair", "reasons"), "reasons")
    count = lambda df, name: df.groupBy("lang_pair").agg(F.count("*").alias(name))
    out = join_groups(count(rows, "rows_in"), count(rows.filter("reasons = 0"), "eligible"), ["lang_pair"], "left")
    out = join_groups(out, count(rows.filter("reasons > 0"), "rejected"), ["lang_pair"], "left").fillna(0, ["eligible", "rejected"])
    return out.withColumn("conserved", F.col("rows_in") == F.col("eligible") + F.col("rejected"))


@query("""SELECT dataset, target_pair, source_pair, sha256('{"dataset":"' || dataset || '","source_pair":"' || source_pair || '","target_pair":"' || target_pair || '"}') AS digest FROM (SELECT DISTINCT dataset, target_pair, source_pair FROM source_plan)""")
def plan_digests(spark: SparkSession, d: str) -> DataFrame:
    """The digest that ties a source's results to its plan: SHA-256 of its settings as JSON with sorted keys."""
    rows = table(spark, d, "source_plan").select("dataset", "target_pair", "source_pair").distinct()
    return rows.withColumn("digest", F.sha2(F.to_json(F.struct("dataset", "source_pair", "target_pair"), {"ignoreNullFields": "false"}), 256))


# --- models -----------------------------------------------------------------------------------------------------------
_BOTH = f"{SCORES}, both_scores AS (SELECT a.direction_key, a.qe_score AS a, b.qe_score / 100 AS b FROM scores a JOIN scores b USING (pair_id) WHERE a.qe_model = 'cometkiwi-da-xl' AND b.qe_model = 'llm-offline' AND a.qe_score IS NOT NULL AND b.qe_score IS NOT NULL)"
_RANK = lambda c: f"rank() OVER (PARTITION BY direction_key ORDER BY {c}) + (count(*) OVER (PARTITION BY direction_key, {c}) - 1) / 2.0::DOUBLE"


@query(f"""WITH {_BOTH}, r AS (SELECT *, {_RANK('a')} AS ra, {_RANK('b')} AS rb FROM both_scores)
SELECT direction_key, count(*) AS n, CASE WHEN stddev_pop(ra) > 0 AND stddev_pop(rb) > 0 THEN corr(ra, rb) END AS spearman FROM r GROUP BY 1""")
def rank_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Rank correlation of two models' scores by direction."""
    rows = scores(spark, d)
    a = rows.filter("qe_model = 'cometkiwi-da-xl'").select("pair_id", "direction_key", F.col("qe_score").alias("a"))
    b = rows.filter("qe_model = 'llm-offline'").select("pair_id", (F.col("qe_score") / 100).alias("b"))
    return stats.agreement(materialize(a.join(b, "pair_id"), "both"), ["direction_key"], "a", "b", ranks=True).select("direction_key", "n", "spearman")


@query(f"WITH {SCORES} SELECT qe_model, direction_key, avg(qe_score) AS mean, median(qe_score) AS median FROM scores WHERE qe_score IS NOT NULL GROUP BY 1, 2")
def direction_medians(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(scores(spark, d).select("qe_model", "direction_key", "qe_score").filter("qe_score is not null"), "scores")
    keys = ["qe_model", "direction_key"]
    return join_groups(rows.groupBy(*keys).agg(F.avg("qe_score").alias("mean")), exact_quantiles(rows, keys, "qe_score", {"median": 0.5}), keys)


@query(f"""WITH {SCORES}, means AS (SELECT direction_key, count(DISTINCT pair_id) AS n_rows, avg(qe_score) FILTER (qe_model = 'cometkiwi-da-xl') AS kiwi, avg(qe_score) FILTER (qe_model = 'xcomet-xl') AS xcomet, avg(qe_score) FILTER (qe_model = 'remedy-9b') AS remedy FROM scores WHERE direction_key IS NOT NULL GROUP BY 1),
won AS (SELECT *, CASE WHEN coalesce(kiwi, 0) >= coalesce(xcomet, 0) THEN 'cometkiwi-da-xl' ELSE 'xcomet-xl' END AS w FROM means)
SELECT direction_key, CASE WHEN w LIKE 'cometkiwi%' THEN CASE WHEN n_rows > 50 AND (direction_key LIKE '%deu_Latn%' OR coalesce(abs(kiwi - remedy) < 0.05, false)) THEN 'remedy-9b' ELSE 'cometkiwi-da-xl' END ELSE w END AS winner_model FROM won""")
def reassigned_models(spark: SparkSession, d: str) -> DataFrame:
    """Winners by mean score; large directions of one model go to another that supports them or is as good."""
    one = lambda m: F.avg(F.when(F.col("qe_model") == m, F.col("qe_score")))
    means = scores(spark, d).filter("direction_key is not null").groupBy("direction_key").agg(
        F.count_distinct("pair_id").alias("n_rows"), one("cometkiwi-da-xl").alias("kiwi"), one("xcomet-xl").alias("xcomet"), one("remedy-9b").alias("remedy")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    won = means.withColumn("winner_model", F.when(zero("kiwi") >= zero("xcomet"), "cometkiwi-da-xl").otherwise("xcomet-xl"))
    supported = F.col("direction_key").contains("deu_Latn")
    return reassign_large(won, "winner_model", "cometkiwi", "remedy-9b", "cometkiwi-da-xl", F.col("n_rows"), 50, supported, F.col("kiwi") - F.col("remedy"), 0.05).select("direction_key", "winner_model")


# --- words and vectors ------------------------------------------------------------------------------------------------
_BYTES = "list_transform(range(0, length(hex(g)) // 2), lambda k: ('0x' || substr(hex(g), 2 * k + 1, 2))::BIGINT)"


@query(f"""WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^{SPACE}]+')) AS word FROM eval_items), padded AS (SELECT word, '<' || word || '>' AS p FROM words),
grams AS (SELECT word, i, n, substr(p, i, n) AS g FROM (SELECT word, p, unnest(range(1, length(p) + 1)) AS i FROM padded), range(3, 6) x(n) WHERE i + n - 1 <= length(p))
SELECT word, g AS gram, list_reduce({_BYTES}, lambda h, b: xor(h, CASE WHEN b < 128 THEN b ELSE b + 4294967040 END) * 16777619 % 4294967296, 2166136261::BIGINT) % 2000 AS bucket FROM grams GROUP BY ALL""")
def subword_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Buckets of the distinct n-grams (3 to 5 characters) of every word of the test items."""
    found = table(spark, d, "eval_items").select(F.explode(F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), F.lit(0))).alias("word")).distinct()
    ids = spread(found).withColumn("b", V.subword_ids("word", F.lit(3), F.lit(5), F.lit(2000)))
    p = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    # The grams in the order of the buckets: by their begin, then by length.
    starts = F.sequence(F.lit(1), F.length(p) - 2)
    grams = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(3), F.least(F.lit(5), F.length(p) - i + 1)), lambda n: F.substr(p, i, n))))
    return ids.select("word", F.explode(F.arrays_zip(grams.alias("gram"), F.col("b").alias("bucket"))).alias("x")).select("word", "x.gram", "x.bucket").distinct()


@query("""WITH v AS (SELECT a.vec_id, a.embedding::DOUBLE[] AS va, b.embedding::DOUBLE[] AS vb FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
u AS (SELECT *, sqrt(list_inner_product(va, va)) + 1e-9 AS na, sqrt(list_inner_product(vb, vb)) + 1e-9 AS nb FROM v), m AS (SELECT vec_id, va, list_transform(va, lambda x, i: (x / na + vb[i] / nb) / 2) AS m FROM u)
SELECT vec_id, list_sum(m) AS total, list_inner_product(m, va) AS along FROM m""")
def embedding_means(spark: SparkSession, d: str) -> DataFrame:
    """The mean of each vector and the next, both of length 1: the sum of its parts, and how far it goes along the first."""
    rows = spread(_vectors(spark, d)).withColumn("m", retrieval.mean_embedding(["va", "vb"]))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    return rows.select("vec_id", total(F.col("m")).alias("total"), total(F.zip_with("m", "va", lambda x, y: x * y.cast("double"))).alias("along"))


@query()
def aligned_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector and the next after canonical correlation has aligned both sides."""
    rows = _vectors(spark, d)
    aligned = retrieval.cca_apply(rows, "va", "vb", retrieval.cca_fit(rows, "va", "vb"))
    return aligned.select("vec_id", V.cosine(F.col("va"), F.col("vb")).alias("similarity"))
