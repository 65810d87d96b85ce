"""Queries of the joint score: rejection, calibration, score, budget and selection, samples and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.values import score_bin, splitmix_uniform, truth
from corpusloom.operators import budget, joint, outlier, sampling
from corpusloom.operators.dedup import keep_one
from corpusloom.operators.keys import join_table
from corpusloom.operators.prefix import exact_quantiles
from corpusloom.plans.feature_plans import SALTS
from corpusloom.plans.hash_sql import hashed, mixed
from corpusloom.plans.registry import query
from corpusloom.plans.views import FEATURES, PAIRS, SCORES, alignments_sql, features, pairs, predictions_sql, scores, truth_sql, with_predictions
from corpusloom.session import spread, table
from corpusloom.sources.writers import training_lines
from corpusloom.storage import materialize

C = joint.JointConfig()
BINS = 1000

#: Each pair once, by its first row, with its similarity, its current quality score and the predicted languages.
_ROWS = rf"""{predictions_sql()}, {SCORES},
one AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) AS k FROM pairs WHERE lang_pair IS NOT NULL) WHERE k = 1),
lid AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) AS k FROM preds WHERE lang_pair IS NOT NULL) WHERE k = 1),
qe AS (SELECT pair_id, qe_score, least(CASE WHEN {truth_sql('qe_src_seen')} THEN 1.0 WHEN NOT {truth_sql('qe_src_seen')} THEN 0.5 ELSE 0.75 END, CASE WHEN {truth_sql('qe_tgt_seen')} THEN 1.0 WHEN NOT {truth_sql('qe_tgt_seen')} THEN 0.5 ELSE 0.75 END)::DOUBLE AS reliability FROM scores WHERE qe_model = 'cometkiwi-da-xl'),
judge AS (SELECT pair_id, qe_score / 100 AS j FROM scores WHERE qe_model = 'llm-offline' AND qe_score IS NOT NULL)"""


def _sign_sql(expected: str, predicted: str) -> str:
    script = lambda c: f"CASE WHEN split_part({c}, '_', 2) IN ('Hans', 'Hant', 'Hani') THEN 'Han' ELSE split_part({c}, '_', 2) END"
    root = lambda c: f"CASE split_part({c}, '_', 1) {' '.join(f'WHEN {a!r} THEN {b!r}' for a, b in joint.ROOT_ALIASES.items())} ELSE split_part({c}, '_', 1) END"
    return f"CASE WHEN {predicted} IS NULL THEN 0 WHEN {root(expected)} = {root(predicted)} AND {script(expected)} = {script(predicted)} THEN 1 ELSE -1 END"


def _evidence_sql(side: str) -> str:
    return f"(1 + ({_sign_sql(f'{side}_lang', f'{side}_id_glotlid')} * {side}_conf_glotlid + {_sign_sql(f'{side}_lang', f'{side}_id_conlid')} * {side}_conf_conlid) / 2) / 2"


_MARKS = lambda c: f"(length({c}) - length(regexp_replace({c}, '{T.terminal_class()}', '', 'g')))"
_PUNCT = f"CASE WHEN source_text = '' OR target_text = '' THEN -20.0::DOUBLE ELSE -ln((abs({_MARKS('source_text')} - {_MARKS('target_text')}) + greatest({_MARKS('source_text')} - 1, 0) + greatest({_MARKS('target_text')} - 1, 0) + 1)::DOUBLE) END"
_HTML = "greatest(regexp_matches(source_text, '<[a-zA-Z][^>]*>')::INT, regexp_matches(target_text, '<[a-zA-Z][^>]*>')::INT)::DOUBLE"
_SHARE = lambda t, code: f"CASE split_part({code}, '_', 2) " + " ".join(
    f"WHEN '{k}' THEN length(regexp_replace(regexp_replace({t}, '[^\\p{{L}}]', '', 'g'), '[^{''.join(rf'\p{{{n}}}' for n in ns)}]', '', 'g'))" for k, ns in T.SCRIPTS.items() if k in ("Latn", "Cyrl", "Grek", "Arab", "Hans")
) + f" END / nullif(length(regexp_replace({t}, '[^\\p{{L}}]', '', 'g')), 0)::DOUBLE"
_WRONG = lambda t, code, n: f"coalesce(length(regexp_replace({t}, '[^\\p{{L}}]', '', 'g')) >= {n} AND {_SHARE(t, code)} < 0.2, false)"
_BAD = lambda s: f"({s}_id_glotlid = {s}_id_conlid AND {_sign_sql(f'{s}_lang', f'{s}_id_glotlid')} = -1 AND least({s}_conf_glotlid, {s}_conf_conlid) >= 0.9)"
_SAME = "trim(regexp_replace(nfc_normalize(source_text), '[" + T.SPACE + "]+', ' ', 'g')) = trim(regexp_replace(nfc_normalize(target_text), '[" + T.SPACE + "]+', ' ', 'g'))"

_SCORED = rf"""{_ROWS}, base AS (SELECT o.pair_id, o.lang_pair, o.corpus, o.src_lang, o.tgt_lang, o.source_text, o.target_text, o.similarity_score::DOUBLE AS sim, q.qe_score AS qe, coalesce(q.reliability, 0.75) AS reliability, j.j,
  l.src_id_glotlid, l.src_id_conlid, l.src_conf_glotlid, l.src_conf_conlid, l.tgt_id_glotlid, l.tgt_id_conlid, l.tgt_conf_glotlid, l.tgt_conf_conlid, length(o.source_text) AS src_chars, length(o.target_text) AS tgt_chars,
  coalesce(regexp_matches(o.source_text, '^[{T.SPACE}]*$'), true) OR coalesce(regexp_matches(o.target_text, '^[{T.SPACE}]*$'), true) AS is_empty
  FROM one o JOIN lid l USING (pair_id) LEFT JOIN qe q USING (pair_id) LEFT JOIN judge j USING (pair_id)),
marked AS (SELECT *, least({_evidence_sql('src')}, {_evidence_sql('tgt')}) AS lang_score,
  CASE WHEN is_empty THEN 1 ELSE 0 END
  | CASE WHEN NOT is_empty AND coalesce({_SAME}, false) AND split_part(src_lang, '_', 2) <> split_part(tgt_lang, '_', 2) AND ({_WRONG('source_text', 'src_lang', 20)} OR {_WRONG('target_text', 'tgt_lang', 20)}) THEN 2 ELSE 0 END
  | CASE WHEN NOT is_empty AND ((coalesce({_BAD('src')}, false) AND {_WRONG('source_text', 'src_lang', 40)}) OR (coalesce({_BAD('tgt')}, false) AND {_WRONG('target_text', 'tgt_lang', 40)})) THEN 4 ELSE 0 END
  | CASE WHEN sim IS NULL AND qe IS NULL THEN 8 ELSE 0 END AS reasons FROM base)"""


def _base(spark: SparkSession, d: str) -> DataFrame:
    """Each pair with its signals, its reasons for rejection and its language score.

    All that needs the texts is computed where they are read; what is shuffled to find each pair's first row and to join
    the scores are a few numbers a row."""
    rows = with_predictions(spread(pairs(spark, d).filter("lang_pair is not null"))).withColumn("same", T.same_text("source_text", "target_text"))
    s, t = F.col("source_text"), F.col("target_text")
    evidence = [joint.language_evidence(F.col(f"{x}_lang"), [(F.col(f"{x}_id_{m}"), F.col(f"{x}_conf_{m}")) for m in ("glotlid", "conlid")]) for x in ("src", "tgt")]
    bad = [
        (F.col(f"{x}_id_glotlid") == F.col(f"{x}_id_conlid")) & (joint.language_sign(F.col(f"{x}_lang"), F.col(f"{x}_id_glotlid")) == -1) & (F.least(f"{x}_conf_glotlid", f"{x}_conf_conlid") >= C.lid_confidence)
        for x in ("src", "tgt")
    ]
    local = rows.select(
        "pair_id", "ingested_at", "lang_pair", "corpus", "src_lang", "tgt_lang", F.col("similarity_score").cast("double").alias("sim"), F.length(s).alias("src_chars"), F.length(t).alias("tgt_chars"),
        F.least(*evidence).alias("lang_score"), joint.text_reasons(s, t, F.col("src_lang"), F.col("tgt_lang"), F.col("same"), tuple(bad)).alias("text_reasons"),
        T.terminal_punctuation_score(s, t).alias("punct_score"), F.greatest(T.html_flag(s).cast("int"), T.html_flag(t).cast("int")).cast("double").alias("html"),
        *[c.alias(n) for n, c in joint.text_signals(s, t, F.col("src_lang"), F.col("tgt_lang"), F.col("same")).items()],
    )
    one = keep_one(local, ["pair_id"], ["ingested_at"]).drop("ingested_at")
    current = scores(spark, d)
    trust = lambda c: F.when(truth(F.col(c)), 1.0).when(~truth(F.col(c)), 0.5).otherwise(0.75)
    # Both scores of a pair in one pass over the scores.
    kiwi, judge = F.col("qe_model") == "cometkiwi-da-xl", F.col("qe_model") == "llm-offline"
    signals = current.filter(kiwi | judge).groupBy("pair_id").agg(
        F.max(F.when(kiwi, F.col("qe_score"))).alias("qe"), F.max(F.when(kiwi, F.least(trust("qe_src_seen"), trust("qe_tgt_seen")))).alias("reliability"), F.max(F.when(judge, F.col("qe_score") / 100)).alias("j")
    )
    rows = one.join(signals, "pair_id", "left").withColumn("reliability", F.coalesce("reliability", F.lit(0.75)))
    return rows.withColumn("reasons", F.col("text_reasons").bitwiseOR(joint.semantic_reasons(F.col("sim"), F.col("qe")))).drop("text_reasons")


@query(f"WITH {_SCORED} SELECT lang_pair, reasons, count(*) AS n FROM marked GROUP BY 1, 2")
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _base(spark, d).groupBy("lang_pair", "reasons").agg(F.count("*").alias("n"))


def _mid(col: str, group: str) -> str:
    return f"CASE WHEN {col} IS NOT NULL THEN (2 * rank() OVER (PARTITION BY {group} ORDER BY {col}) - 2 + count(*) OVER (PARTITION BY {group}, {col})) / (2.0::DOUBLE * count({col}) OVER (PARTITION BY {group})) END"


_RISK = lambda c: f"coalesce(least(greatest(({c} - 0.8) / (1 - 0.8::DOUBLE), 0), 1), 0)"
_LIFT = lambda c: f"(0.05 + (1 - 0.05::DOUBLE) * {c})"
_LETTERS = lambda c: f"length(regexp_replace({c}, '[^\\p{{L}}]', '', 'g'))"
_WORDS = lambda c: f"list_transform(regexp_extract_all({c}, '[^{T.SPACE}]+'), lambda w: length(w))"
_UNSPACED = "(" + ", ".join(f"'{x}'" for x in joint.NO_WORD_SCRIPTS) + ")"
_ON = lambda side: f"split_part({side}_lang, '_', 2) NOT IN {_UNSPACED}"
_JOINT = rf"""{_SCORED}, fine AS (SELECT * FROM marked WHERE reasons = 0), {alignments_sql('fine')},
ok AS (SELECT m.*, ln(greatest(src_chars, 1) / greatest(tgt_chars, 1)::DOUBLE) AS logratio, -({_PUNCT}) / ln(1 + greatest(least(src_chars, tgt_chars), 1)::DOUBLE) AS punct, {_HTML} AS html,
  CASE WHEN {_SAME} THEN 1.0::DOUBLE ELSE score_lcs_ratio END AS overlap, least({_LETTERS('source_text')}, {_LETTERS('target_text')}) AS letters, greatest(score_repeat_src, score_repeat_trg) AS repeats,
  CASE WHEN score_numerals < 1 AND has_digits THEN 1 - score_numerals ELSE 0 END AS numbers, {_WORDS('source_text')} AS ws, {_WORDS('target_text')} AS wt
  FROM fine m JOIN aligned a ON a.a_s = m.source_text AND a.a_t = m.target_text),
measured AS (SELECT *, CASE WHEN overlap > 0.8 AND letters >= {joint.LEAST_COPY_LETTERS} THEN least(greatest((overlap - 0.8) / 0.2::DOUBLE, 0), 1) ELSE 0 END AS copy,
  CASE WHEN {_ON('src')} AND {_ON('tgt')} THEN ln(greatest(len(ws), 1) / greatest(len(wt), 1)::DOUBLE) END AS word_logratio,
  CASE WHEN {_ON('src')} THEN coalesce(list_sum(ws), 0) / greatest(len(ws), 1)::DOUBLE END AS src_mean_word, CASE WHEN {_ON('src')} THEN coalesce(list_max(ws), 0) END AS src_max_word,
  CASE WHEN {_ON('tgt')} THEN coalesce(list_sum(wt), 0) / greatest(len(wt), 1)::DOUBLE END AS tgt_mean_word, CASE WHEN {_ON('tgt')} THEN coalesce(list_max(wt), 0) END AS tgt_max_word FROM ok),
centred AS (SELECT *, round(abs(logratio - median(logratio) OVER (PARTITION BY lang_pair)), 9) AS away, round(abs(word_logratio - median(word_logratio) OVER (PARTITION BY lang_pair)), 9) AS word_away, round(punct, 9) AS punct9 FROM measured),
ranked AS (SELECT *, {_mid('sim', 'lang_pair')} AS p, {_mid('qe', 'lang_pair')} AS q, {_mid('j', 'lang_pair')} AS jj, {_mid('away', 'lang_pair')} AS r_len, {_mid('punct9', 'lang_pair')} AS r_punct,
  {_mid('word_away', 'lang_pair')} AS r_words, {_mid('repeats', 'lang_pair')} AS r_repeat, {", ".join(f"{_mid(f'{x}_{k}_word', 'lang_pair')} AS r_{x}_{k}" for x in ("src", "tgt") for k in ("mean", "max"))} FROM centred),
risks AS (SELECT *, greatest({_RISK('r_len')}, {_RISK('r_words')}) AS k1, copy AS k2, {_RISK('r_repeat')} AS k3, numbers AS k4,
  greatest({_RISK('r_punct')}, html, {", ".join(_RISK(f"r_{x}_{k}") for x in ("src", "tgt") for k in ("mean", "max"))}) AS k5 FROM ranked),
formed AS (SELECT *, least(greatest(1 - 0.7 * greatest(k1, k2, k3, k4, k5) - 0.3 * (k1 + k2 + k3 + k4 + k5) / 5, 0.05), 1) AS h FROM risks),
parts AS (SELECT *, coalesce({_LIFT('p')}, 0.05) AS vp, coalesce({_LIFT('q')}, 0.05) AS vq, CASE WHEN p IS NULL THEN 0 ELSE 0.35 * 0.75 END AS wp, CASE WHEN q IS NULL THEN 0 ELSE 0.35 * reliability END AS wq FROM formed),
logged AS (SELECT *, (wp * ln(least(greatest(vp, 0.05), 1)) + wq * ln(least(greatest(vq, 0.05), 1)) + 0.2 * ln(least(greatest(h, 0.05), 1)) + 0.1 * ln(least(greatest(lang_score, 0.05), 1)))::DOUBLE / (wp + wq + 0.3) AS base,
  (vp < 0.2 AND wp > 0)::INT + (vq < 0.2 AND wq > 0)::INT + (h < 0.2)::INT + (lang_score < 0.2)::INT AS weak FROM parts),
joint AS MATERIALIZED (SELECT pair_id, lang_pair, corpus, src_lang, tgt_lang, src_chars, tgt_chars, (jj IS NOT NULL)::INT AS llm_present,
  exp(CASE WHEN jj IS NULL THEN base ELSE 0.8 * base + 0.2 * ln(least(greatest({_LIFT('jj')}, 0.05), 1)) END) * CASE WHEN weak >= 2 THEN 0.5 ELSE 1 END * CASE WHEN copy >= 0.9 AND lang_score < 0.4 THEN 0.25 ELSE 1 END AS joint_score FROM logged)"""


#: What of the texts is calibrated by mid-ranks, besides lengths and punctuation.
_TEXT_RANKS = {"word_away": "r_words", "repeats": "r_repeat", **{f"{x}_{k}_word": f"r_{x}_{k}" for x in ("src", "tgt") for k in ("mean", "max")}}


def _joint(spark: SparkSession, d: str) -> DataFrame:
    """Joint scores of the rows that aren't rejected. Distributions are calibrated on all rows of a language pair."""
    rows = _base(spark, d).filter("reasons = 0")
    rows = rows.withColumn("logratio", F.ln(F.greatest("src_chars", F.lit(1)) / F.greatest("tgt_chars", F.lit(1)).cast("double")))
    rows = materialize(rows.withColumn("punct9", F.round(-F.col("punct_score") / F.log1p(F.greatest(F.least("src_chars", "tgt_chars"), F.lit(1)).cast("double")), 9)), "joint")
    # Both centres in one pass over the long form.
    long = rows.select("lang_pair", "logratio", "word_logratio").unpivot(["lang_pair"], ["logratio", "word_logratio"], "f", "v")
    centres = exact_quantiles(long, ["lang_pair", "f"], "v", {"centre": 0.5})
    wide = centres.groupBy("lang_pair").agg(*[F.max(F.when(F.col("f") == f, F.col("centre"))).alias(f"{f}_centre") for f in ("logratio", "word_logratio")])
    rows = join_table(rows, wide, ["lang_pair"], "left")
    for value, away in (("logratio", "away"), ("word_logratio", "word_away")):
        rows = rows.withColumn(away, F.round(F.abs(F.col(value) - F.col(f"{value}_centre")), 9)).drop(f"{value}_centre")
    rows = joint.mid_ranks_of(rows, "pair_id", ["lang_pair"], {"sim": "p", "qe": "q", "j": "jj", "away": "r_len", "punct9": "r_punct"} | _TEXT_RANKS)
    risk = lambda c: joint.tail_risk(F.col(c))
    structure = [risk("r_punct"), F.col("html"), *[risk(r) for c, r in _TEXT_RANKS.items() if c.endswith("_word")]]
    h = joint.form_score(F.greatest(risk("r_len"), risk("r_words")), F.col("copy"), risk("r_repeat"), F.col("numbers"), F.greatest(*structure))
    score = joint.joint_score(F.col("p"), F.col("q"), h, F.col("lang_score"), F.col("reliability"), F.lit(None).cast("double"), F.col("jj"), F.col("copy"))
    return rows.select("pair_id", "lang_pair", "corpus", "src_lang", "tgt_lang", "src_chars", "tgt_chars", F.col("jj").isNotNull().cast("int").alias("llm_present"), score.alias("joint_score"))


@query(f"WITH {_JOINT} SELECT * FROM joint")
def joint_scores(spark: SparkSession, d: str) -> DataFrame:
    return _joint(spark, d)


_BIN = f"least(floor(least(greatest(round(joint_score, 9), 0), 1) * {BINS}), {BINS - 1})::INT"
_HIST = f"{_JOINT}, hist AS (SELECT lang_pair, llm_present, {_BIN} AS bin, count(*) AS rows, CAST(sum(src_chars + tgt_chars) AS BIGINT) AS tokens FROM joint GROUP BY 1, 2, 3)"


def _rounded(spark: SparkSession, d: str) -> DataFrame:
    rows = _joint(spark, d).withColumn("joint_score", F.round("joint_score", 9)).withColumn("size", (F.col("src_chars") + F.col("tgt_chars")).cast("bigint"))
    return materialize(rows, "scored")


@query(f"WITH {_HIST} SELECT * FROM hist")
def joint_histogram(spark: SparkSession, d: str) -> DataFrame:
    return joint.score_histogram(_rounded(spark, d), ["lang_pair", "llm_present"], "joint_score", "size", BINS)


#: 60 % of all characters are to be kept; pairs keep at most what they have.
_BUDGET = f"""{_HIST}, vol AS (SELECT lang_pair, sum(tokens)::DOUBLE AS e, (sum(tokens) * 0.90)::DOUBLE AS b FROM hist GROUP BY 1), target AS (SELECT 0.6::DOUBLE * sum(e) AS t FROM vol),
level AS (SELECT (SELECT t FROM target) / sum(b) AS c FROM vol), budgets AS (SELECT lang_pair, least(e, c * b) AS budget FROM vol, level)"""


def _budgets(hist: DataFrame) -> DataFrame:
    volume = hist.groupBy("lang_pair").agg(F.sum("tokens").alias("tokens"))
    target = 0.6 * (hist.agg(F.sum("tokens")).first()[0] or 0)
    return joint.allocate_budget(volume, "lang_pair", "tokens", "tokens", target)


@query(f"WITH {_BUDGET} SELECT * FROM budgets")
def token_budgets(spark: SparkSession, d: str) -> DataFrame:
    hist = materialize(joint.score_histogram(_rounded(spark, d), ["lang_pair", "llm_present"], "joint_score", "size", BINS), "hist")
    return _budgets(hist)


_BOUNDARY = f"""{_BUDGET}, group_budget AS (SELECT lang_pair, llm_present, any_value(budget) * sum(tokens) / any_value(e) AS budget, sum(tokens) AS total FROM hist JOIN budgets USING (lang_pair) JOIN vol USING (lang_pair) GROUP BY 1, 2),
down AS (SELECT h.*, g.budget, g.total, sum(tokens) OVER (PARTITION BY h.lang_pair, h.llm_present ORDER BY bin DESC) AS to_here FROM hist h JOIN group_budget g ON g.lang_pair = h.lang_pair AND g.llm_present = h.llm_present),
boundaries AS (SELECT lang_pair, llm_present, bin AS boundary_bin, least((budget - (to_here - tokens)) / tokens::DOUBLE, 1) AS boundary_fraction FROM down WHERE to_here >= budget * (1 - 1e-12::DOUBLE) AND to_here - tokens < budget * (1 - 1e-12::DOUBLE))"""


def _boundaries(rows: DataFrame) -> DataFrame:
    keys = ["lang_pair", "llm_present"]
    hist = materialize(joint.score_histogram(rows, keys, "joint_score", "size", BINS), "hist")
    budgets = _budgets(hist)
    volume = hist.groupBy("lang_pair").agg(F.sum("tokens").alias("all"))
    groups = hist.groupBy(*keys).agg(F.sum("tokens").alias("part")).join(budgets, "lang_pair").join(volume, "lang_pair")
    groups = groups.select(*keys, (F.col("budget") * F.col("part") / F.col("all")).alias("budget"))
    return joint.budget_boundary(hist, groups, keys, "tokens", BINS)


@query(f"WITH {_BOUNDARY} SELECT * FROM boundaries")
def budget_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return _boundaries(_rounded(spark, d))


@query(f"""WITH {_BOUNDARY} SELECT j.lang_pair, count(*) FILTER ({_BIN} > boundary_bin) AS n_above, count(*) FILTER ({_BIN} = boundary_bin) AS n_at FROM joint j JOIN boundaries b ON b.lang_pair = j.lang_pair AND b.llm_present = j.llm_present GROUP BY 1""")
def boundary_counts(spark: SparkSession, d: str) -> DataFrame:
    return _boundary_counts(_rounded(spark, d))


def _boundary_counts(rows: DataFrame) -> DataFrame:
    code = score_bin(F.col("joint_score"), BINS)
    joined = rows.join(_boundaries(rows), ["lang_pair", "llm_present"])
    return joined.groupBy("lang_pair").agg(F.count_if(code > F.col("boundary_bin")).alias("n_above"), F.count_if(code == F.col("boundary_bin")).alias("n_at"))


def _selected(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = _rounded(spark, d)
    u = splitmix_uniform(F.lit(42), "lang_pair", F.lit("0"), "pair_id")
    return rows, joint.boundary_select(rows.withColumn("u", u), _boundaries(rows), ["lang_pair", "llm_present"], "joint_score", BINS, F.col("u")).drop("u")


_KEPT = f"""{_BOUNDARY}, {SALTS}, salted AS (SELECT j.*, s.salt FROM joint j JOIN salts s USING (lang_pair)), {mixed('salted', 'drawn', 'salt', 'pair_id')},
kept AS (SELECT d.* FROM drawn d JOIN boundaries b ON b.lang_pair = d.lang_pair AND b.llm_present = d.llm_present WHERE {_BIN} > boundary_bin OR ({_BIN} = boundary_bin AND u < boundary_fraction))"""


@query(f"WITH {_KEPT} SELECT pair_id, lang_pair, round(joint_score, 9) AS joint_score FROM kept")
def boundary_select(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d)[1].select("pair_id", "lang_pair", "joint_score")


_SUMS = "count(*) AS rows_before, count(*) FILTER (kept) AS rows_after, sum(size)::BIGINT AS chars_before, coalesce(sum(size) FILTER (kept), 0)::BIGINT AS chars_after"


@query(f"""WITH {_KEPT}, flagged AS MATERIALIZED (SELECT j.corpus, j.src_lang, j.tgt_lang, (j.src_chars + j.tgt_chars)::BIGINT AS size, k.pair_id IS NOT NULL AS kept FROM joint j LEFT JOIN kept k ON k.pair_id = j.pair_id),
langs AS (SELECT unnest(list_distinct([src_lang, tgt_lang])) AS language, size, kept FROM flagged)
SELECT 'corpus' AS kind, corpus AS name, {_SUMS} FROM flagged GROUP BY corpus UNION ALL SELECT 'language', language, {_SUMS} FROM langs GROUP BY language""")
def selection_rollups(spark: SparkSession, d: str) -> DataFrame:
    """Rows and characters before and after the selection by corpus and by language (a pair counts for both)."""
    rows, kept = _selected(spark, d)
    flagged = materialize(rows.join(kept.select("pair_id").withColumn("kept", F.lit(True)), "pair_id", "left").fillna(False, ["kept"]), "flagged")
    measures = {"rows_before": F.count("*"), "rows_after": F.count_if("kept"), "chars_before": F.sum("size"), "chars_after": F.sum(F.when(F.col("kept"), F.col("size")).otherwise(0))}
    by_corpus = flagged.groupBy("corpus").agg(*[m.alias(k) for k, m in measures.items()]).select(F.lit("corpus").alias("kind"), F.col("corpus").alias("name"), *measures)
    by_lang = joint.language_rollup(flagged, "src_lang", "tgt_lang", measures).select(F.lit("language").alias("kind"), F.col("language").alias("name"), *measures)
    return by_corpus.unionByName(by_lang)


@query(f"""WITH {_JOINT}, langs AS (SELECT DISTINCT pair_id, unnest([src_lang, tgt_lang]) AS language, src_chars + tgt_chars AS size FROM joint)
SELECT language, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS chars FROM langs GROUP BY 1""")
def language_rollup(spark: SparkSession, d: str) -> DataFrame:
    return joint.language_rollup(_joint(spark, d), "src_lang", "tgt_lang", {"n_rows": F.count("*"), "chars": F.sum((F.col("src_chars") + F.col("tgt_chars")).cast("bigint"))})


@query()
def fitted_cdfs(spark: SparkSession, d: str) -> DataFrame:
    """Knots of the similarity's distribution per language pair, from all its rows."""
    return joint.fit_cdfs(pairs(spark, d).filter("similarity_score is not null and lang_pair is not null"), ["lang_pair"], "similarity_score")


@query()
def outlier_filter(spark: SparkSession, d: str) -> DataFrame:
    """Inliers of each language pair's own isolation forest over all features."""
    rows = materialize(features(spark, d), "features")
    scored = outlier.score_by_group(rows, "lang_pair", FEATURES, ["pair_id", "ingested_at"])
    return scored.filter("not is_outlier").select("pair_id", "lang_pair", "anomaly")


# --- samples and plans ------------------------------------------------------------------------------------------------
@query(f"WITH {PAIRS} SELECT lang_pair, least(count(*), 25) AS n FROM pairs GROUP BY 1")
def sample_sizes(spark: SparkSession, d: str) -> DataFrame:
    """A sample of 25 rows of each pair, counted."""
    return sampling.sample_k(pairs(spark, d), ["lang_pair"], 25, 7, "pair_id", "ingested_at").groupBy("lang_pair").agg(F.count("*").alias("n"))


@query(f"WITH {PAIRS}, {hashed('pairs', 'drawn', 7, 'pair_id', 'epoch_us(ingested_at)')} SELECT pair_id, lang_pair FROM drawn QUALIFY row_number() OVER (PARTITION BY lang_pair ORDER BY u, pair_id, ingested_at) <= 25")
def sample_k(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_k(pairs(spark, d), ["lang_pair"], 25, 7, "pair_id", "ingested_at").select("pair_id", "lang_pair")


@query(f"WITH {hashed('bitext', 'drawn', 3, 'pair_id', 'epoch_us(ingested_at)')} SELECT pair_id FROM drawn WHERE u < 0.1")
def fraction_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.fraction_sample(table(spark, d, "bitext"), 0.1, 3, "pair_id", "ingested_at").select("pair_id")


@query(f"""WITH {PAIRS}, s AS (SELECT lang_pair, corpus, count(*) AS n FROM pairs WHERE corpus IS NOT NULL AND lang_pair IS NOT NULL GROUP BY 1, 2)
SELECT lang_pair, corpus, CAST(least(n, floor(n * 40 / sum(n) OVER (PARTITION BY lang_pair)::DOUBLE + 0.5)) AS BIGINT) AS n FROM s QUALIFY least(n, floor(n * 40 / sum(n) OVER (PARTITION BY lang_pair)::DOUBLE + 0.5)) > 0""")
def proportional_sizes(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).filter("corpus is not null and lang_pair is not null")
    return sampling.proportional_sample(rows, ["lang_pair"], "corpus", 40, 5, "pair_id", "ingested_at").groupBy("lang_pair", "corpus").agg(F.count("*").alias("n"))


_LOGW = f"""{SCORES}, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY ingested_at) AS k FROM bitext) WHERE k = 1),
w AS (SELECT o.pair_id, 2.0::DOUBLE * (least(greatest(coalesce(o.similarity_score::DOUBLE, 0), 0), 1) + least(greatest(coalesce(s.qe_score, 0), 0), 1) + ln(1 + least(greatest(least(coalesce(length(source_text), 0), coalesce(length(target_text), 0)), 0), 512)::DOUBLE) / ln(513::DOUBLE)) AS log_weight
FROM one o LEFT JOIN (SELECT * FROM scores WHERE qe_model = 'cometkiwi-da-xl') s USING (pair_id))"""


def _weights(spark: SparkSession, d: str) -> DataFrame:
    one = keep_one(table(spark, d, "bitext").select("pair_id", "ingested_at", "similarity_score", "source_text", "target_text", "src_lang", "tgt_lang"), ["pair_id"], ["ingested_at"])
    qe = scores(spark, d).filter("qe_model = 'cometkiwi-da-xl'").select("pair_id", "qe_score")
    w = sampling.quality_log_weight(F.col("similarity_score"), F.col("qe_score"), F.length("source_text"), F.length("target_text"), 2.0)
    return one.join(qe, "pair_id", "left").select("pair_id", "src_lang", "tgt_lang", w.alias("log_weight"))


@query(f"WITH {_LOGW} SELECT * FROM w")
def quality_weights(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d).select("pair_id", "log_weight")


@query(f"""WITH {_LOGW}, target AS (SELECT count(*) // 10 AS t FROM w),
hist AS (SELECT least(floor(log_weight / 6.0::DOUBLE * {sampling.WEIGHT_BINS}), {sampling.WEIGHT_BINS - 1}) AS bin, count(*) AS n, avg(exp(log_weight)) AS x FROM w GROUP BY 1),
steps AS (SELECT x, n, coalesce(sum(n) OVER (ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above, sum(x * n) OVER (ORDER BY x DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM hist),
scale AS (SELECT first((t - above) / rest ORDER BY x DESC) AS k FROM steps, target WHERE (t - above) / rest * x <= 1 + 1e-12),
chances AS (SELECT pair_id, least(1.0::DOUBLE, exp(log_weight) * k) AS probability FROM w, scale),
summed AS (SELECT *, round(probability * 1e9)::BIGINT AS p9, sum(round(probability * 1e9)::BIGINT) OVER (ORDER BY pair_id)::BIGINT AS to_here FROM chances)
SELECT pair_id, probability FROM summed WHERE floor(to_here / 1e9::DOUBLE - 0.5) > floor((to_here - p9) / 1e9::DOUBLE - 0.5)""")
def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of all pairs, better and longer ones preferred."""
    rows = materialize(_weights(spark, d).withColumn("all", F.lit(1)), "weights")
    chosen = sampling.weighted_probabilities(rows, "log_weight", 6.0, rows.count() // 10)
    return sampling.systematic_sample(chosen, ["all"], [F.col("pair_id")], "probability").select("pair_id", "probability")


@query(f"""WITH {PAIRS}, {hashed('pairs', 'drawn', 11, 'pair_id', 'epoch_us(ingested_at)')}, rated AS (SELECT lang_pair, u, 150 / (count(*) OVER (PARTITION BY lang_pair))::DOUBLE AS rate FROM drawn WHERE lang_pair IS NOT NULL),
copied AS (SELECT lang_pair, floor(rate)::INT + (u < rate - floor(rate))::INT AS copies FROM rated) SELECT lang_pair, sum(copies)::BIGINT AS n_copies, max(copies)::INT AS most FROM copied WHERE copies > 0 GROUP BY 1""")
def upsampled(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).filter("lang_pair is not null").select("pair_id", "ingested_at", "lang_pair")
    targets = rows.select("lang_pair").distinct().withColumn("target", F.lit(150))
    return sampling.repeat_to(rows, ["lang_pair"], targets, 11, "pair_id", "ingested_at").groupBy("lang_pair").agg(F.count("*").alias("n_copies"), F.max("copy_no").alias("most"))


@query("SELECT DISTINCT sample_id, corpus, version FROM eval_sample")
def shuffled_samples(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "eval_sample").select("sample_id", "corpus", "version").distinct()
    return sampling.shuffled(rows, 13, "sample_id")


@query("""WITH both_files AS (SELECT sample_id AS id, lang1_text AS a, lang2_text AS b, lang1_code AS x, lang2_code AS y FROM eval_sample UNION ALL SELECT pair_id, source_text, target_text, src_lang, tgt_lang FROM bitext),
turned AS (SELECT *, coalesce(y = 'eng_Latn' AND coalesce(x, '') <> 'eng_Latn', false) AS turn FROM both_files)
SELECT id, CASE WHEN turn THEN b ELSE a END AS first_text, CASE WHEN turn THEN a ELSE b END AS second_text, CASE WHEN turn THEN y ELSE x END AS first_lang, CASE WHEN turn THEN x ELSE y END AS second_lang FROM turned""")
def oriented_samples(spark: SparkSession, d: str) -> DataFrame:
    """Two files of pairs put together, turned to English first, and shuffled."""
    names = ["id", "first_text", "second_text", "first_lang", "second_lang"]
    a = table(spark, d, "eval_sample").select("sample_id", "lang1_text", "lang2_text", "lang1_code", "lang2_code").toDF(*names)
    b = table(spark, d, "bitext").select("pair_id", "source_text", "target_text", "src_lang", "tgt_lang").toDF(*names)
    turned = sampling.oriented(a.unionByName(b), {"first_text": "second_text"}, "first_lang", "second_lang")
    return sampling.shuffled(turned, 17, *names)


@query(r"""WITH src AS (SELECT dataset, target_pair, source_pair, coalesce(n_lines, 0) AS n_lines, coalesce(total_tokens, 0) AS total_tokens FROM source_plan
  QUALIFY row_number() OVER (PARTITION BY dataset, target_pair, source_pair ORDER BY planned_at DESC NULLS LAST, coalesce(n_lines, 0) DESC, coalesce(total_tokens, 0) DESC) = 1),
q AS (SELECT dataset, target_pair, max(quota) AS quota FROM pair_plan GROUP BY 1, 2),
j AS (SELECT src.*, quota, CASE WHEN len(string_split(source_pair, '-')) = 2 AND list_contains(string_split(source_pair, '-'), 'eng_Latn') THEN string_split(source_pair, '-')[1] = 'eng_Latn' END AS eng_is_source FROM src JOIN q USING (dataset, target_pair) WHERE quota IS NOT NULL),
marked AS (SELECT *, CASE WHEN eng_is_source IS NULL THEN 'no eng side' WHEN NOT (n_lines > 0 AND total_tokens > 0) THEN 'empty stats' END AS warning FROM j),
good AS (SELECT *, total_tokens::HUGEINT AS cap, row_number() OVER (g ORDER BY total_tokens, source_pair) - 1 AS k, count(*) OVER g AS n, sum(total_tokens::HUGEINT) OVER g AS whole, coalesce(sum(total_tokens::HUGEINT) OVER (g ORDER BY total_tokens, source_pair ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS poured
  FROM marked WHERE warning IS NULL WINDOW g AS (PARTITION BY dataset, target_pair)),
filled AS (SELECT *, poured + cap * (n - k) <= least(quota, whole) AS is_full, greatest(quota - whole, 0) AS extra FROM good),
level AS (SELECT *, sum(is_full::INT) OVER g AS n_full, greatest(least(quota, whole) - coalesce(sum(cap) FILTER (is_full) OVER g, 0), 0) AS rest, extra * cap // greatest(whole, 1) AS units, extra * cap % greatest(whole, 1) AS remainder FROM filled WINDOW g AS (PARTITION BY dataset, target_pair)),
shares AS (SELECT *, CASE WHEN is_full THEN cap ELSE rest // (n - n_full) + (k - n_full >= (n - n_full) - rest % (n - n_full))::INT END + units + (row_number() OVER (g ORDER BY remainder DESC, source_pair) <= extra - sum(units) OVER g)::INT AS alloc FROM level WINDOW g AS (PARTITION BY dataset, target_pair))
SELECT m.dataset, m.target_pair, m.source_pair, s.alloc::BIGINT AS alloc_tokens, round_even(s.alloc / (m.total_tokens / m.n_lines::DOUBLE), 0)::BIGINT AS rows_to_sample, m.eng_is_source, m.warning
FROM marked m LEFT JOIN shares s ON s.dataset = m.dataset AND s.target_pair = m.target_pair AND s.source_pair = m.source_pair""")
def extraction_plan(spark: SparkSession, d: str) -> DataFrame:
    """Allocations of the sources of every dataset under its quotas."""
    sources = table(spark, d, "source_plan").groupBy("dataset", "target_pair", "source_pair").agg(F.max(F.struct("planned_at", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"))).alias("r"))
    sources = sources.select("dataset", "target_pair", "source_pair", "r.n_lines", "r.total_tokens")
    quotas = table(spark, d, "pair_plan").groupBy("dataset", "target_pair").agg(F.max("quota").alias("quota"))
    return budget.extraction_plan(sources, quotas)


_NAMES = {"eng_Latn": "English", "deu_Latn": "German", "fra_Latn": "French", "fin_Latn": "Finnish"}
_NAMED = lambda c: f"CASE {c} {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in _NAMES.items())} ELSE {c} END"


@query(f"""WITH {PAIRS}, n AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY lang_pair) AS total FROM pairs WHERE source_text IS NOT NULL AND target_text IS NOT NULL AND lang_pair IS NOT NULL WINDOW w AS (PARTITION BY lang_pair ORDER BY ingested_at, pair_id)),
h AS (SELECT *, ceil(total / 2.0) AS half, src_lang = 'eng_Latn' OR tgt_lang = 'eng_Latn' AS eng FROM n), p AS (SELECT *, eng AND k > half AS back FROM h),
q AS (SELECT *, {_NAMED('src_lang')} || ': ' || source_text AS s, {_NAMED('tgt_lang')} || ': ' || target_text AS t, CASE WHEN back THEN ceil(half / 3.0) + floor((k - half - 1) / 3) ELSE floor((k - 1) / 3) END::BIGINT AS line_no, CASE WHEN eng THEN (src_lang = 'eng_Latn') = NOT back ELSE true END AS forward FROM p)
SELECT lang_pair, line_no, string_agg(CASE WHEN forward THEN s || chr(10) || t ELSE t || chr(10) || s END, chr(10) || chr(10) ORDER BY k) AS text FROM q GROUP BY 1, 2""")
def training_lines_query(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs(spark, d).filter("lang_pair is not null").select("pair_id", "ingested_at", "lang_pair", "src_lang", "tgt_lang", "source_text", "target_text")
    return training_lines(rows, ["lang_pair"], [F.col("ingested_at"), F.col("pair_id")], "src_lang", "tgt_lang", "source_text", "target_text", _NAMES, 3)
