"""A joint score of similarity, quality, text form and language, and selection under a token budget."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import NO_SPACE_SCRIPTS, lcs_ratio, letter_count, numeral_score, repetition_score, script_share, strip, word_sizes
from corpusloom.functions.values import clip, finite, score_bin
from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import running_sum, value_ranks
from corpusloom.storage import materialize

#: Reasons for which a row is rejected outright, as bits.
EMPTY_TEXT, COPY_WRONG_SCRIPT, LID_WRONG_SCRIPT, MISSING_SEMANTICS = 1, 2, 4, 8
#: Language roots with another name elsewhere.
ROOT_ALIASES = {"zho": "cmn", "ara": "arb", "fas": "pes", "nor": "nob", "msa": "zsm", "fil": "tgl", "sqi": "als"}

#: Scripts in which words aren't measured, and the letters below which equal texts are no copy.
NO_WORD_SCRIPTS, LEAST_COPY_LETTERS = (*NO_SPACE_SCRIPTS, "Hani"), 12


@dataclass(frozen=True)
class JointConfig:
    weights: dict[str, float] = field(default_factory=lambda: {"P": 0.35, "Q": 0.35, "H": 0.20, "L": 0.10})
    llm_weight: float = 0.20
    floor: float = 0.05
    tail_start: float = 0.80
    weak_threshold: float = 0.20
    weak_penalty: float = 0.50
    copy_penalty: float = 0.25
    copy_risk: float = 0.90
    copy_language: float = 0.40
    script_share: float = 0.20
    copy_letters: int = 20
    lid_letters: int = 40
    lid_confidence: float = 0.90
    volume_edges: tuple[float, ...] = (1e8, 1e9, 1e10)
    volume_rates: tuple[float, ...] = (0.90, 0.80, 0.61, 0.60)


def language_root(code: Column) -> Column:
    root = F.split_part(code, F.lit("_"), F.lit(1))
    out = root
    for a, b in ROOT_ALIASES.items():
        out = F.when(root == a, b).otherwise(out)
    return out


def script_of(code: Column) -> Column:
    script = F.substring_index(code, "_", -1)
    return F.when(script.isin("Hans", "Hant", "Hani"), "Han").otherwise(script)


def language_sign(expected: Column, predicted: Column) -> Column:
    """1 if a prediction is compatible in root and script, -1 if not, 0 without a prediction."""
    fits = (language_root(expected) == language_root(predicted)) & (script_of(expected) == script_of(predicted))
    return F.when(predicted.isNull() | ~predicted.contains("_"), 0).when(fits, 1).otherwise(-1)


def language_evidence(expected: Column, predictions: list[tuple[Column, Column]]) -> Column:
    """In [0, 1]: the mean of the signed confidences of two models, 0.5 without any evidence."""
    total = F.lit(0.0)
    for label, confidence in predictions:
        total = total + language_sign(expected, label) * F.coalesce(clip(finite(confidence.cast("double")), 0.0, 1.0), F.lit(0.0))
    return (1 + total / len(predictions)) / 2


def wrong_script(text: Column, lang: Column, least_letters: int, share: float) -> Column:
    script = F.substring_index(lang, "_", -1)
    return F.coalesce((letter_count(text) >= least_letters) & (script_share(text, script) < share), F.lit(False))


def _bits(*flags: tuple[Column, int]) -> Column:
    bits = F.lit(0)
    for flag, bit in flags:
        bits = bits.bitwiseOR(F.when(F.coalesce(flag, F.lit(False)), bit).otherwise(0))
    return bits


def text_reasons(source: Column, target: Column, source_lang: Column, target_lang: Column, same: Column, lid_bad: tuple[Column, ...] = (),
                 config: JointConfig = JointConfig()) -> Column:
    """Bits of the reasons that a row's texts give to reject it. ``lid_bad``: per side, whether both models agree with
    confidence on another language."""
    empty = F.coalesce(strip(source) == "", F.lit(True)) | F.coalesce(strip(target) == "", F.lit(True))
    copy = ~empty & F.coalesce(same, F.lit(False)) & (script_of(source_lang) != script_of(target_lang)) & (
        wrong_script(source, source_lang, config.copy_letters, config.script_share) | wrong_script(target, target_lang, config.copy_letters, config.script_share)
    )
    lid = F.lit(False)
    for bad, text, lang in zip(lid_bad, (source, target), (source_lang, target_lang)):
        lid = lid | (~empty & F.coalesce(bad, F.lit(False)) & wrong_script(text, lang, config.lid_letters, config.script_share))
    return _bits((empty, EMPTY_TEXT), (copy, COPY_WRONG_SCRIPT), (lid, LID_WRONG_SCRIPT))


def semantic_reasons(sim: Column, qe: Column) -> Column:
    return _bits((finite(sim.cast("double")).isNull() & finite(qe.cast("double")).isNull(), MISSING_SEMANTICS))


def rejection_reasons(source: Column, target: Column, source_lang: Column, target_lang: Column, same: Column, sim: Column, qe: Column,
                      lid_bad: tuple[Column, ...] = (), config: JointConfig = JointConfig()) -> Column:
    """Bits of all reasons to reject a row, 0 for none."""
    return text_reasons(source, target, source_lang, target_lang, same, lid_bad, config).bitwiseOR(semantic_reasons(sim, qe))


def text_signals(source: Column, target: Column, source_lang: Column, target_lang: Column, same: Column) -> dict[str, Column]:
    """``copy`` and ``numbers``, risks in [0, 1], and what is yet to be calibrated: ``repeats``, ``word_logratio`` and each
    side's mean and longest word, null in scripts without spaces.

    The overlap of a copy is the larger of subsequence ratio and edit similarity. That is always the former: an alignment
    of distance d has longer - d equal characters, so the subsequence over the shorter is at least 1 - d / longer."""
    # Letters and digits are looked for only where they decide.
    letters = F.least(letter_count(source), letter_count(target))
    overlap, found = F.when(same, 1.0).otherwise(lcs_ratio(source, target)), clip(numeral_score(source, target), 0.0, 1.0)
    copy = F.when((overlap > 0.8) & (letters >= LEAST_COPY_LETTERS), clip((overlap - 0.8) / 0.2, 0.0, 1.0)).otherwise(0.0)
    numbers = F.when((found < 1) & (source.rlike(r"\p{Nd}") | target.rlike(r"\p{Nd}")), 1 - found).otherwise(0.0)
    spaced = [~F.substring_index(lang, "_", -1).isin(*NO_WORD_SCRIPTS) for lang in (source_lang, target_lang)]
    s, t = word_sizes(source), word_sizes(target)
    logratio = F.ln(F.greatest(s["n"], F.lit(1)) / F.greatest(t["n"], F.lit(1)).cast("double"))
    return {
        "copy": copy, "numbers": numbers, "repeats": F.greatest(repetition_score(source), repetition_score(target)), "word_logratio": F.when(spaced[0] & spaced[1], logratio),
        **{f"{x}_{k}_word": F.when(on, w[k]) for x, on, w in (("src", spaced[0], s), ("tgt", spaced[1], t)) for k in ("mean", "max")},
    }


# --- calibration ------------------------------------------------------------------------------------------------------


def mid_ranks(rows: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the empirical distribution function at ``value`` within the group, ties at their middle; null
    for null values. Ranks come from slices, so a group or a value of any size is spread over the cluster."""
    middle = (2 * F.col("_less") + F.col("_equal")) / (2 * F.col("_all"))
    ranked = value_ranks(rows, group, value).select(*rows.columns, middle.alias(name))
    return ranked.unionByName(rows.filter(F.col(value).isNull()).withColumn(name, F.lit(None).cast("double")))


def mid_ranks_of(rows: DataFrame, row_id: str, group: list[str], values: dict[str, str]) -> DataFrame:
    """``rows`` with the mid-rank distribution function of several columns (``values``: column to new column) at once:
    all go through one sort in long form. ``row_id`` must be unique and not null."""
    long = rows.select(row_id, *group, *[F.col(v).cast("double").alias(v) for v in values]).unpivot([row_id, *group], list(values), "_f", "_v")
    ranked = mid_ranks(long.filter("_v is not null"), [*group, "_f"], "_v", "_r")
    wide = ranked.groupBy(row_id).agg(*[F.max(F.when(F.col("_f") == v, F.col("_r"))).alias(name) for v, name in values.items()])
    return rows.join(wide, row_id, "left")


def fit_cdfs(rows: DataFrame, group: list[str], value: str, knots: int = 257) -> DataFrame:
    """``group, x, p, n``: up to ``knots`` distinct quantiles ``x`` of all finite values of each group, the share ``p`` of
    values below each plus half of those equal to it, and the number of values.

    From counts of distinct values and their running sums, so that no task holds a whole group. Null groups are groups
    of their own; a group without a finite value has empty arrays."""
    finite_rows = rows.select(*group, finite(F.col(value).cast("double")).alias("_v"))
    counted = materialize(finite_rows.filter("_v is not null").groupBy(*group, "_v").agg(F.count("*").alias("_n")), "counted")
    sizes = finite_rows.groupBy(*group).agg(F.count("_v").alias("n"))
    ranked = running_sum(counted, group, [F.col("_v")], F.col("_n"), "_to", "n")
    # The quantile k lies between the places floor(at) and ceil(at), counted from 0; a value holds the places [_to - _n, _to).
    steps, last = F.lit(knots - 1), F.col("n") - 1
    at = F.col("_k") * last / steps
    first = F.when(last > 0, F.greatest(F.floor((F.col("_to") - F.col("_n") - 1) * steps / last), F.lit(0))).otherwise(0)
    final = F.when(last > 0, F.least(F.ceil(F.col("_to") * steps / last), steps)).otherwise(steps)
    held = lambda place: (place < F.col("_to")) & (place >= F.col("_to") - F.col("_n"))
    near = ranked.withColumn("_k", F.explode(F.sequence(first.cast("int"), final.cast("int")))).withColumn("_at", at)
    entry = F.struct("_v", "_n", "_to")
    ends = near.groupBy(*group, "_k").agg(*[F.max(F.when(held(place), entry)).alias(e) for e, place in (("_a", F.floor("_at")), ("_b", F.ceil("_at")))], F.max(F.col("_at") - F.floor("_at")).alias("_f"), F.max("n").alias("n"))
    a, b, f = F.col("_a._v"), F.col("_b._v"), F.col("_f")
    x = F.when(f < 0.5, a + (b - a) * f).otherwise(b - (b - a) * (1 - f))
    mid = lambda e: (2 * F.col(f"{e}._to") - F.col(f"{e}._n"))
    points = ends.withColumn("_x", x).withColumn("_p", F.when(F.col("_x") == a, mid("_a")).when(F.col("_x") == b, mid("_b")).otherwise(2 * F.col("_a._to")) / (2 * F.col("n")))
    found = points.groupBy(*group).agg(F.array_sort(F.collect_set(F.struct("_x", "_p"))).alias("_points"))
    out = join_groups(sizes, found, group, "left")
    none = F.array().cast("array<double>")
    return out.select(*group, F.coalesce("_points._x", none).alias("x"), F.coalesce("_points._p", none).alias("p"), "n")


def cdf_at(value: Column, x: Column, p: Column) -> Column:
    """The knots' piecewise linear function: 0 left of them, 1 right of them, 0.5 for a missing value or no knots."""
    i = F.size(F.filter(x, lambda k: k < value))
    x0, x1, p0, p1 = F.get(x, i - 1), F.get(x, i), F.get(p, i - 1), F.get(p, i)
    inside = F.when(x1 == value, p1).otherwise(p0 + (p1 - p0) * F.try_divide(value - x0, x1 - x0))
    missing = value.isNull() | F.isnan(value) | x.isNull() | (F.size(x) == 0)
    return F.when(missing, 0.5).when(value < F.get(x, F.lit(0)), 0.0).when(i == F.size(x), 1.0).otherwise(inside)


# --- score ------------------------------------------------------------------------------------------------------------


def tail_risk(distribution: Column, config: JointConfig = JointConfig()) -> Column:
    """How far a value lies in the upper tail, 0 to 1; a missing one 0."""
    return F.coalesce(clip((distribution - config.tail_start) / (1 - config.tail_start), 0.0, 1.0), F.lit(0.0))


def form_score(length: Column, copy: Column, repeat: Column, numbers: Column, structure: Column, config: JointConfig = JointConfig()) -> Column:
    risks = [F.coalesce(r, F.lit(0.0)) for r in (length, copy, repeat, numbers, structure)]
    return clip(1 - 0.7 * F.greatest(*risks) - 0.3 * sum(risks[1:], risks[0]) / len(risks), config.floor, 1.0)


def joint_score(p: Column, q: Column, h: Column, lang: Column, reliability: Column, mrr: Column, j: Column, copy: Column, config: JointConfig = JointConfig()) -> Column:
    """Weighted geometric mean of the four parts. ``p``, ``q`` and ``j`` are distribution values, null where missing.

    Similarity weighs less where the embedding is unknown (0.75) or poor (0.5); quality by how far the model saw the
    languages. A judge's score, where there is one, has ``llm_weight``. Two weak parts or a suspected copy are
    penalised."""
    c, lift = config, lambda v: config.floor + (1 - config.floor) * v
    trust = F.when(mrr.isNull(), 0.75).when(mrr < 0.8, 0.5).otherwise(1.0)
    parts = {"P": lift(p), "Q": lift(q), "H": h, "L": lang}
    weight = {
        "P": c.weights["P"] * F.when(p.isNotNull(), trust).otherwise(0.0), "Q": c.weights["Q"] * F.when(q.isNotNull(), reliability).otherwise(0.0),
        "H": F.lit(c.weights["H"]), "L": F.lit(c.weights["L"]),
    }
    total, logs, weak = F.lit(0.0), F.lit(0.0), F.lit(0)
    for k, v in parts.items():
        v = F.coalesce(v, F.lit(c.floor))
        total, logs = total + weight[k], logs + weight[k] * F.ln(clip(v, c.floor, 1.0))
        weak = weak + ((v < c.weak_threshold) & (weight[k] > 0)).cast("int")
    base = logs / total
    blended = F.when(j.isNotNull(), (1 - c.llm_weight) * base + c.llm_weight * F.ln(clip(lift(j), c.floor, 1.0))).otherwise(base)
    score = F.exp(blended) * F.when(weak >= 2, c.weak_penalty).otherwise(1.0)
    return score * F.when((copy >= c.copy_risk) & (lang < c.copy_language), c.copy_penalty).otherwise(1.0)


# --- budget -----------------------------------------------------------------------------------------------------------


def score_histogram(rows: DataFrame, keys: list[str], score: str, tokens: str, bins: int) -> DataFrame:
    return rows.groupBy(*keys, score_bin(F.col(score), bins).alias("bin")).agg(F.count("*").alias("rows"), F.sum(tokens).alias("tokens"))


def scale_to_totals(hist: DataFrame, totals: DataFrame, keys: list[str], weight: str, total: str) -> DataFrame:
    """``hist`` with ``weight`` scaled so that it sums to each group's known ``total``; a group without a known total
    (null or not positive), or without weight, keeps its own. One row a bin."""
    own = hist.groupBy(*keys).agg(F.sum(weight).alias("_own"))
    known = join_groups(own, totals.select(*keys, F.col(total).cast("double").alias("_known")), keys, "left")
    factor = F.when((F.col("_known") > 0) & (F.col("_own") > 0), F.col("_known") / F.col("_own")).otherwise(1.0)
    return join_groups(hist, known.select(*keys, factor.alias("_factor")), keys).withColumn(weight, F.col(weight) * F.col("_factor")).drop("_factor")


def volume_rate(original: Column, config: JointConfig = JointConfig()) -> Column:
    """Keep rate of a volume tier; a volume on an edge belongs to the tier above."""
    rate = F.lit(config.volume_rates[-1])
    for edge, r in reversed(list(zip(config.volume_edges, config.volume_rates))):
        rate = F.when(original < edge, r).otherwise(rate)
    return rate


def allocate_budget(pairs: DataFrame, key: str, original: str, eligible: str, target: float, config: JointConfig = JointConfig()) -> DataFrame:
    """``key, budget``: min(eligible, c * original * rate), with the c at which the budgets sum to the target.

    Exact, without iteration: pairs are sorted by the c at which they run full; the right c follows from running sums.
    One row a pair, so one window orders them all. A target beyond all that is eligible gives everything.
    """
    base = (F.col(original) * volume_rate(F.col(original), config)).alias("b")
    rows = pairs.select(key, F.col(eligible).cast("double").alias("e"), base).withColumn("full_at", F.when(F.col("b") > 0, F.col("e") / F.col("b")))
    w = Window.orderBy(F.col("full_at").asc_nulls_last(), key)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    onward = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    steps = rows.withColumn("filled", F.coalesce(F.sum("e").over(before), F.lit(0.0))).withColumn("open_base", F.sum("b").over(onward))
    # Of the places at which it does, the first gives the largest c.
    c = F.max(F.when((F.col("open_base") > 0) & (F.col("filled") + F.col("full_at") * F.col("open_base") >= target), (target - F.col("filled")) / F.col("open_base")))
    level = steps.agg(c.alias("c"))
    joined = rows.crossJoin(F.broadcast(level))  # one row
    return joined.select(key, F.when(F.lit(target) <= 0, 0.0).when(F.col("c").isNull(), F.col("e")).otherwise(F.least(F.col("e"), F.greatest(F.col("c"), F.lit(0.0)) * F.col("b"))).alias("budget"))


def budget_boundary(hist: DataFrame, budgets: DataFrame, keys: list[str], weight: str, bins: int) -> DataFrame:
    """``keys, boundary_bin, boundary_fraction``: bins above the boundary are kept whole, the boundary bin in part.

    A budget of 0 or less keeps nothing (bin = ``bins``), one of all keeps everything (bin -1, fraction 1). A budget that
    ends with a bin but for the last digits takes that bin whole, whatever the order in which it was summed up. At most
    ``bins`` rows a group reach the window.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("bin"))
    total = hist.groupBy(*keys).agg(F.sum(weight).alias("total"))
    sums = hist.withColumn("to_here", F.sum(weight).over(w)).join(budgets.select(*keys, "budget"), keys).join(total, keys)
    least = F.col("budget") * (1 - 1e-12)
    hit = (F.col("to_here") >= least) & (F.col("to_here") - F.col(weight) < least)
    fraction = clip((F.col("budget") - (F.col("to_here") - F.col(weight))) / F.nullif(F.col(weight), F.lit(0)), 0.0, 1.0)
    found = sums.groupBy(*keys).agg(F.first("budget").alias("b"), F.first("total").alias("t"), F.max(F.when(hit, F.struct(F.col("bin").alias("bin"), fraction.alias("f")))).alias("at"))
    nothing, everything = (F.col("b") <= 0) | (F.col("t") <= 0), F.col("b") >= F.col("t") * (1 - 1e-12)
    return found.select(*keys, F.when(nothing, bins).when(everything, -1).otherwise(F.col("at.bin")).alias("boundary_bin"),
                        F.when(nothing, 0.0).when(everything, 1.0).otherwise(F.col("at.f")).alias("boundary_fraction"))


def boundary_select(rows: DataFrame, boundaries: DataFrame, keys: list[str], score: str, bins: int, uniform: Column) -> DataFrame:
    """Rows above their group's boundary bin, and of that bin those whose uniform number is below the fraction."""
    code = score_bin(F.col(score), bins)
    joined = rows.join(boundaries, keys)
    keep = (code > F.col("boundary_bin")) | ((code == F.col("boundary_bin")) & (uniform < F.col("boundary_fraction")))
    return joined.filter(keep).select(*rows.columns)


def language_rollup(rows: DataFrame, source_lang: str, target_lang: str, measures: dict[str, Column]) -> DataFrame:
    """Sums by language over all pairs it takes part in; a pair counts for both its languages, so sums aren't additive."""
    langs = F.array_distinct(F.array(source_lang, target_lang))
    return rows.withColumn("language", F.explode(langs)).groupBy("language").agg(*[m.alias(k) for k, m in measures.items()])
