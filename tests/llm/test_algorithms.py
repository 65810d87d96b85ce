"""Cutoffs, caps, ranking and mixing against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import capping, cutoff, mixing, ranking, scores


# --- cutoffs ----------------------------------------------------------------------------------------------------------
def brute_kth(data, g, k):
    v = sorted((x for h, x in data if h == g and x is not None), reverse=True)
    return (v[k - 1], sum(x > v[k - 1] for x in v)) if 1 <= k <= len(v) else None


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_kth_value(spark, kind):
    rnd = random.Random(1)
    if kind == "double":
        pool = [0.0, -0.5, 1e-320, 5e-324, 1e308, -1e308, 0.1, 0.1 + 1e-16, 3.0, 3.0000000000000004]
        draw = lambda: rnd.choice(pool) if rnd.random() < 0.5 else rnd.gauss(0, 1)
    else:
        pool = [0, 1, 2, 2**63 - 1, -(2**63), 2**62, 2**62 + 1, -5]
        draw = lambda: rnd.choice(pool) if rnd.random() < 0.5 else rnd.randint(-1000, 1000)
    data = [(rnd.choice(["a", "b", None]), None if rnd.random() < 0.05 else draw()) for _ in range(600)] + [("one", pool[0])]
    df = spark.createDataFrame(data, f"g string, v {kind}").withColumn("k", F.lit("clash")).cache()
    for k in (1, 2, 57, 150, 700):
        ranks = spark.createDataFrame([(g, k) for g in ("a", "b", None, "one", "none")], "g string, k int")
        got = {r.g: (r.cutoff, r.above) for r in cutoff.kth_value(df, "g", "v", ranks, bins=8).collect()}
        want = {g: brute_kth(data, g, k) for g in ("a", "b", None, "one", "none")}
        assert got == {g: w for g, w in want.items() if w is not None}


def test_kth_edges(spark):
    df = spark.createDataFrame([("a", 1.0)] * 500 + [("b", None)], "g string, v double")
    ranks = spark.createDataFrame([("a", 250), ("a", 0), ("b", 1)], "g string, k int")
    assert [(r.g, r.cutoff, r.above) for r in cutoff.kth_value(df, "g", "v", ranks).collect()] == [("a", 1.0, 0)]
    assert cutoff.kth_value(df.filter("false"), "g", "v", ranks).count() == 0
    with pytest.raises(TypeError):
        cutoff.kth_value(df.withColumn("v", F.lit("x")), "g", "v", ranks)


def test_keep_fraction(spark):
    rnd = random.Random(2)
    data = [(i, rnd.choice(["up", "down"]), rnd.choice([None, *range(10)])) for i in range(500)] + [(900, "zero", 1), (901, "other", 1)]
    df = spark.createDataFrame([(i, s, None if v is None else float(v)) for i, s, v in data], "id int, src string, score double").withColumn("k", F.lit("clash")).withColumn("keep_permille", F.lit(7))
    fr = spark.createDataFrame([("up", 155, True), ("down", 333, False), ("zero", 0, True)], "src string, keep_permille int, higher_is_better boolean")
    report, kept = cutoff.keep_fraction(df, "src", "score", fr)
    kept = {r.id for r in kept.collect()}
    report = {r.src: r for r in report.collect()}
    for s, permille, up in (("up", 155, True), ("down", 333, False)):
        v = sorted((x for _, t, x in data if t == s and x is not None), reverse=up)
        k = -(-len(v) * permille // 1000)
        cut = v[k - 1]
        assert kept & {i for i, t, _ in data if t == s} == {i for i, t, x in data if t == s and x is not None and (x >= cut if up else x <= cut)}
        assert (report[s].n_records, report[s].k, report[s].cutoff) == (len(v), k, cut)
    assert set(report) == {"up", "down"} and not kept & {900, 901}


def test_keep_fraction_without_nan(spark):
    df = spark.createDataFrame([(i, "s", v) for i, v in enumerate([1.0, 2.0, 3.0, float("nan")])], "id int, src string, score double")
    for up in (True, False):
        report, kept = cutoff.keep_fraction(df, "src", "score", spark.createDataFrame([("s", 500, up)], "src string, keep_permille int, higher_is_better boolean"))
        assert sorted(r.score for r in kept.collect()) == ([2.0, 3.0] if up else [1.0, 2.0]) and report.first().n_records == 3


def test_current_scores(spark):
    rows = [
        (1, "M", 0.5, 1), (1, " m\t", 0.7, 2), (1, "m", 0.7, 2),  # the later run, repeated
        (2, "m", 0.5, 1), (2, "m", None, 2),  # a later failure counts
        (3, "m", float("nan"), 1), (4, "m", float("inf"), 1), (5, "m", 1.0, 1), (6, "m", 1.01, 1),
        (10, "m", 0.3, None), (11, "m", 0.3, None), (11, "m", None, 1),  # a run without a time is before all others
        (7, "other", 0.5, 1), (None, "m", 0.5, 1), (8, None, 0.5, 1), (9, "m", 0.2, 3), (9, "m", 0.4, 3),
    ]
    df = spark.createDataFrame(rows, "pair_id bigint, qe_model string, qe_score double, scored_at int")
    models = spark.createDataFrame([("m", True, 0.0, 1.0)], "qe_model string, higher_is_better boolean, min_score double, max_score double")
    assert sorted((r.pair_id, r.qe_score) for r in scores.current_scores(df, models).collect()) == [(1, 0.7), (5, 1.0), (9, 0.4), (10, 0.3)]
    assert scores.current_scores(df, models, "M ").count() == 4 and scores.current_scores(df.filter("false"), models).count() == 0


# --- caps -------------------------------------------------------------------------------------------------------------
def greedy(records, caps):
    room, kept = dict(caps), set()
    worst = float("-inf")
    for i, names, s in sorted(records, key=lambda r: (-(worst if r[2] is None or math.isnan(r[2]) else r[2]), r[2] is None or math.isnan(r[2]), r[0])):
        names = {n for n in names or [] if n is not None and n in room}
        if all(room[n] > 0 for n in names):
            kept.add(i)
            for n in names:
                room[n] -= 1
    return kept


@pytest.mark.parametrize("seed, tail", [(1, 0), (2, 0), (3, 0), (1, 60)])
def test_caps(spark, monkeypatch, seed, tail):
    monkeypatch.setattr(capping, "TAIL_EDGES", tail)  # 0: rounds to the end
    rnd = random.Random(seed)
    names = ["hot", "hot", "hot", "b", "c", "d", "e", None]
    records = [(i, None if i == 7 else rnd.choices(names, k=rnd.choice([0, 1, 1, 2, 3])), rnd.choice([None, float("nan"), float("inf"), float("-inf"), 0.1, 0.5, 0.5, round(rnd.random(), 2)])) for i in range(250)]
    caps = {"hot": 40, "b": 12, "c": 0, "d": 3}
    df = spark.createDataFrame(records, "pair_id bigint, who array<string>, quality double").withColumn("kept", F.lit("clash"))
    limits = spark.createDataFrame([*caps.items(), ("e", None)], "contributor string, cap int")
    got = {r.pair_id: r.kept for r in capping.cap_contributors(df, limits, "pair_id", "who", "quality").collect()}
    assert {i for i, k in got.items() if k} == greedy(records, caps) and len(got) == 250


def test_chain(spark):
    """Each record waits for the next better one, so rounds alone would settle one link each."""
    records = [(i, [f"c{i}", f"c{i + 1}"], float(i)) for i in range(400)]
    caps = {f"c{i}": 1 for i in range(401)}
    df = spark.createDataFrame(records, "id bigint, who array<string>, q double")
    limits = spark.createDataFrame(list(caps.items()), "contributor string, cap int")
    got = {r.id for r in capping.cap_contributors(df, limits, "id", "who", "q").filter("kept").collect()}
    assert got == greedy(records, caps) and len(got) == 200


def test_caps_edges(spark):
    df = spark.createDataFrame([(i, ["a"], None) for i in range(10)], "id bigint, who array<string>, q double")
    cap = lambda n: spark.createDataFrame([("a", n)], "contributor string, cap int")
    kept = lambda n: {r.id for r in capping.cap_contributors(df, cap(n), "id", "who", "q").filter("kept").collect()}
    assert kept(4) == {0, 1, 2, 3} and kept(0) == set() and kept(10) == kept(99) == set(range(10))
    assert capping.cap_contributors(df.filter("false"), cap(1), "id", "who", "q").count() == 0
    assert capping.cap_contributors(df, cap(1).filter("false"), "id", "who", "q").filter("kept").count() == 10


# --- ranking ----------------------------------------------------------------------------------------------------------
def brute_ranking(data, ways, weights=None):
    values = {}
    for i, m, s in data:
        if s is not None and not math.isnan(s) and m in ways:
            values.setdefault(m, {})[i] = s * ways[m]
    logs = {}
    for m, by in values.items():
        v = sorted(by.values())
        mid = v[(len(v) + 1) // 2 - 1]
        away = sorted(abs(x - mid) for x in v)
        spread = away[(len(v) + 1) // 2 - 1] * 1.4826 or np.mean(away) * 1.2533
        for i, x in by.items():
            z = (x - mid) / spread if spread else 0.0
            logs.setdefault(i, []).append((-math.log1p(math.exp(-max(-30, min(30, z)))), (weights or {}).get(m, 1.0)))
    return {i: round(math.exp(sum(p * w for p, w in ps) / sum(w for _, w in ps)), 9) for i, ps in logs.items()}


def test_ranking(spark):
    rnd = random.Random(4)
    ways = {"unit": 1, "big": -1, "flat": 1, "mostly": 1}
    draw = {"unit": lambda: rnd.random(), "big": lambda: rnd.gauss(1e6, 1e5), "flat": lambda: 3.0, "mostly": lambda: rnd.choice([1.0, 1.0, 1.0, 9.0])}
    data = [(i, m, rnd.choice([None, float("nan")]) if rnd.random() < 0.1 else draw[m]()) for i in range(300) for m in ways if rnd.random() < 0.8]
    df = spark.createDataFrame([(i, m, s, ways[m] > 0) for i, m, s in data], "id bigint, model string, score double, higher_is_better boolean").withColumn("rank", F.lit("clash"))
    for weights in (None, {"unit": 3.0}):
        got = {r.id: r for r in ranking.combined_ranking(df, "id", "model", "score", weights).collect()}
        want = brute_ranking(data, ways, weights)
        assert set(got) == set(want)
        for i, w in want.items():
            assert got[i].combined == pytest.approx(w, abs=2e-9)
        order = [r.combined for r in got.values()]
        assert all(r["rank"] == 1 + sum(x > r.combined for x in order) for r in got.values())
    assert ranking.combined_ranking(df.filter("false"), "id", "model", "score").count() == 0


def test_scale_does_not_matter(spark):
    rnd = random.Random(5)
    rows = [(i, m, rnd.gauss(0, 1)) for i in range(120) for m in ("a", "b")]
    def rank(stretch):
        df = spark.createDataFrame([(i, m, s * (stretch if m == "b" else 1), True) for i, m, s in rows], "id bigint, model string, score double, higher_is_better boolean")
        return {r.id: r["rank"] for r in ranking.combined_ranking(df, "id", "model", "score").collect()}
    assert rank(1.0) == rank(4096.0)


def test_rank_ties(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0.5] * 50 + [0.9, 0.1, 1.0, 0.0])], "id int, s double")
    got = {r.id: r["rank"] for r in ranking.with_rank(df, "s").collect()}
    assert got[52] == 1 and got[50] == 2 and got[0] == got[49] == 3 and got[51] == 53 and got[53] == 54


# --- mixing -----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("rate, cap", [(0.5, 1), (4.5, 5), (900.0, 1000), (999.0, 1000), (3.0, 5000), (4900.0, 5000)])
def test_large_caps(spark, rate, cap):
    below = mixing.truncated_cdf(rate, cap)
    assert len(below) == cap and cap - sum(below) == pytest.approx(rate, rel=1e-9)
    plan = spark.createDataFrame([("D", "t", "x", rate, cap)], "dataset string, target_pair string, source_pair string, rate double, max_repeat int")
    records = spark.range(20_000).select(F.lit("x").alias("source_pair"), F.col("id").alias("record_id"), F.lit(1).alias("size"))
    drawn = mixing.replicate(records, plan).agg(F.avg("copies").alias("m"), F.max("copies").alias("most")).first()
    assert drawn.m == pytest.approx(rate, rel=0.01) or rate < 5 and drawn.m == pytest.approx(rate, rel=0.03)
    assert drawn.most <= cap


@pytest.mark.parametrize("rate, cap", [(0.0, 3), (0.2, 1), (0.7, 3), (2.9, 3), (2.9999, 3), (3.0, 3), (5.0, 3), (0.001, 5), (40.0, 50), (0.5, 0)])
def test_truncated_poisson(rate, cap):
    below = mixing.truncated_cdf(rate, cap)
    assert len(below) == cap and all(0 <= a <= b <= 1 for a, b in zip(below, below[1:]))
    assert cap - sum(below) == pytest.approx(min(rate, cap), abs=1e-6)


def plans(spark):
    at = "2025-01-0{} 00:00:00".format
    source = [
        ("D", "t", "big", 100_000, 40_000, at(1)), ("D", "t", "small", 1_000, 10_000, at(2)), ("D", "t", "small", 9_999_999, 1, at(1)), ("D", "t", "small", 1_000, 10_000, at(2)),
        ("D", "t", "none", None, 500, at(1)), ("D", "t", "bad", -5, -7, at(1)), ("D", "t", "zero", 50, 0, at(1)), ("D", "edge", "x", 100, 300, at(1)), ("D", "lost", "x", 1, 9, at(1)),
    ]
    s = spark.createDataFrame(source, "dataset string, target_pair string, source_pair string, total_tokens bigint, alloc_tokens bigint, t string").withColumn("planned_at", F.col("t").cast("timestamp"))
    p = spark.createDataFrame([("D", "t", 30_000, 3), ("D", "t", 30_000, 3), ("D", "edge", None, 3), ("D", "unused", 5, 5)], "dataset string, target_pair string, quota bigint, max_repeat int")
    return s, p


def test_mixing_plan(spark):
    got = {(r.target_pair, r.source_pair): r for r in mixing.mixing_plan(*plans(spark)).collect()}
    assert {k for k, r in got.items() if r.falls_short} == {("t", "small"), ("t", "none")}
    assert set(got) == {("t", x) for x in ("big", "small", "none", "bad", "zero")} | {("edge", "x")}
    big = got[("t", "big")]
    assert big.planned_share == pytest.approx(40_000 / 50_500) and big.planned_tokens == pytest.approx(30_000 * 40_000 / 50_500)
    assert got[("t", "small")].rate == 3.0 and got[("t", "none")].rate == 0.0 and got[("edge", "x")].rate == 0.0


def test_mixture(spark):
    s, p = plans(spark)
    records = spark.range(4000).select(F.when(F.col("id") % 4 > 0, "big").otherwise("small").alias("source_pair"), F.col("id").alias("record_id"), F.when(F.col("id") != 5, 10).alias("size"), F.lit(1).alias("copies"))
    records = records.unionByName(spark.createDataFrame([(None, 9001, 5, 1), ("unknown", 9002, 5, 1)], "source_pair string, record_id bigint, size int, copies int")).withColumn("dataset", F.lit("clash")).withColumn("cdf", F.lit(1))
    plan = mixing.mixing_plan(s, p)
    report = {r.source_pair: r for r in mixing.mixing_report(records, plan).filter("target_pair = 't'").collect()}
    assert report["small"].actual_records == 3000 and report["small"].actual_tokens == 30_000  # at its cap: each record three times
    rate = report["big"].rate
    assert abs(report["big"].actual_records - 3000 * rate) < 5 * math.sqrt(3000 * rate)
    assert report["zero"].actual_tokens == 0 and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    mixed = mixing.mixture(records, plan).cache()
    assert mixed.count() == sum(r.actual_records for r in report.values())
    assert mixed.groupBy("record_id").agg(F.max("copy_no").alias("m")).agg(F.max("m")).first()[0] <= 3
    again = mixing.mixture(records.repartition(7), plan)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    small = [r.source_pair == "small" for r in mixed.collect()]
    half = len(small) // 2
    assert abs(np.mean(small[:half]) - np.mean(small[half:])) < 0.05  # shuffled
    assert mixing.mixture(records.filter("false"), plan).count() == 0
    assert mixing.mixing_report(records.filter("false"), plan).filter("actual_share is not null").count() == 0
    assert mixing.mixing_plan(s.filter("false"), p).count() == 0
