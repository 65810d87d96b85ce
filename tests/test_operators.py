"""Core operators on small fixtures: hand-computed cases, brute force, nulls, ties and empty tables."""

import bisect
import json
import os
import random
import uuid
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import budget, dedup, joint, lid, outlier, prefix, retrieval, sampling, scoring, stats, tracking
from corpusloom.operators import thresholds as th
from corpusloom.sources import readers, writers
from corpusloom.streaming import ingest


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- running sums and quantiles ---------------------------------------------------------------------------------------
def test_running_sum(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", None, "b"]), rnd.random(), rnd.choice([None, 1, 2, 3]), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, o double, w int, i int")
    got = {r.i: r.s for r in prefix.running_sum(df, ["g"], [F.col("o")], F.col("w"), "s").collect()}
    for g, o, _, i in data:
        assert got[i] == sum(w or 0 for h, p, w, _ in data if h == g and p <= o)


def test_exact_quantiles(spark):
    rnd = random.Random(2)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, float("nan"), 1.0, 2.0, rnd.random()])) for _ in range(400)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.93, "qq": 1.0}
    got = {r.g: r for r in prefix.exact_quantiles(df, ["g"], "v", probs).collect()}
    assert "none" not in got
    for g in ("a", "b", None, "one"):
        v = [x for h, x in data if h == g and x is not None and x == x]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(v, p))
    few = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 4.0)], "g string, v double")
    assert prefix.exact_quantiles(few, ["g"], "v", {"q": 0.1}).first().q == pytest.approx(1.2)
    assert prefix.exact_quantiles(df.filter("false"), ["g"], "v", probs).count() == 0


def test_hot_group_is_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    got = prefix.row_numbers(df, ["g"], [F.col("o")])
    assert got.filter("row_no != o + 1").count() == 0 and got.count() == 20_000


# --- copies -----------------------------------------------------------------------------------------------------------
def test_dedup(spark):
    data = [(1, "a", "b", 5), (2, "a", "b", 3), (3, None, "b", 1), (4, "a", None, 1), (5, "", "", 2), (6, "", "", 2)]
    df = spark.createDataFrame(data, "id int, s string, t string, at int")
    assert rows_of(dedup.exact_dedup(df, "s", "t", ["at", "id"]).select("id")) == [(2,), (5,)]
    counts = dedup.dedup_counts(df.withColumn("g", F.lit(1)), ["g"], "s", "t").first()
    assert (counts.input_rows, counts.null_rows, counts.kept_rows, counts.removed_rows) == (6, 2, 2, 4)
    empty = dedup.duplicate_stats(df.filter("false"), ["s"]).first()
    assert (empty.n_rows, empty.n_unique, empty.max_copies) == (0, 0, 0)


def test_blocks(spark):
    data = [("f", i, k) for i, k in enumerate("AABAA")]
    df = spark.createDataFrame(data, "f string, i int, k string")
    assert rows_of(dedup.first_blocks(df, ["f"], ["i"], "k").select("i")) == [(0,), (1,), (2,)]


def test_unions(spark):
    a = spark.createDataFrame([("x", "y", "en", "de"), ("u", "v", "de", "en")], "s string, t string, a string, b string")
    both = dedup.both_directions(a, "a", "b", {"s": "t"}, ("en", "de"))
    assert rows_of(both) == [("v", "u", "en", "de"), ("x", "y", "en", "de")]
    with pytest.raises(ValueError):
        dedup.union_corpora(a, a, rename={"s": "t"})
    rows = spark.createDataFrame([("x", "y"), ("y", "x"), ("x", None), ("q", "r")], "s string, t string")
    final = spark.createDataFrame([("x", "y"), (None, "x")], "s string, t string")
    assert rows_of(dedup.not_in_final(rows, final, "s", "t")) == [("q", "r")]


# --- statistics and thresholds ----------------------------------------------------------------------------------------
def summary(spark, **values):
    base = {"min": 0.0, "max": 1.0, **dict.fromkeys(stats.SCORE_QUANTILES, 0.5)} | values
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in base.values())], ", ".join(f"{k} double" for k in base))


def test_gold_threshold(spark):
    known = dict(p01=0.2, p10=0.5, p50=0.8, gold_p01=0.6, gold_p25=0.75, gold_mean=0.8, gold_std=0.05)
    assert th.gold_threshold(summary(spark, **known, mrr=0.97)).first().threshold == pytest.approx(0.7)
    low = th.gold_threshold(summary(spark, **known, mrr=0.5)).first()
    assert (low.confidence, low.threshold) == ("low", pytest.approx(0.3))
    unknown = th.gold_threshold(summary(spark, **known, mrr=None)).first()
    assert unknown.confidence == "no_benchmark"


def test_data_threshold(spark):
    assert th.data_threshold(summary(spark, p10=0.0, p50=0.0)).first().threshold == pytest.approx(0.3)


def test_kept_fraction_inverts(spark):
    knots = dict(zip(stats.SCORE_QUANTILES, np.linspace(0.1, 0.9, 9)))
    df = summary(spark, **knots)
    for keep in (0.95, 0.85, 0.5, 0.07):
        t = df.select(th.threshold_keeping(keep).alias("t")).first().t
        assert df.select(th.kept_fraction(F.lit(t)).alias("k")).first().k == pytest.approx(keep)
    assert df.select(th.kept_fraction(F.lit(-1.0)).alias("k")).first().k == 1.0
    assert df.select(th.kept_fraction(F.lit(2.0)).alias("k")).first().k == 0.0
    assert df.select(th.threshold_keeping(0).alias("t")).first().t == float("inf")


def test_null_policies(spark):
    rows = spark.createDataFrame([(1, None), (1, 5.0), (1, 50.0), (2, 5.0)], "g int, f double")
    bounds = spark.createDataFrame([(1, "f", None, 10.0)], "g int, feature string, lower double, upper double")
    assert rows_of(th.within_bounds(rows, bounds, ["g"], ["f"]).select("f")) == [(5.0,), (None,)]
    t = spark.createDataFrame([(1, 5.0)], "g int, threshold double")
    nan = rows.union(spark.createDataFrame([(1, float("nan"))], "g int, f double"))
    assert rows_of(th.above_threshold(nan, t, ["g"], "f").select("f")) == [(5.0,), (50.0,)]


def test_lid(spark):
    preds = spark.createDataFrame([("m", "a", x) for x in (0.94, 0.95, 0.96)] + [("m", "b", x) for x in (0.1, 0.4, 0.9)], "model string, lang string, c double")
    got = {r.lang: r.threshold for r in lid.confidence_thresholds(preds, ["model", "lang"], "c").collect()}
    assert got["a"] == pytest.approx(0.9) and got["b"] == pytest.approx(0.3)
    t = spark.createDataFrame([("g", "a", 0.5), ("c", "a", 0.5)], "model string, lang string, threshold double")
    rows = spark.createDataFrame([(1, "o", "a", 0.5, "a", 0.9), (2, "o", "a", 0.6, "a", 0.9), (3, "o", "z", 0.9, "z", 0.9), (4, "o", None, None, "a", 0.9)], "i int, orig string, g string, gc double, c string, cc double")
    out = lid.agreed_language(rows, t, "orig", {"g": ("g", "gc"), "c": ("c", "cc")}, "final")
    assert rows_of(out.select("i", "final")) == [(1, "o"), (2, "a"), (3, "o"), (4, "o")]


def test_spearman_ties(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 2.0), (1, 2.0, 5.0), (1, 3.0, 3.0)], "g int, a double, b double")
    got = {(r.feature_a, r.feature_b): r.correlation for r in stats.spearman(df, ["g"], ["a", "b"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1.5, 1.5, 3, 4], [1.5, 1.5, 4, 3])[0, 1])


# --- joint score and budgets ------------------------------------------------------------------------------------------
def test_boundary(spark):
    hist = spark.createDataFrame([("x", b, 1, t) for b, t in enumerate((5, 5, 10))], "k string, bin int, rows int, tokens int")
    def at(budget_):
        r = joint.budget_boundary(hist, spark.createDataFrame([("x", float(budget_))], "k string, budget double"), ["k"], "tokens", 3).first()
        return r.boundary_bin, r.boundary_fraction
    assert at(12) == (1, pytest.approx(0.4))
    assert at(0) == (3, 0.0) and at(20) == (-1, 1.0) and at(10) == (2, 1.0)


def test_allocation(spark):
    rnd = random.Random(5)
    data = [(str(i), o := rnd.uniform(1e7, 5e10), o * rnd.random()) for i in range(40)]
    df = spark.createDataFrame(data, "k string, original double, eligible double")
    total = sum(e for _, _, e in data)
    for share in (0.1, 0.5, 0.9, 1.0, 2.0):
        got = {r.k: r.budget for r in joint.allocate_budget(df, "k", "original", "eligible", share * total).collect()}
        assert sum(got.values()) == pytest.approx(min(share, 1) * total)
        assert all(got[k] <= e * (1 + 1e-9) for k, _, e in data)
    assert joint.allocate_budget(df, "k", "original", "eligible", 0.0).agg(F.sum("budget")).first()[0] == 0


def knots_of(values, knots=257):
    """Distinct quantiles of the finite values, and at each the mean of the shares below and up to it."""
    v = values[np.isfinite(values)]
    x = np.unique(np.quantile(v, np.linspace(0, 1, knots))) if len(v) else v
    return x.tolist(), [float(((v < k).sum() + (v <= k).sum()) / (2 * len(v))) for k in x]


def test_cdf(spark):
    x, p = knots_of(np.array([1.0, 2.0, 2.0, 3.0, np.nan]))
    df = spark.createDataFrame([(v, x, p) for v in (0.5, 1.0, 1.5, 2.0, 3.0, 9.0, None)], "v double, x array<double>, p array<double>")
    got = [r.c for r in df.select(joint.cdf_at(F.col("v"), F.col("x"), F.col("p")).alias("c")).collect()]
    assert got == pytest.approx([0.0, *np.interp([1.0, 1.5, 2.0, 3.0], x, p), 1.0, 0.5])
    rows = spark.createDataFrame([(i, "a", v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0, None])], "i int, g string, v double")
    ranks = {r.i: r.r for r in joint.mid_ranks(rows, ["g"], "v", "r").collect()}
    assert ranks == {0: 0.125, 1: 0.5, 2: 0.5, 3: 0.875, 4: None}


def test_rejections(spark):
    rows = [("", "x", 0.5, 0.5), ("a", "b", None, None), ("a", "b", 0.5, None), ("the same text in latin letters", "the same text in latin letters", 0.5, 0.5)]
    df = spark.createDataFrame([(i, *r, "eng_Latn", "rus_Cyrl", r[0] == r[1]) for i, r in enumerate(rows)], "i int, s string, t string, sim double, qe double, a string, b string, same boolean")
    reasons = joint.rejection_reasons(*[F.col(c) for c in ("s", "t", "a", "b", "same", "sim", "qe")])
    assert [r.x for r in df.orderBy("i").select(reasons.alias("x")).collect()] == [1, 8, 0, 2]


def test_plans():
    assert budget.water_fill(10, [2, 10, 10]) == [2, 4, 4]
    assert budget.allocate(30, [5, 10]) == [10, 20]
    assert budget.allocate(0, []) == []
    assert budget.largest_remainder(10, [1, 1, 1]) == [4, 3, 3]
    assert budget.pack_bins({"a": 5, "b": 4, "c": 3, "d": 2}, 2) == [["a", "d"], ["b", "c"]]
    assert budget.assign_shards([("d", i) for i in range(5)], 2, 3) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    assert budget.english_side("eng_Latn-deu_Latn") is True and budget.english_side("deu_Latn-fra_Latn") is None
    assert budget.quota_shards(1000, 3600) == 3 and budget.estimated_hours(10, None) is None


# --- samples ----------------------------------------------------------------------------------------------------------
def test_samples(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("string").alias("g"))
    a = sampling.sample_k(df, ["g"], 100, 1, "id")
    assert a.groupBy("g").count().filter("count = 100").count() == 2
    assert rows_of(a) == rows_of(sampling.sample_k(df.repartition(13), ["g"], 100, 1, "id"))
    assert sampling.sample_k(df.limit(5), ["g"], 100, 1, "id").count() == 5
    assert abs(sampling.fraction_sample(df, 0.2, 1, "id").count() - 1000) < 120
    rep = sampling.repeat_to(df, ["g"], spark.createDataFrame([("true", 4000), ("false", 1000)], "g string, target int"), 1, "id")
    n = {r.g: r["count"] for r in rep.groupBy("g").count().collect()}
    assert abs(n["true"] - 4000) < 150 and abs(n["false"] - 1000) < 120


def test_large_samples(spark, monkeypatch):
    df = spark.range(9000).select("id", F.when(F.col("id") < 6000, "hot").when(F.col("id") < 8990, "b").alias("g"))
    want = rows_of(sampling.sample_k(df, ["g"], 900, 1, "id"))
    monkeypatch.setattr(sampling, "WINDOW_ROWS", 0)
    assert rows_of(sampling.sample_k(df, ["g"], 900, 1, "id")) == want
    assert sampling.sample_k(df, ["g"], 5000, 1, "id").groupBy("g").count().orderBy("count").collect() == [(None, 10), ("b", 2990), ("hot", 5000)]
    # All of a group above the bound: it keeps its rows.
    sizes = df.groupBy("g").agg(F.count("*").alias("_n"), F.lit(3).alias("_take"))
    assert sampling._lowest(df, ["g"], sizes, F.lit(0.999) + F.col("id") * 0, ["id"]).groupBy("g").count().filter("count = 3").count() == 3


def test_value_ranks(spark):
    # One value holds 60 % of a group and lies in many slices; null, NaN and clashing columns are there.
    rnd = random.Random(5)
    data = [(i, rnd.choice(["a", None]), rnd.choice([0.0] * 6 + [None, float("nan"), rnd.random(), -rnd.random()])) for i in range(3000)]
    df = spark.createDataFrame(data, "i int, g string, v double").withColumn("_n", F.lit(1)).repartition(5)
    key = lambda v: (0, 0) if v is None else (2, 0) if v != v else (1, v)
    for nulls in (False, True):
        got = {r.i: (r._less, r._equal, r._all) for r in prefix.value_ranks(df, ["g"], "v", nulls=nulls).collect()}
        some = [r for r in data if nulls or r[2] is not None]
        by = {g: sorted(key(v) for _, h, v in some if h == g) for g in ("a", None)}
        assert got == {i: (bisect.bisect_left(by[g], key(v)), by[g].count(key(v)), len(by[g])) for i, g, v in some}
    assert prefix.value_ranks(df.filter("false"), ["g"], "v").count() == 0
    local = prefix.value_ranks(df.repartition(1), [], "v")
    assert local.count() == sum(v is not None for _, _, v in data)


def test_join_table(spark):
    from corpusloom.operators.keys import join_table

    rows = spark.createDataFrame([(i, "a" if i % 3 else None) for i in range(300)] + [(900, "z")], "i int, g string")
    table = spark.createDataFrame([("a", 1), (None, 2), ("q", 3)], "g string, x int")
    for most in (0, 10):
        assert rows_of(join_table(rows, table, ["g"], most=most).groupBy("g", "x").count()) == [("a", 1, 200), (None, 2, 100)]
        assert join_table(rows, table, ["g"], "left", most=most).filter("x is null").count() == 1


def test_inclusion_scale():
    w, n = np.array([1.0, 2.0, 50.0]), np.array([10, 5, 2])
    for target in (1, 3, 8, 16):
        s = sampling.inclusion_scale(w, n, target)
        assert (np.minimum(1, s * w) * n).sum() == pytest.approx(target)
    assert sampling.inclusion_scale(w, n, 17) == float("inf")


def test_systematic(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("g"), F.lit(0.1).alias("p"))
    got = [r.id for r in sampling.systematic_sample(df, ["g"], [F.col("id")], "p").orderBy("id").collect()]
    assert len(got) == 100 and set(np.diff(got)) == {10}


# --- models -----------------------------------------------------------------------------------------------------------
def test_isolation_forest(spark):
    rng = np.random.default_rng(0)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(2000, 2)))] + [(9000 + i, 9.0 + i, -9.0) for i in range(5)] + [(9999, None, 0.0)]
    df = spark.createDataFrame(data, "id int, a double, b double")
    forest = outlier.fit(df, ["a", "b"], ["id"], contamination=0.01)
    scored = outlier.score_rows(df, ["a", "b"], forest)
    top = {r.id for r in scored.orderBy(F.desc("anomaly")).limit(10).collect()}
    assert {9000 + i for i in range(5)} <= top
    assert scored.filter("is_outlier").count() <= 0.011 * len(data) + 1
    with pytest.raises(ValueError):
        outlier.fit(df.filter("false"), ["a"], ["id"])


def test_scorer_contract(spark):
    def make():
        def scorer(s, t):
            if "bad" in s:
                raise RuntimeError("refused")
            return [float(len(a) - len(b)) for a, b in zip(s, t)]

        return scorer

    df = spark.createDataFrame([(1, "abc", "a"), (2, "bad", "x"), (3, None, "x"), (4, "", "")], "i int, s string, t string")
    got = {r.i: r.y for r in scoring.score_pairs(df, "s", "t", make, "y").collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: 0.0}


def test_retrieval(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(60, 8)), rng.normal(size=(60, 8))
    b[:30] = a[:30] + 0.3 * b[:30]
    df = spark.createDataFrame([(i, i % 2, a[i].tolist(), b[i].tolist()) for i in range(60)], "id int, g int, va array<double>, vb array<double>")
    got = {r.id: r["rank"] for r in retrieval.diagonal_ranks(df, ["g"], "id", "va", "vb", block=7).collect()}
    x, y = retrieval.unit_rows(a), retrieval.unit_rows(b)
    for i in range(60):
        same = [j for j in range(60) if j % 2 == i % 2 and j != i]
        assert got[i] == 1 + sum(x[i] @ y[j] > x[i] @ y[i] + 1e-12 for j in same)
    u, v = retrieval.cca(a, a @ rng.normal(size=(8, 8)))
    assert np.allclose(np.abs((u * v).sum(axis=0)), 1, atol=1e-6)


# --- progress ---------------------------------------------------------------------------------------------------------
def test_winners(spark):
    events = spark.createDataFrame([("d", 0, "claim", "A", 1), ("d", 0, "failed", "A", 2), ("d", 0, "done", "B", 3), ("d", 1, "claim", "A", 4)], "direction_key string, shard_id int, event string, worker string, at int")
    won = tracking.winners(events, ["direction_key", "shard_id"], ["at"])
    assert rows_of(won.select("shard_id", "worker")) == [(0, "B")]
    parts = spark.createDataFrame([("src-0", 0, "B"), ("orphan", 0, "A"), ("src-1", 1, "A")], "row string, shard_id int, worker string")
    assert rows_of(tracking.winning_rows(parts, won, ["shard_id"], "worker").select("row")) == [("src-0",)]
    full = tracking.complete_groups(events, events.filter("event = 'done'"), ["direction_key"], ["shard_id"]).first()
    assert (full.n_assigned, full.n_done, full.complete) == (2, 1, False)


# --- sources, sinks, streams ------------------------------------------------------------------------------------------
def test_zip_reader(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("c.en", "Hello \nWorld\nextra\n")
        z.writestr("c.de", "Hallo\n Welt\n")
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    got = readers.read_zip_bitext(spark, str(tmp_path / "*.zip"), "en", "de")
    assert rows_of(got.select("line_no", "source_text", "target_text")) == [(0, "Hello", "Hallo"), (1, "World", "Welt")]


def test_jsonl_and_stats(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\nbroken\n{"x": 2}\n')
    path = str(tmp_path / "a.jsonl")
    assert readers.read_jsonl(spark, path, "x int").cache().filter("_corrupt_record is not null").count() == 1
    assert readers.read_jsonl(spark, path, "x int", "skip").count() == 2
    with pytest.raises(Exception):
        readers.read_jsonl(spark, path, "x int", "fail").collect()
    (tmp_path / "s.chunk0.csv").write_text("k,v\na,1\nb,2\n")
    (tmp_path / "s.chunk1.csv").write_text("k,v\na,3\n")
    assert rows_of(readers.read_stats(spark, str(tmp_path / "s.*.csv"), ["k"])) == [("a", 3), ("b", 2)]
    with pytest.raises(ValueError):
        readers.require_columns(spark.range(1), "nope")


def test_codes(spark):
    m = spark.createDataFrame([("en", "eng_Latn_US", "eng"), ("xx", None, "xxx")], "code string, three_part string, iso3 string")
    df = spark.createDataFrame([("en", "xx"), ("??", None)], "a string, b string")
    assert rows_of(readers.map_languages(df, m, ["a", "b"]).select("conv_a", "conv_b")) == [("??", None), ("eng_Latn", "xxx")]
    t = spark.createDataFrame([("p", "где x", 1), ("q", "12", 1), ("q", None, 2)], "k string, t string, o int")
    assert rows_of(readers.majority_script(t, ["k"], "t", ["o"]).select("k", "script")) == [("p", "Cyrl"), ("q", "Zyyy")]


def test_shards_and_publishing(spark, tmp_path):
    df = spark.range(1050)
    writers.write_shards(df.coalesce(1), str(tmp_path / "s"), 100)
    sizes = [spark.read.parquet(str(tmp_path / "s" / f)).count() for f in os.listdir(tmp_path / "s") if f.endswith(".parquet")]
    assert max(sizes) == 100 and sum(sizes) == 1050
    numbered = writers.shard_numbers(df, [], [F.col("id")], 500)
    assert rows_of(numbered.groupBy("shard_id").count()) == [(0, 500), (1, 500), (2, 50)]
    target = str(tmp_path / "out")
    manifest = writers.publish(df, target, expected=1050, seed=1)
    assert spark.read.parquet(target).count() == 1050 and json.load(open(f"{target}/_MANIFEST.json")) == manifest
    with pytest.raises(ValueError):
        writers.publish(df, target, expected=1)
    assert spark.read.parquet(target).count() == 1050
    writers.same_run(manifest, manifest)
    with pytest.raises(ValueError):
        writers.same_run(manifest, manifest | {"digest": "other"})
    with pytest.raises(ValueError):
        writers.check_conserved(3, 1, 1, 1, 1)


def test_scorer_files(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", None), ("c\nd", "e")], "s string, t string")
    writers.write_scorer_tsv(df.coalesce(1), str(tmp_path / "in"), ["s", "t"])
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "in")).collect())
    assert lines == ["a b\t", "c d\te"]
    (tmp_path / "scores").write_text("x\t0.5\ny\tbad\n")
    assert rows_of(writers.read_scores(spark, str(tmp_path / "scores"))) == [(0.5,), (None,)]


def test_streams(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(source)
    schema = spark.range(1).schema
    name = uuid.uuid4().hex
    for expected in (10, 10, 15):
        if expected == 15:
            spark.range(5).write.mode("append").parquet(source)
        ingest.process_new_files(spark, source, target, name, lambda df: df.withColumn("y", F.col("id") + 1), schema).awaitTermination()
        assert spark.read.parquet(target).count() == expected
    events, state = str(tmp_path / "events"), str(tmp_path / "state")
    kinds = "direction_key string, shard_id int, event string, worker string, at timestamp"
    day = "2024-01-01 00:0{}:00"
    def add(*rows):
        spark.createDataFrame([(*r[:4], r[4]) for r in rows], "direction_key string, shard_id int, event string, worker string, t string").withColumn("at", F.col("t").cast("timestamp")).drop("t").coalesce(1).write.mode("append").parquet(events)
    add(("d", 0, "done", "A", day.format(1)), ("d", 1, "claim", "A", day.format(1)))
    stream = lambda: spark.readStream.schema(kinds).parquet(events)
    ingest.merge_completions(spark, stream(), state, ["direction_key", "shard_id"], ["at"], name + "-m").awaitTermination()
    add(("d", 0, "done", "B", day.format(2)), ("d", 1, "done", "C", day.format(2)))
    ingest.merge_completions(spark, stream(), state, ["direction_key", "shard_id"], ["at"], name + "-m").awaitTermination()
    assert rows_of(ingest.current_completions(spark, state).select("shard_id", "worker")) == [(0, "B"), (1, "C")]
    q = ingest.first_completions(stream(), ["direction_key", "shard_id"], "at").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == 2
    w = ingest.completions_per_window(spark.read.parquet(events), ["direction_key"], "at").first()
    assert w.n == 3


# --- later additions --------------------------------------------------------------------------------------------------
def test_corpus_metrics(spark):
    from corpusloom.operators import metrics

    df = spark.createDataFrame([("same", "the cat sat on the mat", "the cat sat on the mat"), ("none", "x", "y z"), ("null", None, "a"), ("null", "a", None)], "g string, h string, r string")
    got = {r.g: r for r in metrics.corpus_metrics(df, ["g"], "h", "r").collect()}
    assert got["same"].bleu == pytest.approx(100) and got["same"].chrf == pytest.approx(100)
    assert got["none"].bleu == 0 and got["none"].chrf == 0 and got["null"].n == 2
    # 3 of 4 words, 1 of 3 pairs: no triples match.
    c = metrics.match_counts("a b c d", "a b x d")
    assert c[:8] == [4, 4, 3, 4, 4, 1, 3, 3]
    assert metrics.corpus_metrics(df.filter("false"), ["g"], "h", "r").count() == 0


def test_blocks_with_nulls_and_long_sequences(spark):
    rnd = random.Random(9)
    data = [(s, i, k) for s in ("a", None) for i, k in enumerate(rnd.choices(["x", "y", None], k=300))]
    df = spark.createDataFrame(data, "s string, i int, k string").withColumn("block", F.lit("clash"))
    got = {(r.s, r.i): r.block_no for r in dedup.first_blocks(df, ["s"], ["i"], "k").collect()}
    want = {}
    for s in ("a", None):
        first, number, last = {}, 0, object()
        for _, i, k in (r for r in data if r[0] == s):
            if k != last:
                number, last = number + 1, k
            first.setdefault(k, number)
            if first[k] == number:
                want[(s, i)] = number
    assert got == want


def test_query_subset_of_retrieval(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], [float(i), 1.0]) for i in range(5)] + [(9, None, [1.0, 1.0])], "id int, a array<double>, b array<double>").withColumn("g", F.lit(None).cast("string"))
    got = retrieval.diagonal_ranks(df, ["g"], "id", "a", "b", queries=F.col("id") == 3)
    assert rows_of(got.select("id", "rank")) == [(3, 1)]


def test_positional_join(spark):
    from corpusloom.operators.joins import positional_join

    a = spark.createDataFrame([(1, "u", 1), (2, None, 2), (3, "w", 3)], "i int, url string, x int")
    b = spark.createDataFrame([(1, "u", 7), (2, None, 8)], "i int, url string, y int")
    assert rows_of(positional_join(a, b, ["i"], ["url"])) == [(1, "u", 1, 7), (2, None, 2, 8)]
    with pytest.raises(Exception, match="url differs"):
        positional_join(a, b.withColumn("url", F.lit("z")), ["i"], ["url"]).collect()
    with pytest.raises(ValueError):
        positional_join(a, b.withColumn("x", F.lit(1)), ["i"], ["url"])


def test_code_forms(spark):
    df = spark.createDataFrame([("en", "Latn"), ("deu", "Latn"), ("fra_Latn", None), ("xyz", None), ("?", "Latn"), (None, "Latn")], "c string, s string")
    got = [r.n for r in df.select(readers.normalised_code(F.col("c"), F.col("s"), {"en": "eng_Latn"}).alias("n")).collect()]
    assert got == ["eng_Latn", "deu_Latn", "fra_Latn", "xyz_Zyyy", "und_Zyyy", "und_Zyyy"]


def test_mean_embedding(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 1.0])], "a array<double>, b array<double>")
    assert df.select(retrieval.mean_embedding(["a", "b"]).alias("m")).first().m == pytest.approx([0.3, 0.9])
