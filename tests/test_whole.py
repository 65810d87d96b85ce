"""Queries that do more than their SQL, or have none, against brute force."""

import unicodedata

import numpy as np
import pandas as pd
import regex
from test_operators import knots_of

from corpusloom.functions import text as T
from corpusloom.operators import budget, joint, outlier
from corpusloom.operators.thresholds import LOWER_ONLY, SAFEGUARDS, UPPER_ONLY
from corpusloom.plans import joint_plans, registry
from corpusloom.plans.views import FEATURES

QUERIES = registry.load()
LETTER = regex.compile(r"\p{L}")


def mid_rank(v):
    known = np.sort(v[np.isfinite(v)])
    place = (np.searchsorted(known, v, "left") + np.searchsorted(known, v, "right")) / (2 * max(len(known), 1))
    return np.where(np.isfinite(v), place, np.nan)


def risk(v):
    return np.nan_to_num(np.clip((mid_rank(v) - 0.8) / 0.2, 0, 1))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def form(rows):
    """H and the copy risk of one language pair's rows, as the reference computes them."""
    src, tgt = rows["lang_pair"].iloc[0].split("-")
    texts = [rows["source_text"].tolist(), rows["target_text"].tolist()]
    spaced = [x.rsplit("_", 1)[-1] not in joint.NO_WORD_SCRIPTS for x in (src, tgt)]
    count = [np.array([len(t.split()) for t in ts], float) for ts in texts]
    chars = [np.array([len(t) for t in ts], float) for ts in texts]
    away = lambda a, b: np.round(abs((r := np.log(np.maximum(a, 1) / np.maximum(b, 1))) - np.median(r)), 9)
    length = risk(away(*chars))
    if all(spaced):
        length = np.maximum(length, risk(away(*count)))
    structure = np.maximum(rows["html"].to_numpy(), risk(np.round(-rows["punct_score"].to_numpy() / np.log1p(np.maximum(np.minimum(*chars), 1)), 9)))
    for ts, n, on in zip(texts, count, spaced):
        if on:
            mean = np.array([sum(map(len, t.split())) for t in ts]) / np.maximum(n, 1)
            longest = np.array([max(map(len, regex.split(r"\s+", t))) for t in ts], float)
            structure = np.maximum(structure, np.maximum(risk(mean), risk(longest)))
    clean = lambda t: " ".join(unicodedata.normalize("NFC", t).split())
    copy, numbers, repeats = [], [], []
    for s, t in zip(*texts):
        overlap = 1.0 if clean(s) == clean(t) else max(T.lcs_length(s, t) / min(len(s), len(t)), 1 - levenshtein(s, t) / max(len(s), len(t)))
        enough = min(len(LETTER.findall(s)), len(LETTER.findall(t))) >= 12
        copy.append(min(max((overlap - 0.8) / 0.2, 0), 1) if enough else 0.0)
        numbers.append(1 - T.numeral_ratio(s, t) if regex.search(r"\p{Nd}", s + t) else 0.0)
        repeats.append(max(T.repetition(s), T.repetition(t)))
    groups = np.stack([length, np.array(copy), risk(np.array(repeats, float)), np.array(numbers), structure])
    return np.clip(1 - 0.7 * groups.max(axis=0) - 0.3 * groups.mean(axis=0), 0.05, 1), groups[1], groups


def test_whole_joint_scores(spark, sf):
    base = joint_plans._base(spark, sf).filter("reasons = 0").toPandas()
    texts = pd.read_parquet(f"{sf}/bitext.parquet").dropna(subset=["src_lang", "tgt_lang"]).sort_values(["pair_id", "ingested_at"]).drop_duplicates("pair_id")
    rows = base.merge(texts[["pair_id", "source_text", "target_text"]], on="pair_id")
    got = QUERIES["joint_scores"](spark, sf).toPandas().set_index("pair_id")["joint_score"]
    assert len(got) == len(rows) > 0
    used = np.zeros(5)
    for _, r in rows.groupby("lang_pair"):
        h, copy, groups = form(r)
        used += (groups > 0).sum(axis=1)
        lift = lambda v: 0.05 + 0.95 * np.nan_to_num(v)
        p, q, j = (mid_rank(r[c].to_numpy(float)) for c in ("sim", "qe", "j"))
        parts = np.stack([lift(p), lift(q), h, r["lang_score"].to_numpy()])
        weights = np.stack([0.35 * 0.75 * np.isfinite(p), 0.35 * r["reliability"] * np.isfinite(q), np.full(len(r), 0.2), np.full(len(r), 0.1)])
        logs = (weights * np.log(np.clip(parts, 0.05, 1))).sum(axis=0) / weights.sum(axis=0)
        logs = np.where(np.isfinite(j), 0.8 * logs + 0.2 * np.log(np.clip(lift(j), 0.05, 1)), logs)
        score = np.exp(logs) * np.where(((parts < 0.2) & (weights > 0)).sum(axis=0) >= 2, 0.5, 1) * np.where((copy >= 0.9) & (r["lang_score"] < 0.4), 0.25, 1)
        np.testing.assert_allclose(got[r["pair_id"]].to_numpy(), score, rtol=1e-7)
    assert (used[[0, 1, 3, 4]] > 0).all(), used


def test_text_signals(spark):
    long = "The committee has met again"
    rows = [(1, long, long), (2, "Paris 12", "Paris 12"), (3, "We paid 45 euros", "Wir zahlten 54 Mark und 7"), (4, "no no no no no no no no", "nein"), (5, long, long + "s")]
    df = spark.createDataFrame(rows, "id int, s string, t string")
    signals = joint.text_signals(*[c for c in (df.s, df.t)], *[joint.F.lit(x) for x in ("eng_Latn", "zho_Hans")], T.same_text("s", "t"))
    got = {r["id"]: r for r in df.select("id", *[c.alias(n) for n, c in signals.items()]).collect()}
    assert [round(got[i]["copy"], 9) for i in (1, 2, 5)] == [1.0, 0.0, 1.0] and got[3]["numbers"] > 0 and got[1]["numbers"] == 0
    assert got[4]["repeats"] > 0 and got[1]["repeats"] == 0
    assert got[1]["src_max_word"] == 9 and got[1]["tgt_max_word"] is None and got[1]["word_logratio"] is None


def test_whole_stage1(spark, sf):
    rows = QUERIES["pair_features"](spark, sf).toPandas()
    texts = pd.read_parquet(f"{sf}/bitext.parquet").dropna(subset=["source_text", "target_text", "src_lang", "tgt_lang"])
    texts["lang_pair"] = texts["src_lang"] + "-" + texts["tgt_lang"]
    rows["ingested_at"] = rows["ingested_at"].dt.tz_localize("UTC").astype(texts["ingested_at"].dtype)
    rows = rows.merge(texts[["pair_id", "ingested_at", "lang_pair", "source_text", "target_text"]], on=["pair_id", "ingested_at"])
    some = rows.iloc[:150]
    for r in some.itertuples():
        s, t = r.source_text, r.target_text
        longer = max(len(s), len(t))
        assert np.isclose(r.score_levenshtein, 1 - levenshtein(s, t) / longer if longer else 1.0)
        assert np.isclose(r.score_lcs_ratio, T.lcs_length(s, t) / min(len(s), len(t)) if s and t else 0.0)
        assert np.isclose(r.score_numerals, T.numeral_ratio(s, t)) and (r.score_repeat_src, r.score_repeat_trg) == (T.repetition(s), T.repetition(t))
    keep = ~rows["filter_html_src"] & ~rows["filter_html_trg"]
    for f in FEATURES:
        by = rows.groupby("lang_pair")[f]
        mean, std = by.transform("mean"), by.transform("std").fillna(0)
        low, high = SAFEGUARDS[f]
        if f not in UPPER_ONLY:
            keep &= rows[f] >= np.minimum(np.minimum(by.transform("quantile", 0.001), mean - 4 * std), low or 0.0) - 1e-9
        if f not in LOWER_ONLY and high is not None:
            keep &= rows[f] <= np.maximum(np.maximum(by.transform("quantile", 0.999), mean + 4 * std), high) + 1e-9
    got = QUERIES["stage1_filter"](spark, sf).select("pair_id", "ingested_at").toPandas()
    assert sorted(got["pair_id"]) == sorted(rows.loc[keep, "pair_id"])
    assert len(FEATURES) == len(SAFEGUARDS) == 16


def test_forest_by_group(spark, monkeypatch):
    monkeypatch.setattr(outlier, "PART_ROWS", 400)
    rng = np.random.default_rng(1)
    rows = [(g, i, float(c + rng.normal()), None if i % 50 == 1 else float(rng.normal())) for g, n, c in (("large", 2000, 0), ("small", 200, 500)) for i in range(n)]
    rows += [("small", 200, 0.0, 0.0)]  # usual in the large group, not in its own
    df = spark.createDataFrame(rows, "g string, id int, a double, b double")
    got = outlier.score_by_group(df, "g", ["a", "b"], ["id"], contamination=0.01).toPandas()
    assert len(got) == len(rows) and not got.duplicated(["g", "id"]).any()
    for g, part in got.groupby("g"):
        assert (part["is_outlier"] == (part["anomaly"] > np.quantile(part["anomaly"], 0.99))).all()
    assert got.loc[(got["g"] == "small") & (got["id"] == 200), "is_outlier"].item()
    again = outlier.score_by_group(df.repartition(5), "g", ["a", "b"], ["id"], contamination=0.01).toPandas()
    assert got.sort_values(["g", "id"])["anomaly"].tolist() == again.sort_values(["g", "id"])["anomaly"].tolist()


def test_fitted_cdfs_cover_all_rows(spark):
    # 60,000 rows, of which a sample of about 50,000 isn't enough.
    rng = np.random.default_rng(2)
    groups = {"wide": rng.normal(size=60_000), "ties": rng.integers(0, 9, 5000).astype(float), "few": np.array([1.0, 2.0, 2.0, 5.0]), "one": np.array([3.0]), "none": np.array([np.nan])}
    df = spark.createDataFrame(pd.DataFrame([(g, v) for g, values in groups.items() for v in values], columns=["g", "v"]))
    got = {r.g: r for r in joint.fit_cdfs(df, ["g"], "v").collect()}
    assert set(got) == set(groups) and got["wide"].n == 60_000 and got["none"].n == 0
    for g, values in groups.items():
        x, p = knots_of(values)
        np.testing.assert_allclose(got[g].x, x, rtol=1e-12)
        np.testing.assert_allclose(got[g].p, p, rtol=1e-12)


def test_script_of_all_texts(spark, tmp_path):
    # The first hundred texts of a label are in another script than the rest, or empty.
    rows = [(i, "abc", "\u0442\u0435\u043a\u0441\u0442" if i < 50 else None) for i in range(100)] + [(i, "abc", "a latin text") for i in range(100, 400)]
    spark.createDataFrame(rows, "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["script_detection"](spark, str(tmp_path)).collect()
    assert [(r.lang, r.script) for r in found] == [("abc", "Latn")] and np.isclose(found[0].share, 300 * 10 / (300 * 10 + 50 * 5))
    assert [tuple(r) for r in QUERIES["normalised_codes"](spark, str(tmp_path)).collect()] == [("abc", "abc_Latn")]


def test_plan_of_every_dataset(spark, sf):
    got = QUERIES["extraction_plan"](spark, sf).toPandas()
    keys = ["dataset", "target_pair"]
    quota = pd.read_parquet(f"{sf}/pair_plan.parquet").dropna(subset=keys).groupby(keys)["quota"].max().dropna()
    sources = pd.read_parquet(f"{sf}/source_plan.parquet").dropna(subset=[*keys, "source_pair"])
    sources = sources.sort_values("planned_at").drop_duplicates([*keys, "source_pair"], keep="last").set_index(keys)
    want = sources[sources.index.isin(quota.index)].reset_index()
    names = [*keys, "source_pair"]
    assert sorted(map(tuple, got[names].to_numpy())) == sorted(map(tuple, want[names].to_numpy())) and got["dataset"].nunique() > 1
    for k, part in got[got["warning"].isna()].groupby(keys):
        caps = part.merge(want, on=names).sort_values("source_pair")
        assert part.sort_values("source_pair")["alloc_tokens"].tolist() == budget.allocate(int(quota[k]), caps["total_tokens"].astype(int).tolist())


def test_repetition_of_long_texts():
    letters = "".join(np.random.default_rng(3).choice(list("abcdefghijklmnopqrstuvwxyz"), 3_000_000))
    end = " xyzxyz xyz xyz"
    assert T.repetition(letters[:2000] + end) == 3 and T.repetition(letters[:2000]) == 0
    assert T.repetition(letters + end) > 0
    for spaces in (1000, 100_000):
        assert T.repetition("abc" + " " * spaces + "abd" + end) == 3
