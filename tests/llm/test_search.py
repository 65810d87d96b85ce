"""Leak search against brute force, language segments against held-out labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import langid, leaks
from corpusloom.llm.languages import LANGUAGES, language_of, source_key


def fewest_edits(text: str, item: str, window: int) -> int:
    """Fewest edits between any passage of the item and any part of the text."""
    n = min(window, len(item))
    best = n
    for a in range(len(item) - n + 1):
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item[a : a + n], 1):
            before, row[0] = row[0], i
            for j, y in enumerate(text, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        best = min(best, min(row))
    return best


def test_normalise():
    assert leaks.normalise("É, é – 5½ Ä!") == "ééé5½ä"[1:] or leaks.normalise("É") == "é"
    assert leaks.normalise("É x-1") == "éx1" and leaks.normalise(None) == "" and leaks.normalise(" ,") == ""


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_against_brute_force(spark, errors):
    rnd, window = random.Random(10 + errors), 20
    word = lambda k: "".join(rnd.choices("abcd", k=k))
    items = [(f"i{i}", word(rnd.choice([3, 8, 12, 19, 20, 21, 33, 50]))) for i in range(14)] + [("null", None), ("empty", "?!"), ("i0", "x")]
    items += [("same", items[3][1].upper()), items[4]]

    def damaged(text, times):
        for _ in range(times):
            at, kind = rnd.randrange(len(text) + 1), rnd.randrange(3)
            text = text[:at] + (rnd.choice("abcd") if kind else "") + text[at + (kind != 1) :]
        return text

    docs = []
    for i in range(160):
        item = rnd.choice(items[:14])[1]
        a = rnd.randrange(max(1, len(item) - 18))
        docs.append((i, word(rnd.randint(0, 25)) + damaged(item[a : a + rnd.randint(18, 40)], rnd.randint(0, 4)) + word(rnd.randint(0, 25))))
    docs += [(900, None), (901, ""), (902, "...")]
    d = spark.createDataFrame(docs, "doc_id int, text string").withColumn("item_id", F.lit("clash"))
    t = spark.createDataFrame(items, "item_id string, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.edits for r in leaks.find_leaks(d, t, window=window, errors=errors).collect()}
    want = {}
    for i, text in docs:
        for name, item in set(items):
            clean = leaks.normalise(item)
            if text and clean:
                budget = min(errors, errors * len(clean) // window)
                n = fewest_edits(text, clean, window)
                if n <= budget:
                    want[(i, name)] = min(n, want.get((i, name), 99))
    assert got == want
    if errors < 3:
        parted = leaks.find_leaks(d, t, window=window, errors=errors, block_chars=150)
        assert {(r.doc_id, r.item_id): r.edits for r in parted.collect()} == want


def test_leaks_edges(spark):
    d = spark.createDataFrame([(1, "x" * 100_000 + "The Answer, to: everything is FORTY-two and no more than that, they all said to us at last")], "doc_id int, text string")
    t = spark.createDataFrame([("a", "the answer to everything is forty two and no more than that they all said to us, at last"), ("b", "x")], "item_id string, text string")
    assert sorted((r.item_id, r.edits) for r in leaks.find_leaks(d, t).collect()) == [("a", 0), ("b", 0)]
    assert leaks.find_leaks(d.filter("false"), t).count() == 0
    assert leaks.find_leaks(d, t.filter("false")).count() == 0
    with pytest.raises(ValueError):
        leaks.find_leaks(d, t, errors=9)


# --- languages --------------------------------------------------------------------------------------------------------
def test_spellings(spark):
    codes = [("en", "eng_Latn"), ("ENG", "eng_Latn"), ("eng-Latn ", "eng_Latn"), ("zh", "zho_Hans"), ("und", None), ("", None), (None, None), ("??", None), ("xx", None)]
    df = spark.createDataFrame([(c, w) for c, w in codes], "c string, w string")
    assert all(r.l == r.w for r in df.select("w", language_of(F.col("c")).alias("l")).collect())
    more = spark.createDataFrame([("hun_Latn", "hun_Latn"), ("HUN-latn", "hun_Latn"), (" hunLatn ", "hun_Latn"), ("hun", None), ("hun_Lat", None), ("h1n_Latn", None)], "c string, w string")
    assert [r.l for r in more.select(language_of(F.col("c")).alias("l")).collect()] == [r.w for r in more.collect()]
    names = spark.createDataFrame([("Web Matrix",), ("web-matrix",), (" WEB_MATRIX.",), ("web matrix",)], "s string")
    assert [r.k for r in names.select(source_key(F.col("s")).alias("k")).distinct().collect()] == ["webmatrix"]
    assert spark.createDataFrame([(" .-",), (None,)], "s string").select(source_key(F.col("s")).alias("k")).filter("k is not null").count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    b = spark.read.parquet("/root/testdata/sf0.01/bitext.parquet")
    return b.select("pair_id", F.col("src_lang").alias("lang"), F.col("source_text").alias("text")).union(b.select("pair_id", "tgt_lang", "target_text")).filter("text is not null and lang is not null")


@pytest.fixture(scope="module")
def model(labelled):
    return langid.fit(labelled.filter("pair_id % 3 > 0"))


def test_held_out(spark, labelled, model):
    held = labelled.filter("pair_id % 3 = 0").dropDuplicates(["text"]).withColumn("id", F.monotonically_increasing_id()).cache()
    found = langid.segments(held, model, ["id"]).groupBy("id").agg(F.max_by("lang", "n_words").alias("found"), F.count("*").alias("n"))
    joined = found.join(held, "id").cache()
    # A few labels are wrong themselves: those are the rows that a model can't agree with.
    assert joined.filter("found = lang").count() / joined.count() > 0.95
    assert joined.filter("n = 1").count() / joined.count() > 0.97
    assert set(model.languages) == set(LANGUAGES)


def test_mixed_segments(spark, labelled, model):
    rnd = random.Random(6)
    pool = {}
    ends = labelled.filter("pair_id % 3 = 0 and length(text) between 40 and 200").filter(F.regexp_like("text", F.lit(r"^\p{Lu}.*[.!?]$")))
    for r in ends.collect():
        pool.setdefault(r.lang, []).append(r.text)
    rows, want = [], {}
    for i in range(400):
        langs = [rnd.choice(sorted(pool))]
        while len(langs) < rnd.choice([1, 2, 3]):
            langs.append(rnd.choice([x for x in sorted(pool) if x != langs[-1]]))
        rows.append((i, " ".join(rnd.choice(pool[x]) for x in langs)))
        want[i] = langs
    got = {}
    for r in langid.segments(spark.createDataFrame(rows, "id int, text string"), model, ["id"]).orderBy("id", "segment_no").collect():
        got.setdefault(r.id, []).append(r.lang)
        assert r.segment_no == len(got[r.id]) and 0 < r.confidence <= 1
    assert np.mean([got.get(i) == w for i, w in want.items()]) > 0.9  # wrong labels count against it


def test_segment_edges(spark, model):
    rows = [(1, None), (2, ""), (3, " 12:30 %1$s <b></b> ♪"), (4, "Das ist ein Haus und wir sind heute nicht hier. " * 3000), (5, "x"), (1, "The house is here and we are not at home today.")]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("lang", F.lit("clash"))
    got = langid.segments(df, model, ["id"]).collect()
    assert {r.id for r in got} == {1, 4, 5} and {r.lang for r in got if r.id == 4} == {"deu_Latn"} and sum(r.id == 4 for r in got) == 1
    assert [r.lang for r in got if r.id == 1] == ["eng_Latn"]
    assert langid.segments(df.filter("false"), model, ["id"]).count() == 0
    with pytest.raises(ValueError):
        langid.fit(df.filter("false").select("lang", "text"))


def test_sample_bound(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("lang"), F.concat(F.lit("word"), F.col("id")).alias("text"))
    assert langid.fit(df, per_language=50).languages == ["a", "b"]


def test_grams():
    bucket, owner = langid.grams(["ab", "c"])
    # " ab " and " c ": 2 + 3 + 2 + 1 and 1 + 2 + 1 + 0 grams of 1 to 4 characters
    assert np.bincount(owner).tolist() == [8, 4] and len(set(bucket.tolist())) == 12


def test_planted_passages(spark):
    """Passages of 60 characters with one or two edits among texts that have nothing to do with the items."""
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(3000)]
    items = [(f"i{k}", " ".join(rnd.choices(words, k=30))) for k in range(40)]
    docs, want = [], {}
    for n in range(400):
        item, text = rnd.choice(items)
        clean = leaks.normalise(text)
        at = rnd.randrange(len(clean) - 60 + 1)
        passage, edits = list(clean[at : at + 60]), 1 + n % 2
        for k in rnd.sample(range(1, 59), edits):
            passage[k] = rnd.choice([rnd.choice("0123"), passage[k] + rnd.choice("0123"), ""])
        docs.append((n, " ".join([*rnd.choices(words, k=20), "".join(passage), *rnd.choices(words, k=20)])))
        want[(n, item)] = edits
    docs += [(1000 + n, " ".join(rnd.choices(words, k=60))) for n in range(200)]
    found = leaks.find_leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string"), window=60, errors=2, block_chars=4000)
    got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    assert set(got) == set(want) and all(0 < got[k] <= e for k, e in want.items())


def test_thirteenth_language(spark, labelled):
    """A language that no list has is learnt, found and kept apart."""
    rnd = random.Random(9)
    words = ["".join(rnd.choices("bdgkmnptvzaouy", k=rnd.randint(3, 8))) + "ok" for _ in range(300)]
    own = spark.createDataFrame([(" ".join(rnd.choices(words, k=12)),) for _ in range(200)], "text string").select(F.lit("qtz_Latn").alias("lang"), "text")
    nb = langid.fit(labelled.select(language_of(F.col("lang")).alias("lang"), "text").union(own))
    assert "qtz_Latn" in nb.languages and len(nb.languages) == len(LANGUAGES) + 1
    test = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=10))) for i in range(20)], "id int, text string")
    assert {r.lang for r in langid.segments(test, nb, ["id"]).collect()} == {"qtz_Latn"}
