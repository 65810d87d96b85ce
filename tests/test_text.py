"""Text features by hand-computed cases and brute force."""

import random
from math import log

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import values as V


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double", bool: "boolean"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, count", [("a  b ", 3), (" x", 2), ("", 1), (None, None), ("a b", 2)])
def test_words(spark, text, count):
    assert one(spark, T.word_stats(F.col("t"))["word_len"], t=text) == count


def test_word_stats_modes(spark):
    assert one(spark, T.word_stats(F.col("t"))["avg_word_len"], t="ab abc") == 2.0
    assert one(spark, T.word_stats(F.col("t"), mode="fixed")["avg_word_len"], t="ab abc") == 2.5
    assert one(spark, T.word_stats(F.col("t"), F.lit("zho_Hans"))["word_len"], t="我们 好") == 4
    assert one(spark, T.word_stats(F.col("t"), F.lit("zho_Hans"))["max_word_len"], t="我们") == 1.0


def test_length_ratio(spark):
    assert one(spark, T.length_ratio(F.lit(7), F.lit(2)), z=1) == 3.0
    assert one(spark, T.length_ratio(F.lit(7), F.lit(2), "fixed"), z=1) == 3.5
    assert one(spark, T.length_ratio(F.lit(5), F.lit(0)), z=1) == 5.0


def test_punctuation(spark):
    score = T.terminal_punctuation_score(F.col("a"), F.col("b"))
    assert one(spark, score, a="Hi.", b="Hallo!!") == pytest.approx(-log(3))
    assert one(spark, score, a="", b="x") == -20.0
    assert one(spark, score, a="a", b="b") == 0.0
    assert one(spark, score, a="好。", b="ok।") == 0.0


def test_flags(spark):
    assert one(spark, T.html_flag(F.col("t")), t="a <b>c") is True
    assert one(spark, T.html_flag(F.col("t")), t="1 < 2 > 0") is False
    assert one(spark, T.html_flag(F.col("t")), t=None) is False
    assert one(spark, T.regex_flag(F.col("t"), None), t="x") is False


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text("abc", max_size=40), st.text("abcd", max_size=40))
@settings(max_examples=300, deadline=None)
def test_lcs(a, b):
    assert T.lcs_length(a, b) == brute_lcs(a, b)


def test_numerals():
    assert T.numeral_ratio("no", "none") == 1.0
    assert T.numeral_ratio("1", "none") == 0.0
    assert T.numeral_ratio("", "1") == 0.0
    assert T.numeral_ratio("1203", "12 3") == 1.0  # zeros don't count
    assert T.numeral_ratio("١٢", "12") == 1.0
    assert T.numeral_ratio("12", "13") == 0.5


def test_repetition():
    assert T.repetition("abcabcabc") == 2
    assert T.repetition("abc abc abc abc") == 3
    assert T.repetition("abcabc") == 0
    assert T.repetition("") == T.repetition(None) == 0


def brute_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_pair_udfs(spark):
    rnd = random.Random(3)
    rows = [("".join(rnd.choices("abcé好 ", k=rnd.randint(0, 25))), "".join(rnd.choices("abcé好 ", k=rnd.randint(0, 25)))) for _ in range(200)]
    rows += [(None, "x"), ("x", None), (None, None), ("", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = {r.i: r for r in df.select("i", T.lcs_ratio("a", "b").alias("l"), T.levenshtein_similarity(F.col("a"), F.col("b")).alias("v"), T.same_text("a", "b").alias("s")).collect()}
    for i, (a, b) in enumerate(rows):
        assert got[i].l == pytest.approx(brute_lcs(a, b) / min(len(a), len(b)) if a and b else 0.0)
        x, y = a or "", b or ""
        assert got[i].v == pytest.approx(1 - brute_levenshtein(x, y) / max(len(x), len(y)) if x or y else 1.0)
        assert got[i].s == (None if a is None or b is None else a.split() == b.split())


def test_same_text_is_normalised(spark):
    df = spark.createDataFrame([("é x", " é  x ")], "a string, b string")
    assert df.select(T.same_text("a", "b").alias("s")).first().s is True


def test_script_share(spark):
    share = T.script_share(F.col("t"), F.col("s"))
    assert one(spark, share, t="abc где", s="Latn") == 0.5
    assert one(spark, share, t="漢字かな", s="Jpan") == 1.0
    assert one(spark, share, t="123", s="Latn") is None
    assert one(spark, share, t="abc", s="Xxxx") is None


def test_scalars(spark):
    assert one(spark, V.seconds_of(F.col("t")), t="01:02:03") == 3723
    assert one(spark, V.seconds_of(F.col("t")), t="soon") is None
    assert one(spark, V.safe_name(F.col("t")), t=" org/My  Model!v2 ") == "My_Model_v2"
    assert one(spark, V.safe_name(F.col("t")), t="//") == "model"
    assert one(spark, V.truncated(F.col("t"), 5), t="ab\ncdefg") == "ab c…"
    assert one(spark, V.clean_prediction(F.col("t"), ["German", "deu_Latn"]), t="\n german : Hallo\nWelt") == "Hallo"
    assert one(spark, V.trimmed_error(F.col("t")), t="") is None
    assert len(one(spark, V.trimmed_error(F.col("t")), t="x" * 5000)) == 1000
    assert one(spark, V.finite(F.lit(float("nan"))), z=1) is None
    assert one(spark, V.truth(F.col("t")), t=" YES ") is True
    assert one(spark, V.truth(F.col("t")), t="maybe") is None
    assert one(spark, V.score_bin(F.lit(1.0), 20), z=1) == 19


@pytest.mark.parametrize("reply, clipped, strict", [
    ('<think>{"x"}</think>{"results":[{"id":0,"overall_0to100":80}]}', [0.8, None], [0.8, None]),
    ('```json\n{"results":[{"id":1,"overall_0to100":120}]}\n```', [None, 1.0], [None, None]),
    ("nothing", [None, None], [None, None]), (None, [None, None], [None, None]),
    ('{"results":[{"id":0,"overall_0to100":10},{"id":0,"overall_0to100":20}]}', [0.2, None], [0.2, None]),
])
def test_replies(spark, reply, clipped, strict):
    assert one(spark, V.reply_scores(F.col("t"), 2), t=reply) == clipped
    assert one(spark, V.reply_scores(F.col("t"), 2, "null"), t=reply) == strict


def test_hashes():
    u = V.splitmix_uniform_np(np.arange(100_000), V.shard_salt(42, "a-b", "0"))
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    assert (u[7:9] == V.splitmix_uniform_np(np.array([7, 8]), V.shard_salt(42, "a-b", "0"))).all()
    assert V.fnv1a(b"") == 2166136261 and V.fnv1a(b"a") == 0xE40C292C
    assert 0 <= V.blake2b_int("x") % 16 < 16
    assert len(V.subword_buckets("ab", 2, 3, 1000)) == 5  # <a ab b> <ab ab>


def test_cosine(spark):
    c = V.cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0)))
    assert one(spark, c, z=1) == pytest.approx(0.96)
    assert one(spark, V.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))), z=1) == 0.0
