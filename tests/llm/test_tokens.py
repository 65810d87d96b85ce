"""Encoding, counting and splitting against plain encoders and brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import splitting, tokens
from corpusloom.llm.bytebpe import BYTE_BPE_50K, byte_bpe, cut_table, read_ranks
from corpusloom.llm.unigram import DoubleArrayTrie, UnigramVocabulary

ODD = ["a", "b", " ", "  ", "'", "'s", "'re", "'ll", "\n", "\r\n", "\t", "　", " ", " ", " ", "\u0085", " ", "\x1c", "x", "1", "٣", "!", "?", "é", "é", "中文", "\U0001f600", "ж", "‏", "﻿"]


def test_encode_odd_texts():
    bpe, rnd = byte_bpe(), random.Random(1)
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(0, 40))) for _ in range(20_000)]
    assert bpe.encode(pa.array(texts)).to_pylist() == [bpe.encoding.encode_ordinary(t) for t in texts]


@given(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_encode_any_text(texts):
    bpe = byte_bpe()
    arr = pa.array(texts, pa.string())
    ids = [bpe.encoding.encode_ordinary(t or "") for t in texts]
    assert bpe.encode(arr).to_pylist() == ids and bpe.count(arr).to_pylist() == [len(i) for i in ids]
    assert bpe.encode(arr[1:]).to_pylist() == ids[1:]


def test_encode_long_texts():
    bpe, rnd = byte_bpe(), random.Random(2)
    texts = ["x" * 20_000, " " * 5_000 + "y", "".join(rnd.choices("abcdefghij", k=30_000)), "字" * 5_000, "a b" * 50_000]
    assert bpe.encode(pa.array(texts)).to_pylist() == [bpe.encoding.encode_ordinary(t) for t in texts]


def test_cut_table():
    cut = cut_table([b"ab", b" c", b"d"]).reshape(256, 256)
    assert not cut[ord("a"), ord("b")] and cut[ord("b"), ord("a")] and not cut[32, ord("d")] and not cut[ord("'"), ord("s")] and not cut[0xC3, 0xA9]


def test_encode_corpus(spark, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("ids", F.lit("clash"))
    got = dict(tokens.encode_corpus(docs).collect())
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id] == tokenizer.encode(r.text or "", add_special_tokens=False).ids
    assert tokens.encode_corpus(docs.filter("false")).count() == 0


def test_trie():
    rnd = random.Random(3)
    words = sorted({bytes(rnd.choices(range(256), k=rnd.randint(1, 6))) for _ in range(3000)})
    trie = DoubleArrayTrie(words)
    def find(word):
        state = 0
        for byte in word:
            to = trie.base[state] + byte
            if trie.check[to] != state:
                return -1
            state = to
        return trie.token[state]
    assert [find(w) for w in words] == list(range(len(words)))
    known = set(words)
    assert all(find(w) == -1 for w in (bytes(rnd.choices(range(256), k=4)) for _ in range(2000)) if w not in known)


def brute_count(vocabulary, tokens_, text):
    data = text.encode()
    best = [(0.0, 0)] + [None] * len(data)
    for j in range(1, len(data) + 1):
        for i in range(max(0, j - vocabulary.longest), j):
            number = tokens_.get(data[i:j])
            if number is not None and best[i] is not None:
                score = best[i][0] + vocabulary.score[number]
                if best[j] is None or score > best[j][0] + 1e-9:
                    best[j] = (score, best[i][1] + 1)
    return best[-1][1]


def test_unigram():
    vocabulary = UnigramVocabulary.from_ranks(BYTE_BPE_50K)
    by_token = {t: i for i, (t, _) in enumerate(sorted(read_ranks(BYTE_BPE_50K).items(), key=lambda x: x[1]))}
    rnd = random.Random(4)
    texts = ["".join(rnd.choices([*ODD, "the ", "ing", " Haus", "tion", "ется "], k=rnd.randint(0, 30))) for _ in range(300)]
    assert vocabulary.count(pa.array(texts)).to_pylist() == [brute_count(vocabulary, by_token, t) for t in texts]
    assert vocabulary.count(pa.array([None, "", "x" * 5000], pa.string())).to_pylist()[:2] == [0, 0]
    assert vocabulary.count(pa.array([], pa.string())).to_pylist() == []


def test_unigram_tiny():
    vocabulary = UnigramVocabulary([b"a", b"b", b"ab", b"abab"], np.log([0.2, 0.2, 0.5, 0.1]))
    assert vocabulary.count(pa.array(["abab", "aab", "b", "abababab"])).to_pylist() == [2, 2, 1, 4]


def test_budget(spark, sf):
    docs = spark.createDataFrame(
        [(1, "one two", "en", "Web Matrix", "web"), (2, None, None, None, None), (3, "", "ENG-Latn", "web.matrix", " Web"), (4, "eins", "xx", "", "news")],
        "doc_id int, text string, lang string, source string, domain string",
    )
    plan = spark.createDataFrame([("eng_Latn", 10), ("eng_Latn", None), ("deu_Latn", -1)], "lang string, available_tokens bigint")
    got = {(r.slice, r.value): (r.n_docs, r.n_tokens, r.available_tokens) for r in tokens.budget_by_slice(docs, plan, tokens.token_count()).collect()}
    n = byte_bpe().count(pa.array(["one two", "eins"])).to_pylist()
    assert got[("source", "webmatrix")] == (2, n[0], None) and got[("source", None)] == (2, n[1], None)
    assert got[("language", "eng_Latn")] == (2, n[0], 10) and got[("language", None)] == (2, n[1], None)
    assert got[("domain", "web")] == (2, n[0], None)
    assert tokens.budget_by_slice(docs.filter("false"), plan, tokens.token_count()).count() == 0


# --- splitting --------------------------------------------------------------------------------------------------------
def check_pieces(text, pieces, limit, overlap):
    bpe = byte_bpe()
    ids = bpe.encoding.encode_ordinary(text)
    pieces = sorted(pieces, key=lambda p: p.piece_no)
    assert [p.piece_no for p in pieces] == list(range(1, len(pieces) + 1)) and all(p.n_pieces == len(pieces) for p in pieces)
    assert pieces[0].begin_token == 0 and pieces[-1].end_token == len(ids)
    for before, p in zip([None, *pieces], pieces):
        assert p.n_tokens == p.end_token - p.begin_token <= limit
        whole = bpe.encoding.decode_bytes(ids[p.begin_token : p.end_token])
        assert whole.endswith(p.piece_text.encode()) and len(whole) - len(p.piece_text.encode()) < 4
        if before is not None:
            assert p.overlap_tokens == overlap and p.begin_token == before.end_token - overlap
    assert (len(pieces) > 1) == (len(ids) > limit)


def test_splitting(spark):
    rnd = random.Random(5)
    words = ["house", "Haus.", "river!", "one\n", "\n\n", "дом", "好。", "x" * 90, "\U0001f600" * 20, "'s", "  "]
    texts = [" ".join(rnd.choices(words, k=k)) for k in (1, 5, 40, 200, 900)] + ["字" * 3000, "q" * 5000, " " * 900, "\n" * 900, "a b " * 700, "é" * 2000, "好。" * 800]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(100, None, "c"), (101, "", "c"), (0, texts[0], "c")]
    df = spark.createDataFrame(rows, "doc_id int, text string, piece_no string")
    for limit, overlap in ((64, 16), (200, 0), (2048, 128)):
        got = defaultdict(list)
        for p in splitting.split_oversized(df, limit=limit, overlap=overlap).collect():
            got[p.doc_id].append(p)
        assert set(got) == set(range(len(texts)))
        assert len(got[0]) == 2  # a repeated row
        for i, t in enumerate(texts[1:], 1):
            check_pieces(t, got[i], limit, overlap)
    assert splitting.split_oversized(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        splitting.split_oversized(df, limit=10, overlap=10)


def test_boundaries_are_natural():
    text = "\n\n".join(". ".join(["Some words of a sentence that goes on"] * 4) + "." for _ in range(12))
    bpe = byte_bpe()
    ids = bpe.encoding.encode_ordinary(text)
    ends = np.cumsum([len(bpe.encoding.decode_single_token_bytes(i)) for i in ids])
    cuts = splitting.cut_points(text, ends, 100, 10)
    assert len(cuts) > 1 and all(kind == splitting.PARAGRAPH for _, kind in cuts)


def test_agglomerate():
    # Weak boundaries go first; a pair that would be too large stays apart.
    assert splitting.agglomerate([3, 3, 3, 3], [9, 1, 2, 1], 6, 0) == [0, 2]
    assert splitting.agglomerate([3, 3, 3, 3], [9, 2, 1, 2], 6, 0) == [0, 1, 3]
    assert splitting.agglomerate([3, 3, 3], [9, 1, 1], 6, 1) == [0, 2]
    assert splitting.agglomerate([5], [9], 6, 1) == [0]


def test_kinds_of_breaks():
    at, kind = splitting.breaks("A b. C\nd\n\ne。f")
    assert list(zip(at, kind)) == [(1, 1), (4, 2), (6, 3), (8, 4), (12, 2)]


def test_budget_of_other_languages(spark):
    docs = spark.createDataFrame([(1, "one two", "hun_Latn", "s", "d"), (2, "one", "HUN-Latn", "s", "d"), (3, "one", "nope", "s", "d")], "doc_id int, text string, lang string, source string, domain string")
    plan = spark.createDataFrame([("hun_Latn", 7)], "lang string, available_tokens bigint")
    got = {r.value: (r.n_docs, r.available_tokens) for r in tokens.budget_by_slice(docs, plan, tokens.token_count()).filter("slice = 'language'").collect()}
    assert got == {"hun_Latn": (2, 7), None: (1, None)}
