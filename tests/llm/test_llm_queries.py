"""The registered queries of the package: SQL where there is any, whole results otherwise."""

import pytest
from oracle import compare
from test_algorithms import greedy

import __spark_entry__ as entry
from corpusloom.llm import queries
from corpusloom.llm.bytebpe import byte_bpe


def test_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE) <= set(queries.QUERIES)
    names = list(queries.QUERIES)
    for n in range(1, 10):
        assert any(name.startswith(f"p{n}_") for name in names)
    assert names.index("p1_method") == 0 and names.index("p5_method") < names.index("p5_found")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, sf, duck, name):
    assert compare(queries.QUERIES[name](spark, sf), duck, queries.ORACLE[name]) == ""


def test_tokens(spark, sf):
    encode = byte_bpe().encoding.encode_ordinary
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    pairs = spark.read.parquet(f"{sf}/bitext.parquet").select("pair_id", "source_text", "target_text").collect()
    want = [("documents", i, 0, len(encode(t or ""))) for i, t in docs.items()]
    want += [("bitext", r.pair_id, side, len(encode(t or ""))) for r in pairs for side, t in ((1, r.source_text), (2, r.target_text))]
    assert sorted(map(tuple, queries.p1_tokens(spark, sf).collect())) == sorted(want)
    assert queries.p1_method(spark, sf).count() == len(want)
    assert dict(queries.p7_ids(spark, sf).collect()) == {i: encode(t or "") for i, t in docs.items()}
    long = {i for i, t in docs.items() if len(encode(t or "")) > 2048}
    assert {r.doc_id for r in queries.p9_found(spark, sf).collect()} == long
    slices = queries.p1_slices(spark, sf)
    assert slices.groupBy("slice").sum("n_tokens").distinct().count() == 3
    assert {r[1] for r in slices.groupBy("slice").sum("n_tokens").collect()} == {sum(n for k, _, _, n in want if k == "documents")}
    assert queries.p1_source_pairs(spark, sf).count() > 100


def test_segments(spark, sf):
    found = queries.p4_found(spark, sf)
    assert found.columns == ["sample_id", "side", "segment_no", "lang"] and 0 < found.count() < queries.p4_segments(spark, sf).count()
    texts = queries.p4_texts(spark, sf)
    assert texts.groupBy("sample_id", "side").count().filter("count > 1").count() == 0


def test_leaks_and_pieces(spark, sf):
    assert queries.p8_leaks(spark, sf).count() >= queries.p8_found(spark, sf).count()
    assert queries.p9_pieces(spark, sf).filter("n_tokens > 2048").count() == 0


def test_mix(spark, sf):
    report = queries.p5_report(spark, sf)
    assert queries.p5_method(spark, sf).count() == report.agg({"actual_records": "sum"}).first()[0]

def test_best_path_totals(spark, sf):
    sizes = queries.p1_method(spark, sf).toPandas()
    key = sizes.columns[-1]
    documents = sizes[sizes.iloc[:, 0] == "documents"][key].sum()
    slices = queries.QUERIES["p1_method_slices"](spark, sf).toPandas().groupby("slice")["n_tokens"].sum()
    assert len(slices) == 3 and (slices == documents).all()
    pairs = queries.QUERIES["p1_method_source_pairs"](spark, sf).toPandas().drop_duplicates("source_pair")
    assert pairs["held_tokens"].sum() == sizes[key].sum() - documents


def test_capped_contributors(spark, sf):
    """Three contributors a pair, against taking pairs one by one in order of quality."""
    records, decided = queries._several(spark, sf)
    rows = [(r.pair_id, r.contributors, r.score) for r in records.collect()]
    assert sum(len(c) > 1 for _, c, _ in rows) > 0.9 * len(rows)
    caps = {c: len(rows) * (4 if c.startswith("corpus:") else 10) // 100 for _, cs, _ in rows for c in cs}
    gone = {i for i, _, _ in rows} - greedy(rows, caps)
    assert {r.pair_id for r in decided.filter("not kept").collect()} == gone and 0 < len(gone) < len(rows)
    left = {}
    for i, cs, _ in rows:
        for c in cs if i not in gone else ():
            left[c] = left.get(c, 0) + 1
    assert all(n <= caps[c] for c, n in left.items())
