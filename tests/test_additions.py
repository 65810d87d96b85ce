"""Plans, sinks, scorers and vectors against brute force, with nulls, ties and empty tables."""

import heapq
import io
import os
import random
import zipfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import rows_of

from corpusloom import storage
from corpusloom.functions import text as T
from corpusloom.operators import budget, dedup, joint, retrieval, scoring, tracking
from corpusloom.sources import readers, reports, writers


def test_repetitions():
    rnd = random.Random(1)
    texts = [None, "", "abc", *("".join(rnd.choices("ab \n", [4, 4, 3, 1], k=rnd.randint(0, 40))) for _ in range(4000))]

    def brute(t):
        for i in range(len(t or "") - 2):
            seg = t[i : i + 3]
            if seg[0].isspace() or "\n" in seg:
                continue
            n, at = 0, i + 3
            while True:
                while at < len(t) and t[at] == " ":
                    at += 1
                if t[at : at + 3] != seg:
                    break
                n, at = n + 1, at + 3
            if n >= 2:
                return n
        return 0

    want = [brute(t) for t in texts]
    assert T.repetitions(texts).tolist() == want and sum(n > 0 for n in want) > 50
    assert T.repetitions([]).tolist() == []


def test_allocation_in_whole_units():
    rnd = random.Random(2)
    for _ in range(500):
        caps = [rnd.choice([0, 1, 5, rnd.randint(0, 10**12)]) for _ in range(rnd.randint(1, 9))]
        quota = rnd.choice([0, 1, rnd.randint(0, 2 * sum(caps) + 3)])
        shares = budget.allocate(quota, caps)
        assert sum(shares) == (quota if sum(caps) else 0) or quota > sum(caps) == 0
        if quota <= sum(caps):
            open_ = [s for s, c in zip(shares, caps) if s < c]
            assert all(s <= c for s, c in zip(shares, caps))
            # Those below their caps are level, and nobody has more than that level but for a unit.
            assert not open_ or max(open_) - min(open_) <= 1 and max(shares) <= max(open_) + 1
        elif sum(caps):
            assert all(abs(s - c - (quota - sum(caps)) * c / sum(caps)) < 1 + 1e-6 * s for s, c in zip(shares, caps))
    assert budget.english_side(None) is None


def test_packing(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", "c", "d", "e", "", None]), rnd.randint(0, 50)) for _ in range(200)]
    got = budget.pack_groups(spark.createDataFrame(data, "name string, n int"), "name", "n", 3).collect()
    sizes = Counter()
    for name, n in data:
        sizes[name] += n
    heap, want = [(0, b) for b in range(3)], {}
    for name, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0] is None, x[0])):
        load, b = heapq.heappop(heap)
        want[name] = (b, n)
        heapq.heappush(heap, (load + n, b))
    assert {r.name: (r.chunk, r.n) for r in got} == want and sum(r.n for r in got) == sum(n for _, n in data)
    assert budget.pack_groups(spark.createDataFrame([], "name string, n int"), "name", "n", 3).count() == 0


@pytest.mark.parametrize("slots", [3, 40])
def test_slots(spark, slots):
    shards = [(f"d{i}", k) for i, n in enumerate((7, 2, 9, 1)) for k in range(n)]
    by = defaultdict(list)
    for d, k in shards:
        by[d].append(k)
    used, want, at = [0] * slots, {}, 0
    sparse = len(shards) < slots
    for d in sorted(by, key=lambda d: (-len(by[d]), d)):
        slot = at
        for k in sorted(by[d]):
            if used[slot] >= 4:
                slot = (slot + 1) % slots
            want[(d, k)] = (slot, used[slot])
            used[slot] += 1
        at = (slot + 1) % slots if sparse else slot
    got = budget.assign_slots(spark.createDataFrame(shards, "d string, k int"), "d", "k", 4, slots)
    assert {(r.d, r.k): (r.slot, r.seq) for r in got.collect()} == want


def test_rate_windows(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["a", "a", None]), rnd.choice([3540 + rnd.randint(0, 120), 7190 + rnd.randint(0, 80), 60]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k string, s int, i int").withColumn("at", F.timestamp_seconds("s"))
    got = {r.i: r.n for r in tracking.rate_windows(df, ["k"], "at", 60).collect()}
    assert got == {i: sum(h == k and s - 60 < t <= s for h, t, _ in data) for k, s, i in data}


def test_probe_and_manifest(spark):
    kinds = "d string, k int"
    wanted = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1)], kinds)
    done = spark.createDataFrame([("a", 2), ("a", 3), ("c", 1), ("c", 1)], kinds)
    assert rows_of(tracking.probe(wanted, done, ["d"], ["k"])) == [("a", 2, 2, 1, 1), ("b", 1, 0, 1, 0), ("c", 0, 1, 0, 1)]
    jobs = spark.createDataFrame([("a", 2, "failed"), ("a", 3, "done"), ("z", 1, "failed"), (None, 1, "failed")], "d string, k int, status string")
    known = spark.createDataFrame([("a", "x", "y", 10)], "d string, src_lang string, tgt_lang string, shard_size int")
    assert rows_of(tracking.pending_manifest(jobs, known, "d", "k", ["failed"])) == [("a", 2, "x", "y", 20, 30)]


@pytest.mark.parametrize("shared_hash", [False, True])
def test_dedup_by_hash(spark, monkeypatch, shared_hash):
    rnd = random.Random(10)
    data = [(i, rnd.choice(["hot", "hot", "x", "y", "", None]), rnd.choice(["a", "b", None]), rnd.choice([None, 1, 1, 2, 3]), rnd.choice(["u", None])) for i in range(400)]
    data += data[:50]  # whole rows again
    df = spark.createDataFrame(data, "i int, s string, t string, at int, _n string").repartition(4)
    if shared_hash:  # every text has the first two hashes of all others
        real = F.xxhash64
        monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("bigint") if str(c[0]._jc) in ("1", "2") else real(*c))
    low = lambda v: (v is not None, v)
    want = {}
    for r in data:
        if r[1] is not None and r[2] is not None:
            want.setdefault(r[1:3], []).append((low(r[3]), low(r[4]), r[0], r))
    got = {(r.s, r.t): tuple(r) for r in dedup.dedup_by_hash(df, "s", "t", ["at", "_n"]).collect()}
    assert got == {k: min(rs, key=lambda x: x[:3])[3] for k, rs in want.items()}
    assert dedup.dedup_by_hash(df.filter("false"), "s", "t", ["at"]).count() == 0
    assert dedup.dedup_by_hash(df, "s", "t", ["_n", "at"]).count() == len(got)


# --- scorers ----------------------------------------------------------------------------------------------------------
def test_rate_limit():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limit = scoring.RateLimit(3, 60, lambda: now[0], sleep)
    times = []
    for _ in range(10):
        limit.wait()
        times.append(now[0])
        now[0] += 1
    assert all(b - a >= 60 for a, b in zip(times, times[3:])) and slept
    assert scoring.RateLimit.share(100, 8) == 12 and scoring.RateLimit.share(1, 8) == 1


def test_patient_scorer():
    calls, waits = [], []

    def flaky(s, t):
        calls.append(list(s))
        if "refused" in s:
            raise scoring.Refused
        if len(calls) < 3:
            raise OSError("busy")
        return [1.0] * len(s)

    score = scoring.patient(flaky, attempts=4, first_wait=1, longest_wait=1.5, sleep=waits.append)
    assert score(["a"], ["b"]) == [1.0] and waits == [1, 1.5]
    assert scoring.call_split(score, ["a", "refused", "c"], ["x"] * 3) == [1.0, None, 1.0] and waits == [1, 1.5]
    calls.clear()
    with pytest.raises(OSError):
        scoring.patient(flaky, attempts=2, sleep=waits.append)(["a"], ["b"])


def test_labels(spark):
    df = spark.createDataFrame([(1, "где мы"), (2, "hello"), (3, None), (4, " "), (5, "123")], "i int, t string").withColumn("label", F.lit("clash"))
    got = {r.i: (r.lang, r.p) for r in scoring.label_texts(df, "t", scoring.script_labeller, "lang", "p").collect()}
    assert got == {1: ("rus_Cyrl", 1.0), 2: ("eng_Latn", 1.0), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_reassignment(spark):
    rows = [("q-1", 100, True, None), ("q-1", 100, False, 0.01), ("q-1", 100, None, None), ("q-1", 5, True, 0.0), ("m", 100, True, 0.0), (None, 100, True, 0.0), ("q-2", None, True, 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, w string, n int, ok boolean, gap double")
    got = scoring.reassign_large(df, "w", "q-", "big", "small", F.col("n"), 50, F.col("ok"), F.col("gap"), 0.05)
    assert [r.w for r in got.orderBy("i").collect()] == ["big", "big", "small", "small", "m", None, "small"]


# --- vectors ----------------------------------------------------------------------------------------------------------
def test_cca_from_sums(spark):
    rng = np.random.default_rng(5)
    shared = rng.normal(size=(300, 2))
    x = np.hstack([shared @ rng.normal(size=(2, 3)), rng.normal(size=(300, 1)), np.ones((300, 1))])
    # Noise of two sizes, so that no two correlations are equal and components are unique.
    y = np.hstack([shared + rng.normal(size=(300, 2)) * [0.2, 0.9], rng.normal(size=(300, 3))])
    data = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*data, (900, None, y[0].tolist())], "i int, a array<double>, b array<double>").repartition(4)
    fitted = retrieval.cca_fit(df, "a", "b", 2)
    got = {r.i: (r.a, r.b) for r in retrieval.cca_apply(df, "a", "b", fitted).collect()}
    u, v = retrieval.cca(x, y, 2)
    gu, gv = (np.array([got[i][k] for i in range(300)]) for k in (0, 1))
    assert got[900][0] is None and len(got[900][1]) == 2
    # Signs of components are free, the same on both sides.
    sign = np.sign((gu * u).sum(axis=0))
    np.testing.assert_allclose(gu * sign, u, atol=1e-7)
    np.testing.assert_allclose(gv * sign, v, atol=1e-7)
    with pytest.raises(ValueError):
        retrieval.cca_fit(df.filter("false"), "a", "b")


def test_retrieval_blocks(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(90, 4))
    b = a + rng.normal(size=(90, 4))
    df = spark.createDataFrame([(i, "x" if i < 80 else None, a[i].tolist(), b[i].tolist()) for i in range(90)], "id int, g string, a array<double>, b array<double>")
    unit = lambda m: m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)
    sims = unit(a) @ unit(b).T
    for queries in (None, F.col("id") % 7 == 0):
        got = {r.id: r["rank"] for r in retrieval.diagonal_ranks(df, ["g"], "id", "a", "b", block=5, queries=queries).collect()}
        assert set(got) == set(range(90) if queries is None else range(0, 90, 7))
        for i, rank in got.items():
            own = range(80) if i < 80 else range(80, 90)
            assert rank == 1 + sum(sims[i, j] > sims[i, i] + 1e-12 for j in own if j != i)


def test_scaled_totals(spark):
    hist = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 6.0), ("b", 1, 5.0), ("c", 1, 0.0), (None, 1, 4.0)], "p string, bin int, w double")
    totals = spark.createDataFrame([("a", 80), ("b", None), ("c", 9)], "p string, t int")
    assert rows_of(joint.scale_to_totals(hist, totals, ["p"], "w", "t")) == sorted([("a", 1, 20.0), ("a", 2, 60.0), ("b", 1, 5.0), ("c", 1, 0.0), (None, 1, 4.0)], key=repr)


# --- storage, sinks, reports ------------------------------------------------------------------------------------------
def test_no_machine_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session())


def test_discard(spark):
    kept = storage.materialize(spark.range(3), "a")
    assert kept.count() == 3 and os.path.exists(kept._folder.removeprefix("file:").replace("//", "/"))
    storage.discard(kept, spark.range(1))
    assert not os.path.exists(kept._folder.removeprefix("file:").replace("//", "/"))


def test_publish_after_a_crash(spark, tmp_path):
    target = str(tmp_path / "t")
    writers.publish(spark.range(5), target)
    os.rename(target, target + ".old")  # between the two renames
    with pytest.raises(ValueError):
        writers.publish(spark.range(7), target, expected=6)
    assert spark.read.parquet(target).count() == 5
    writers.publish(spark.range(7), target)
    assert spark.read.parquet(target).count() == 7 and sorted(os.listdir(tmp_path)) == ["t"]


def test_byte_shards(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", None]), i, rnd.choice([None, 0, rnd.randint(1, 90), 500])) for i in range(300)]
    df = spark.createDataFrame(data, "g string, i int, n int")
    got = {r.i: r.file_no for r in writers.byte_shards(df, ["g"], [F.col("i")], F.col("n"), 100).collect()}
    sums = Counter()
    for g, i, n in data:
        assert got[i] == sums[g] // 100
        sums[g] += n or 0


def test_rehome(spark, tmp_path):
    rows = [("a-b", "a-b", "f", 1), ("x-b", "a-b", "f", 2), ("y-b", "a-b", "f", 3), ("x-b", "x-b", "g", 4), ("z-b", "c-b", "h", 5)]
    df = spark.createDataFrame(rows, "home string, new_home string, name string, v int")
    writers.rehome(df, str(tmp_path / "out"), "home", "new_home", "name")
    assert rows_of(spark.read.parquet(str(tmp_path / "out")).select("new_home", "new_name", "v")) == [
        ("a-b", "f", 1), ("a-b", "f.moved-1", 2), ("a-b", "f.moved-2", 3), ("c-b", "h", 5), ("x-b", "g", 4),
    ]


def test_verified_union(spark):
    a, b = spark.range(3).withColumn("src_text", F.lit("x")), spark.range(2).withColumn("n", F.lit(1))
    good = a.withColumnRenamed("src_text", "source_text").unionByName(b, allowMissingColumns=True)
    assert writers.verify_union([a, b], good, {"src_text": "source_text"}) == 5
    for wrong in (good.limit(4), good.drop("n"), good.withColumn("n", F.col("n").cast("string"))):
        with pytest.raises(ValueError):
            writers.verify_union([a, b], wrong, {"src_text": "source_text"})


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1, 0.5), ("<x>\ny", None, None)], "name string, n int, v double").coalesce(1)
    assert reports.markdown(df) == "| name | n | v |\n| --- | --- | --- |\n| a\\|b | 1 | 0.5 |\n| <x> y |  |  |\n"
    page = reports.html_page(df, "t & u")
    assert "&lt;x&gt;" in page and "t &amp; u" in page and "<td></td>" in page
    reports.write_workbook(df, str(tmp_path / "w.xlsx"))
    (tmp_path / "broken.xlsx").write_bytes(b"none")
    assert rows_of(readers.read_workbook(spark, str(tmp_path / "*.xlsx"), ["n", "name"])) == [("1", "a|b"), (None, "<x>\ny")]
    # Shared strings, cells without places, and a column that isn't there.
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>pair</t></si><si><r><t>eng</t></r><r><t>-deu</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {space}><sheetData><row><c t="s"><v>0</v></c><c t="inlineStr"><is><t>n</t></is></c></row><row><c t="s"><v>1</v></c><c><v>7</v></c></row></sheetData></worksheet>')
    (tmp_path / "shared.xlsx").write_bytes(out.getvalue())
    assert rows_of(readers.read_workbook(spark, str(tmp_path / "shared.xlsx"), ["pair", "n"])) == [("eng-deu", "7")]
    assert readers.read_workbook(spark, str(tmp_path / "shared.xlsx"), ["nope"]).count() == 0
    reports.write_markdown({"one": df, "two": df}, str(tmp_path / "r.md"))
    reports.write_page(df, str(tmp_path / "r.html"), "t")
    assert (tmp_path / "r.md").read_text().count("## ") == 2 and (tmp_path / "r.html").read_text() == reports.html_page(df, "t")
