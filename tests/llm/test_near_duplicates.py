import random

import numpy as np
import pytest

from riskloom.llm import components as cc
from riskloom.llm import embedding_dedup, minhash


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(1000, i) for i in range(50)],
        "random": [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(5, 5)],
        "none": [],
    }[shape]
    got = {r.node: r.component for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: c for n, c in groups({x for l in links for x in l}, links).items() if n in nodes}


def shingles(text, words):
    own = (text or "").encode().lower().split()
    size = min(words, len(own))
    return {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()


def brute_documents(rows, words, up, down):
    sets = [shingles(text, words) for _, text in rows]
    links = [
        (i, j)
        for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None
        and len(sets[i] & sets[j]) * down >= up * len(sets[i] | sets[j])
    ]
    part = groups(range(len(rows)), links)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[part[i]] = min((d for d in (least.get(part[i]), doc) if d is not None), default=None)
    return sorted(((rows[i][0], len(sets[i]), least[part[i]]) for i in range(len(rows))), key=str)


def near_copies(seed, n_groups, size, edits, words=120):
    rng = random.Random(seed)
    rows = []
    for g in range(n_groups):
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
            rows.append((len(rows) * 3 + seed, " ".join(own)))
    return rows


@pytest.mark.parametrize(("words", "least"), [(3, (85, 100)), (5, (80, 100))])
def test_near_documents_against_brute_force(spark, words, least):
    # Copies with up to six edits lie on both sides of the threshold; one group is larger than PAIRED.
    rows = near_copies(1, 12, 6, 6) + [(i + 10_000, t) for i, t in near_copies(2, 1, 60, 8)]
    rows += [(90_001, None), (90_002, ""), (90_003, " \t\n"), (90_004, "two words"), (90_005, "TWO  words"), (90_006, "one")]
    rows += [(None, rows[0][1]), (90_007, rows[0][1]), (90_008, rows[0][1].upper()), (rows[1][0], rows[1][1])]
    rows += [(90_009, "É x y z é q"), (90_010, "é x y z é q"), (90_011, "long " * 30_000 + "end"), (90_012, "long " * 30_000 + "end")]
    docs = spark.createDataFrame([(*r, "n", "k") for r in rows], "doc_id long, text string, node string, key string").repartition(6)
    got = minhash.near_duplicates(docs, words=words, least=least).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_documents(rows, words, *least)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_blocks_give_the_links_that_pairs_give(spark, monkeypatch):
    rows = near_copies(5, 2, 40, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_documents(rows, 3, 85, 100)
    for paired, block, chunk, strip in [(10_000, 1024, 256, 4096), (2, 16, 7, 50)]:
        for name, value in (("PAIRED", paired), ("BLOCK", block), ("CHUNK", chunk), ("STRIP", strip)):
            monkeypatch.setattr(minhash, name, value)
        got = minhash.near_duplicates(docs, words=3, least=(85, 100)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want


def test_signatures_estimate_the_likeness(spark):
    rng = random.Random(8)
    for share in (0.5, 0.8, 0.95):
        both = [rng.getrandbits(64) for _ in range(int(2000 * share))]
        own = [[rng.getrandbits(64) for _ in range(2000 - len(both))] for _ in range(2)]
        sets = [np.unique(np.array(both + x, np.uint64)) for x in own]
        true = len(both) / (4000 - len(both))
        a, b = minhash.prints(sets, 5)
        sig = np.array([a["sig"], b["sig"]]).astype(np.int64).astype(np.uint64)
        about = minhash.estimates(sig[:1], sig[1:])[0, 0]
        assert about == pytest.approx(true, abs=0.2)
        row = spark.createDataFrame([(a["sig"], b["sig"])], "a array<bigint>, b array<bigint>")
        assert row.select(minhash.likeness("a", "b")).first()[0] == pytest.approx(about)
    assert minhash.intersections([sets[0]], [sets[1], sets[0]]).tolist() == [[len(both), 2000]]


def test_bands_miss_less_than_one_pair_in_a_million():
    assert [minhash.band_rows(x) for x in (0.5, 0.8, 0.85, 0.95)] == [2, 4, 5, 9]
    for least in (0.3, 0.6, 0.8, 0.85, 0.9, 0.99):
        rows = minhash.band_rows(least)
        assert rows == 1 or (1 - least**rows) ** (minhash.HASHES // rows) <= 1e-6


def test_near_documents_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0


def brute_vectors(rows, threshold):
    def usable(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float) ) if usable(i, v) else None for i, v in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
    ]
    part, n = groups(range(len(rows)), links), [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    least = {}
    for i, (key, _) in enumerate(rows):
        least[part[i]] = min((d for d in (least.get(part[i]), key) if d is not None), default=None)
    return sorted(((rows[i][0], n[i], least[part[i]]) for i in range(len(rows))), key=str)


@pytest.mark.parametrize(("pivots", "block"), [(1, 8192), (7, 8192), (5, 20)])
def test_vectors_against_brute_force(spark, monkeypatch, pivots, block):
    monkeypatch.setattr(embedding_dedup, "pivot_count", lambda n, dim: pivots)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [(i * 2, (centres[i % 12] * (1 + i % 3) + rng.normal(size=8) * 0.3).tolist()) for i in range(150)]
    rows += [(1001, rows[0][1]), (1003, [2 * x for x in rows[0][1]]), (rows[3][0], rows[4][1])]
    rows += [(2001, None), (2003, []), (2005, [0.0] * 8), (2007, [1.0, float("nan")] * 4), (2009, [1.0, None] * 4), (None, rows[0][1])]
    rows += [(2011, [1.0, 2.0]), (2013, [2.0, 4.0]), (2015, [1e200] * 8), (2017, [1e-200] * 8), (2019, [float("inf")] * 8), (2021, [-0.0, 1.0]), (2023, [0.0, 1.0])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, node int, data int").repartition(4)
    got = embedding_dedup.near_duplicates(table).collect()
    scaled = [(k, [x / 1e200 for x in v] if v and v[0] == 1e200 else [x * 1e200 for x in v] if v and v[0] == 1e-200 else v) for k, v in rows]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute_vectors(scaled, 0.9)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_single_precision_vectors_give_the_same_result(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(7)
    centres = rng.normal(size=(9, 8))
    rows = [(i, np.float32(centres[i % 9] + rng.normal(size=8) * 0.2).tolist()) for i in range(120)] + [(500, [-0.0, 1.0]), (501, [0.0, 1.0])]
    double = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    single = double.withColumn("embedding", F.col("embedding").cast("array<float>"))
    _, nodes = embedding_dedup.classes(single, "vec_id", "embedding")
    assert nodes.select(F.max(F.length("data")), F.max("dim")).first() == (32, 8)
    got = [sorted(map(tuple, embedding_dedup.near_duplicates(df).collect())) for df in (single, double)]
    assert got[0] == got[1] and sorted((r[:3] for r in got[0]), key=str) == brute_vectors(rows, 0.9)


def test_pivots_are_bounded_by_bytes():
    assert embedding_dedup.pivot_count(10**6, 64) == 62 and embedding_dedup.pivot_count(3, 64) == 1
    assert embedding_dedup.pivot_count(10**14, 768) * 768 * 8 <= embedding_dedup.PIVOT_BYTES


def test_vectors_of_one_name_are_told_apart_by_the_other(spark):
    from pyspark.sql import functions as F

    from riskloom.llm.common import told_apart

    rows = spark.createDataFrame([(1, 5, 7), (2, 5, 7), (3, 5, 8), (4, 6, 9)], "id long, node long, other long")
    assert {(r.id, r.node) for r in told_apart(rows).collect()} == {(1, 7), (2, 7), (3, 8), (4, 6)}
    assert told_apart(rows.where(F.col("id") != 3)).select("node").distinct().count() == 2


def test_cells_miss_no_near_vector():
    rng = np.random.default_rng(0)
    pivots = rng.normal(size=(20, 6))
    pivots /= np.linalg.norm(pivots, axis=1)[:, None]
    x = rng.normal(size=(3000, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    own, sent = embedding_dedup.cells_of(x, pivots, 0.9)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert ((own[a] == own[b]) | sent[b, own[a]]).all()
    assert sent.mean() < 0.6  # the triangle inequality spares cells where there are few dimensions


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize(("given", "after"), [("64m", "8388608"), ("4m", "4m"), ("67108864b", "8388608")])
def test_batches_are_only_lowered(spark, given, after):
    from riskloom.llm.common import small_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, given)
    small_batches(spark)
    assert spark.conf.get(key) == after
    spark.conf.unset(key)


def test_counted_join_gives_hot_and_other_keys(spark):
    from pyspark.sql import functions as F

    from riskloom.llm.common import join_counted

    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    counted = rows.groupBy("k").agg(F.count("*").alias("count"), F.min("id").alias("low")).where("k % 2 != 0")
    got = join_counted(rows, counted, "k", 6000)
    assert sorted(got.select("id", "k", "low").collect()) == sorted(rows.join(counted, "k").select("id", "k", "low").collect())
