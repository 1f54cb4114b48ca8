"""Exact top-k search against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import knn

SCHEMA = "vec_id long, embedding array<float>, id string, g int, v string"


def brute(rows, every, k):
    ok = []
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for i, q in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0, "y") for i, v in rows], SCHEMA).repartition(4)


def vectors(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    # quarters of a 1024th are exact in 32 bits
    return [(i, [round((c + rng.gauss(0, spread)) * 4096) / 4096 for c in rng.choice(centres)]) for i in range(n)]


def got(df, every, k=10):
    return sorted(tuple(r) for r in knn.top_k(df, F.col("id") % every == 0, k).collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_brute_force(spark, spread):
    rows = vectors(700, 8, 1, spread)
    assert got(table(spark, rows), 20) == brute(rows, 20, 10)


def test_ties_nulls_and_odd_vectors(spark):
    rows = vectors(60, 4, 2)
    same = [(100 + i, [0.5, 0.5, 0.25, 0.0]) for i in range(80)]
    odd = [
        (200, None), (210, [1.0, None, 1.0, 1.0]), (220, [float("nan")] * 4), (230, [float("inf"), 0.0, 0.0, 0.0]),
        (240, [1.0, 2.0]), (250, [2.0, 1.0]), (260, []), (270, []), (None, [1.0, 1.0, 1.0, 1.0]), (280, [0.0] * 4),
        (241, [3.0, 2.0]), (300, [1.0, 1.0, 1.0, 1.0]), (300, [1.0, 1.0, 1.0, 1.0]), (301, [1.0, 1.0, 1.0, 1.0]),
    ]
    rows = rows + same + odd
    assert got(table(spark, rows), 10) == brute(rows, 10, 10)


def test_fewer_candidates_than_k(spark):
    rows = vectors(6, 3, 3)
    assert got(table(spark, rows), 2) == brute(rows, 2, 10)
    assert got(table(spark, rows[:1]), 2) == []
    assert got(table(spark, rows).limit(0), 2) == []


def test_products_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**14 + i), float(2**14 - 3 * i), 1.0]) for i in range(12)]
    big = [(i, [x * 16 for x in v]) for i, v in rows]  # products near 2^57
    assert got(table(spark, big), 3, 4) == brute(big, 3, 4)


def test_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(knn, "GROUP_QUERIES", 3)
    monkeypatch.setattr(knn, "CHUNK", 16)
    monkeypatch.setattr(knn, "SPLIT_ROWS", 40)
    rows = vectors(300, 5, 4, 0.1)
    assert got(table(spark, rows), 5) == brute(rows, 5, 10)


def test_ids_in_file_order_reach_every_split(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(8192)]
    data = knn.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1), "vec_id", "embedding", 1024)
    chunks = knn._replicated(data, 2, np.zeros((1, 2)), np.ones(1), np.array([-np.inf]), 8).collect()
    held = Counter()
    for c in chunks:
        held[c["split"]] += len(c["ids"]) // 8
    assert sum(held.values()) == 8192 and len(held) == 8 and max(held.values()) < 1.2 * 1024
    assert sorted(np.frombuffer(b"".join(c["ids"] for c in chunks), np.int64)) == list(range(8192))


def test_products_are_taken_in_blocks(spark, monkeypatch):
    sizes, products = [], knn.products
    monkeypatch.setattr(knn, "products", lambda q, s: sizes.append(len(s)) or products(q, s))
    rng = np.random.default_rng(7)
    s = rng.integers(-3, 4, (5000, 4))
    ids = rng.permutation(5000)
    got = knn._best(ids[:20], s[:20], ids, s, 10)
    score = s[:20] @ s.T
    for i in range(20):
        want = sorted((-int(score[i, j]), int(ids[j])) for j in range(5000) if ids[j] != ids[i])[:10]
        assert [(-x, j) for n, j, x in got if n == i] == want
    assert max(sizes) <= 2048 and sum(sizes) == 5000


def test_thresholds_are_reached(spark):
    rows = vectors(400, 6, 5, 0.1)
    data = knn.integers(table(spark, rows), "vec_id", "embedding", 1024)
    queries = data.filter("id % 10 = 0").select("id", "v").distinct()
    _, centre, radius = knn._cells(queries, 6)
    floor = knn._thresholds(data, 6, centre, radius, 10)
    tenth = {q: s for q, n, _, s in brute(rows, 10, 10) if n == 10}
    assert max(floor) <= max(tenth.values()) and all(math.isfinite(x) for x in floor)
