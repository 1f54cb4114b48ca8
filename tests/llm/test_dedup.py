"""Exact and near deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, near_dedup
from tessera.llm.components import connected

SPACE = str.maketrans("", "", " \t\n\x0b\f\r")


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(SPACE), []).append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r[0], best[0], len(members), r[0] == best[0], sha) for r in members]
    return sorted(out, key=str)


def marks(df):
    return sorted([tuple(r)[:5] for r in df.collect()], key=str)


def test_exact_marks_equal_brute_force(docs, rows):
    assert marks(exact_dedup.mark(docs)) == brute_exact(rows)


def test_exact_empty_table(no_docs):
    assert exact_dedup.mark(no_docs).collect() == []
    assert exact_dedup.deduplicate(no_docs).collect() == []


def test_deduplicate_keeps_one_whole_row_per_group(docs, rows):
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    got = out.collect()
    norms = [(r["text"] or "").translate(SPACE) for r in got]
    assert len(norms) == len(set(norms)) == len({(r[1] or "").translate(SPACE) for r in rows})
    keep = {k[4]: k[1] for k in brute_exact(rows)}
    for r, n in zip(got, norms):
        assert keep[hashlib.sha256(n.encode()).hexdigest()] == r["doc_id"]


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"), F.lit(10).cast("long").alias("bytes"))
    d = exact_dedup.build_directory(spark, keys, bucket_keys=100)
    slots = d.buckets.collect()
    assert d.depth >= 5 and sorted(r["slot"] for r in slots) == list(range(2**d.depth))
    counts = exact_dedup.bucketed(keys, d).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in counts) == 3000 and max(r["count"] for r in counts) <= 100
    # a bucket of local depth l is shared by 2^(depth - l) slots
    for r in slots:
        assert r["bucket"] == (r["slot"] >> (d.depth - r["local_depth"])) << (d.depth - r["local_depth"])


def test_overfull_single_key_stays_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_DEPTH", 4)
    keys = spark.createDataFrame([(7, 10**9)], "key long, bytes long")
    assert exact_dedup.build_directory(spark, keys).depth == 4


def test_small_buckets_give_the_same_marks(docs, rows, monkeypatch):
    build = exact_dedup.build_directory
    monkeypatch.setattr(exact_dedup, "build_directory", lambda s, k: build(s, k, bucket_keys=2))
    assert marks(exact_dedup.mark(docs)) == brute_exact(rows)


# -- near duplicates ----------------------------------------------------------


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_near(rows, k, percent):
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    ids = sorted({i for i, _ in sets if i is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for n, (i, s) in enumerate(known):
        for j, t in known[:n]:
            inter = len(s & t)
            if 100 * inter >= percent * (len(s) + len(t) - inter):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, s in sets:
        c = None if i is None else find(i)
        out.append((i, len(s), c, i == c))
    return sorted(out, key=str)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80), (2, 60)])
def test_near_marks_equal_brute_force(docs, rows, k, percent):
    got = sorted([tuple(r) for r in near_dedup.mark(docs, k, percent).collect()], key=str)
    assert got == brute_near(rows, k, percent)


def family(n, size, edits, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(size)]
    out = []
    for i in range(n):
        t = list(base)
        for _ in range(rng.randrange(edits)):
            t[rng.randrange(size)] = rng.choice(words)
        out.append((i, " ".join(t), "en", "a", 0))
    return out


def test_large_family_is_solved_in_blocks(make, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = family(150, 120, 9, 5)
    got = sorted([tuple(r) for r in near_dedup.mark(make(rows), 3, 85).collect()], key=str)
    assert got == brute_near(rows, 3, 85)


def test_shuffled_id_joins_give_the_same(make, monkeypatch):
    monkeypatch.setattr(near_dedup, "MAX_BROADCAST_IDS", 0)
    rows = family(40, 80, 6, 6)
    df = make(rows)
    assert sorted([tuple(r) for r in near_dedup.mark(df, 3, 85).collect()], key=str) == brute_near(rows, 3, 85)
    kept = sorted(r["doc_id"] for r in near_dedup.remove_near_copies(df, 3, 85).collect())
    assert kept == sorted(r[0] for r in brute_near(rows, 3, 85) if r[3])


def test_near_empty_table(no_docs):
    assert near_dedup.mark(no_docs).collect() == []
    assert near_dedup.remove_near_copies(no_docs).collect() == []


def test_near_removal_keeps_rows_unchanged(docs, rows):
    out = near_dedup.remove_near_copies(docs, 3, 85)
    assert out.columns == docs.columns
    want = sorted([str(m[0]) for m in brute_near(rows, 3, 85) if m[3]])
    assert sorted(str(r["doc_id"]) for r in out.collect()) == want


def test_pigeonhole_guarantee_for_signatures():
    scheme = near_dedup.Scheme(80)
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, scheme.values).astype(np.uint16)
        b = a.copy()
        at = rng.permutation(scheme.values)[: scheme.distance]
        b[at] ^= rng.integers(1, 1 << 16, len(at)).astype(np.uint16)
        ka, kb = scheme.keys(np.stack([a, b]))
        assert (ka == kb).any()


def test_word_hashes_do_not_depend_on_place():
    p = near_dedup.Powers()
    h = near_dedup.word_hashes(b"  foo bar\x0bfoo\n FOO ", p)
    assert h[0] == h[2] == h[3] != h[1] and len(h) == 4
    assert len(near_dedup.word_hashes(b" \t", p)) == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(300, 200)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(path, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140)) and got[300] == got[200] == 200
