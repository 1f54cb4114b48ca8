"""Mixing, packing and token counts against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import mixing, packing, token_counts
from tessera.llm.common import scratch_path
from tessera.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def water_fill(sizes, weights, volume, epochs):
    target, open_ = {}, {s for s in sizes if sizes[s]}
    while open_:
        level = (volume - sum(target.values())) / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > epochs * sizes[s]}
        if not over:
            target |= {s: weights[s] * level for s in open_}
            break
        target |= {s: float(epochs * sizes[s]) for s in over}
        open_ -= over
    return {s: target.get(s, 0.0) for s in sizes}


def check_mix(rows, got, weights=(5, 2, 1), share=1.5, epochs=2):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = water_fill(sizes, {s: weights[i % len(weights)] for i, s in enumerate(order)}, share * sum(sizes.values()), epochs)
    by_source = {(r[3], len(words(r[1]))) for r in rows}
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        source = next(s for s, n in by_source if sizes[s] == r["source_size"] and abs(target[s] - r["target"]) < 1e-6)
        taken[source] = taken.get(source, 0) + r["taken"]
        assert 0 <= r["taken"] <= epochs * r["size"]
    for s, t in taken.items():
        assert abs(t - target[s]) <= 1


def test_mix_matches_water_filling(docs, rows):
    check_mix(rows, mixing.mark(docs).collect())


def test_mix_reruns_agree_and_follow_the_seed(docs):
    a, b = (sorted(map(tuple, mixing.mark(d).collect()), key=str) for d in (docs, docs.repartition(7)))
    assert a == b
    assert a != sorted(map(tuple, mixing.mark(docs, seed=99).collect()), key=str)


def test_mix_without_broadcast_agrees(docs, monkeypatch):
    want = sorted(map(tuple, mixing.mark(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.mark(docs).collect()), key=str) == want


def test_mix_other_shares(docs, rows):
    check_mix(rows, mixing.mark(docs, share=0.2).collect(), share=0.2)
    check_mix(rows, mixing.mark(docs, share=5.0).collect(), share=5.0)


def test_repeated_rows_are_whole_and_near_the_words_taken(docs, rows):
    taken, got, longest = Counter(), Counter(), Counter()
    for r in mixing.mark(docs.select("doc_id", "text", "source")).join(docs.select("doc_id", "source").distinct(), "doc_id").collect():
        taken[r["source"]] += r["taken"]
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    texts = {r[1] for r in rows}
    for r in out.collect():
        assert r["text"] in texts
        got[r["source"]] += len(words(r["text"]))
    for r in rows:
        longest[r[3]] = max(longest[r[3]], len(words(r[1])))
    assert all(abs(got[s] - taken[s]) <= longest[s] / 2 + 1 for s in longest if s is not None)


def test_mix_empty_tables(no_docs, make):
    assert mixing.mark(no_docs).collect() == []
    assert mixing.repeated(no_docs).collect() == []
    blank = make([(1, None, None, "a", None), (2, " ", None, None, None)])
    assert sorted(tuple(r) for r in mixing.mark(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# -- tokens -------------------------------------------------------------------


def lib_ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids


def test_chunk_ids_equal_the_library(rows, spark):
    encode = encoder(PATH)
    texts = [r[1] or "" for r in rows]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    texts += ["it's I'LL we'd!!'s '' a'b", "ÀÉ ×÷ ﬀ ǅ ΣΑΣ İI \x85x​", "x" * 3000, "\x00\x1f \x7f", "<|startoftext|>a <|endoftext|>b"]
    for t in texts:
        assert encode(t) == np.array(lib_ids(t), "<u4").tobytes()


def test_counts_and_cache(docs, rows, spark):
    cache = scratch_path(spark, "cache")
    want = sorted([(r[0], len((r[1] or "").encode()), len(lib_ids(r[1])), len(lib_ids(r[1])) > 2048) for r in rows], key=str)
    for _ in range(2):  # the second call finds everything stored
        assert sorted([tuple(r) for r in token_counts.count_tokens(docs, PATH, cache).collect()], key=str) == want
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("content").distinct().count()


def test_only_missing_contents_are_encoded(make, spark, monkeypatch):
    cache = scratch_path(spark, "cache")
    token_counts.count_tokens(make([(1, "a b", None, None, None)]), PATH, cache).collect()
    for limit in (token_counts.MAX_BROADCAST_MISSES, 0):
        monkeypatch.setattr(token_counts, "MAX_BROADCAST_MISSES", limit)
        got = token_counts.count_tokens(make([(1, "a  b", None, None, None), (2, f"c {limit}", None, None, None)]), PATH, cache)
        assert sorted(r["n_tokens"] for r in got.collect())[0] == 2
    assert spark.read.parquet(cache).count() == 3


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_tokenizers(make, spark, name):
    texts = ["Hello  world\n x", "naïve", ""]
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(lib.encode(t)) for t in texts]
    else:
        lib = Tokenizer.from_file(path)
        want = [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
    df = make([(i, t, None, None, None) for i, t in enumerate(texts)])
    got = token_counts.count_tokens(df, path, scratch_path(spark, "cache"))
    assert [r["n_tokens"] for r in got.orderBy("doc_id").collect()] == want


def test_counts_empty_table(no_docs, spark):
    assert token_counts.count_tokens(no_docs, PATH, scratch_path(spark, "cache")).collect() == []


# -- packing ------------------------------------------------------------------


def check_packing(rows, pieces, seq_len):
    ids = [lib_ids(r[1]) + [2] for r in rows]
    total = sum(map(len, ids))
    assert sum(p["length"] for p in pieces) == total
    # every document's pieces, as a multiset over documents with equal ids
    want = sorted(
        (str(r[0]), s, len(x[s : s + seq_len]), zlib.crc32(np.array(x[s : s + seq_len], "<u4").tobytes()), len(x))
        for r, x in zip(rows, ids)
        for s in range(0, len(x), seq_len)
    )
    assert sorted((str(p["doc_id"]), p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces) == want
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= seq_len
    return len(sequences), total


def test_packing_places_every_id_once(docs, rows):
    check_packing(rows, packing.pack(docs, PATH).collect(), 4096)


def test_packing_is_tight_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    sequences, total = check_packing(rows, packing.pack(df, PATH).collect(), 4096)
    assert sequences * 4096 <= 1.02 * total


def test_packing_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []


def test_patterns_cover_the_histogram_exactly():
    rng = np.random.default_rng(0)
    hist = {int(u): int(n) for u, n in zip(rng.integers(1, 513, 80), rng.integers(1, 400, 80))}
    plan = packing.plan_sequences(hist)
    used = {}
    for pattern, times in plan:
        assert sum(u * k for u, k in pattern.items()) <= packing.UNITS
        for u, k in pattern.items():
            used[u] = used.get(u, 0) + k * times
    assert used == hist
    bound = sum(u * n for u, n in hist.items()) / packing.UNITS
    assert sum(t for _, t in plan) <= 1.1 * bound + 80
    assert packing.plan_sequences({}) == []


def test_knapsack_prices_the_best_pattern():
    (value, pattern), *others = packing.best_patterns(np.array([0.2, 0.55, 0.3]), np.array([2, 5, 3]), 10)
    assert value == pytest.approx(1.1) and list(pattern) == [0, 2, 0]
    assert [v for v, _ in others] == sorted((v for v, _ in others), reverse=True)
    assert all(v == pytest.approx(p @ [0.2, 0.55, 0.3]) and p @ [2, 5, 3] <= 10 for v, p in others)


def test_functions_are_spark_columns(docs):
    assert docs.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0] > 0
