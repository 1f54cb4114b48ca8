"""MinHash near-duplicate detection through a multi-index Hamming join.

* Every document becomes its set of word shingles (64-bit fingerprints) and a
  signature of b-bit MinHash values.  Documents with equal sets collapse to
  one node, the smallest doc_id.
* Multi-index: the signature is split into ``chunks`` chunks of ``width``
  values.  By the pigeonhole principle, signatures that differ in at most
  2 * chunks - 1 values agree in some chunk up to one value; for each chunk
  every allowed error (one value left out) is enumerated as a key.  Pairs
  under that distance therefore share a key, whatever the data; the number of
  chunks follows from the similarity so that a pair right at it is missed with
  probability 1e-5 at most.
* Star edges: in each key's bucket, members are tied to the smallest one, so a
  bucket of any size gives one edge per member.  The components of these
  edges are the candidate clusters: all members that could be linked at all.
* Confirmation: in each cluster all pairs are compared on their full sets by
  counting shared shingles (products of 0/1 matrices).  Clusters above a block
  are split into pairs of blocks over many tasks; only a spanning forest of
  the confirmed links leaves a task.
* The components of the confirmed links are the result.

Defined results: lower-casing touches A-Z only, words are separated by ASCII
white space.  Texts without words (NULL, empty) have an empty set and no links.
Rows with NULL doc_id are linked with nothing and stay.  Rows that share a
doc_id are one document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_bounded, small_enough, staged
from tessera.llm.components import connected

#: Members of a block in the confirmation; more for very large clusters.
BLOCK = 128
# Shingle sets that a task builds at a time.
SETS_AT_ONCE = 256
#: Up to this many rows (ids of clustered or dropped documents) are broadcast.
MAX_BROADCAST_IDS = 500_000
MISS = 1e-5

# Odd 64-bit multipliers of the mixing functions.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            for name, base in (("up", BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


def word_hashes(data: bytes, powers: Powers) -> np.ndarray:
    """64-bit fingerprints of the words, from prefix sums over the bytes."""
    a = np.frombuffer(data.lower(), np.uint8)
    if not len(a):
        return np.zeros(0, np.uint64)
    gap = np.ones(len(a) + 2, np.int8)
    gap[1:-1] = _IS_SPACE[a]
    edges = np.flatnonzero(np.diff(gap))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers.get(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX2)


def shingle_set(data: bytes, k: int, powers: Powers) -> np.ndarray:
    """Sorted distinct fingerprints of the k-word shingles; with fewer words,
    the whole sequence is one; without words, nothing."""
    h = word_hashes(data, powers)
    n = len(h)
    if not n:
        return h
    span = min(k, n)
    s = np.full(n - span + 1, span, np.uint64)
    for j in range(span):
        s = mixed(s * BASE + h[j : n - span + 1 + j])
    return np.unique(s)


class Scheme:
    """Signature length, chunks and keys for one similarity threshold."""

    def __init__(self, percent: int):
        sim = percent / 100
        self.percent = percent
        self.width = 8 if percent >= 85 else 7 if percent >= 75 else 5
        found = sim**self.width + self.width * (1 - sim) * sim ** (self.width - 1)
        self.chunks = math.ceil(math.log(MISS) / math.log(1 - found))
        self.values = self.width * self.chunks
        rng = np.random.default_rng(20240)
        odd = rng.integers(0, 1 << 32, (2, self.values), dtype=np.uint64).astype(np.uint32)
        self.a, self.b = odd[0] | np.uint32(1), odd[1]
        self.r = rng.integers(0, 1 << 63, (self.chunks, self.width), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.tag = rng.integers(0, 1 << 63, (self.chunks, self.width), dtype=np.uint64)

    @property
    def distance(self) -> int:
        """Pairs of signatures up to this distance share a key for certain."""
        return 2 * self.chunks - 1

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(self.values, 0xFFFFFFFF, np.uint32)
        for lo in range(0, len(x), 8192):
            part = x[lo : lo + 8192]
            np.minimum(low, (part[None, :] * self.a[:, None] + self.b[:, None]).min(axis=1), out=low)
        return ((low * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """(n, chunks * width): per chunk, one key for each value left out."""
        v = signatures.astype(np.uint64).reshape(len(signatures), self.chunks, self.width) * self.r
        return mixed(v.sum(axis=2, dtype=np.uint64)[:, :, None] - v + self.tag).reshape(len(signatures), self.values)


def signatures(docs: DataFrame, k: int, scheme: Scheme, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, digest, sig) per row, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for b in batches:
            sizes, digests, sigs = [], [], []
            for t in b["text"]:
                s = shingle_set((t.as_py() or "").encode("utf-8", "replace"), k, powers)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(scheme.signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sig"],
            )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return staged(rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary"), "signatures")


def index_keys(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, node) rows of the multi-index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint16).reshape(b.num_rows, scheme.values)
            node = b["node"].to_numpy()
            for lo in range(0, len(node), 1000):
                keys = scheme.keys(sig[lo : lo + 1000]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(node[lo : lo + 1000], scheme.values))], ["key", "node"]
                )

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def candidate_clusters(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """(node, root): nodes tied through shared keys."""
    keyed = index_keys(nodes, scheme)
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    ties = keyed.join(hubs.select("key", "hub"), "key").filter("node <> hub").select("hub", "node").distinct()
    return connected(ties, "hub", "node")


def shared_counts(sets: list[np.ndarray], left: int | None = None) -> np.ndarray:
    """Matrix of intersection sizes; with ``left``, only of the first ``left``
    sets against the others."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    cut = n if left is None else left
    out = np.zeros((cut, n if left is None else n - left), np.float32)
    if not len(column):
        return out
    column = np.cumsum(np.concatenate([[0], np.diff(column) > 0]))
    width = 2048
    grid = np.zeros((n, width), np.float32)
    for lo in range(0, int(column[-1]) + 1, width):
        at = slice(*np.searchsorted(column, [lo, lo + width]))
        grid[:] = 0
        grid[owner[at], column[at] - lo] = 1
        out += grid[:cut] @ (grid if left is None else grid[left:]).T
    return out


def forest(ids: np.ndarray, sets: list[np.ndarray], blocks: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the confirmed links.  ``blocks``: False for the first
    and True for the second block of a pair; None when all pairs count."""
    n = len(ids)
    size = np.array([len(s) for s in sets], np.int64)
    if blocks is None:
        inter = shared_counts(sets).astype(np.int64)
        link = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    else:
        order = np.argsort(blocks, kind="stable")
        ids, size, sets = ids[order], size[order], [sets[i] for i in order]
        left = int((~blocks).sum())
        if left in (0, n):
            return []
        inter = shared_counts(sets, left).astype(np.int64)
        link = np.zeros((n, n), bool)
        link[:left, left:] = 100 * inter >= percent * (size[:left, None] + size[None, left:] - inter)
        link |= link.T
    np.fill_diagonal(link, False)
    found, done = [], np.zeros(n, bool)
    for i in range(n):
        if done[i]:
            continue
        done[i], queue = True, [i]
        while queue:
            j = queue.pop()
            for m in np.flatnonzero(link[j] & ~done):
                done[m] = True
                found.append((int(ids[j]), int(ids[m])))
                queue.append(m)
    return found


def confirmed_links(docs: DataFrame, clusters: DataFrame, k: int, percent: int, doc_id: str, text: str) -> DataFrame:
    """(a, b): a spanning forest of the links inside every cluster."""
    sizes = clusters.groupBy("root").agg(F.count("*").alias("members"))
    block = F.least(F.lit(1024), F.greatest(F.lit(BLOCK), F.ceil(F.col("members") / 128)))
    members = staged(
        clusters.join(sizes, "root").withColumn("blocks", F.ceil(F.col("members") / block).cast("int")), "clusters"
    )
    texts = docs.select(docs[doc_id].cast("long").alias("node"), docs[text].alias("text"))
    texts = join_bounded(texts, members.select("node", "root", "blocks"), "node", "inner", MAX_BROADCAST_IDS)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for whole in batches:
            for at in range(0, len(whole), SETS_AT_ONCE):
                b = whole.slice(at, SETS_AT_ONCE)
                got = [shingle_set((t.as_py() or "").encode("utf-8", "replace"), k, powers).tobytes() for t in b["text"]]
                yield pa.RecordBatch.from_arrays(
                    [b["node"], b["root"], b["blocks"], pa.array(got, pa.binary())], ["node", "root", "blocks", "shingles"]
                )

    sets = texts.select("node", "root", "blocks", "text").mapInArrow(
        load, "node long, root long, blocks int, shingles binary"
    )
    # each member meets every block of its cluster once: rows (root, low, high)
    sets = sets.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    sets = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    dealt = sets.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key, ids, own, sets):
            blocks = None if key[1] == key[2] else np.array(own) == key[2]
            return forest(np.array(ids), sets, blocks, percent)

        group, ids, own, got = None, [], [], []
        for b in batches:
            found: list[tuple[int, int]] = []
            cols = [b[c].to_pylist() for c in ("root", "low", "high", "node", "own")]
            for r, lo, hi, node, mine, data in zip(*cols, b["shingles"]):
                if (r, lo, hi) != group:
                    if len(ids) > 1:
                        found += links(group, ids, own, got)
                    group, ids, own, got = (r, lo, hi), [], [], []
                s = np.frombuffer(data.as_py(), np.uint64)
                if len(s):
                    ids.append(node)
                    own.append(mine)
                    got.append(s)
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["a", "b"])
        if len(ids) > 1:
            found = links(group, ids, own, got)
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return dealt.select("root", "low", "high", "node", "own", "shingles").mapInArrow(solve, "a long, b long")


def mark(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    scheme = Scheme(percent)
    rows = signatures(docs, k, scheme, doc_id, text)
    known = rows.filter("digest is not null and doc_id is not null")
    nodes = staged(known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig")), "nodes")
    clusters = staged(candidate_clusters(nodes, scheme), "candidates")
    links = confirmed_links(docs, clusters, k, percent, doc_id, text)
    # a document whose id stands for several texts ties them together
    roots = connected(links, "a", "b")
    found = nodes.select("digest", "node").join(roots, "node", "left")
    found = found.select("digest", F.coalesce("root", "node").alias("found"))
    joined = rows.drop("sig").join(found, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def remove_near_copies(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, of the document that stays in each
    group."""
    dropped = staged(mark(docs, k, percent, doc_id, text).filter("not kept").select(F.col("doc_id").alias("_gone")), "dropped")
    gone = F.broadcast(dropped) if small_enough(dropped, MAX_BROADCAST_IDS) else dropped
    return docs.join(gone, docs[doc_id].cast("long") == gone["_gone"], "left_anti")
