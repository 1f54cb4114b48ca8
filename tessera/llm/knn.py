"""Exact top-k search by inner product: a Voronoi kNN join.

* Pivots are a bounded sample of the queries; every query belongs to the cell
  of its nearest pivot, and large cells are split into groups.
* Summaries: a group's radius, and its threshold.  For pivot p and radius r,
  any query q of the group has q.s >= p.s - r|s|, so the (k+1)-th largest of
  these lower bounds over the data is a score that every query of the group
  reaches k times without its own row.
* Replication: a vector goes to a group only if its upper bound p.s + r|s|
  reaches the threshold.
* Local solution: the vectors of a group are dealt over splits by a hash of
  each row; in each (group, split) the remaining scores are computed as matrix
  products over blocks of rows, and the best k per query and split are merged.

Components are integers floor(scale * x).  Products that stay below 2^53 are
computed in doubles and exact; larger ones in 64-bit integers.

Defined results: rows with NULL id, NULL vectors, NULL or non-finite components
take no part.  Vectors are compared with vectors of the same length.
Candidates are all rows with another id, repeated ones each for itself; a
query row that repeats exactly is one query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

#: Bound of the pivot sample (it is held by the driver and by every task).
MAX_PIVOTS = 512
GROUP_QUERIES = 1024
CHUNK = 512
SPLIT_ROWS = 50_000
MIN_SPLITS = 8
#: Rows of one matrix product of a split, and bytes of vectors handed on at once.
BLOCK_ROWS = 2048
HANDED_BYTES = 16 << 20


def integers(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, dim, v): usable rows as little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dims, got = [], [], []
            lists, rows = b["vec"], b["id"].to_pylist()
            for i, row in enumerate(rows):
                if row is None or not lists[i].is_valid:
                    continue
                values = lists.value_slice(i) if hasattr(lists, "value_slice") else lists[i].values
                if values.null_count:
                    continue
                x = np.asarray(values.to_numpy(zero_copy_only=False), np.float64)
                if not np.isfinite(x).all():
                    continue
                v = np.clip(np.floor(scale * x), -(2.0**62), 2.0**62).astype(np.int64)
                ids.append(row)
                dims.append(len(v))
                got.append(v.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(got, pa.binary())], ["id", "dim", "v"]
            )

    rows = vectors.select(vectors[vec_id].cast("long").alias("id"), vectors[vector].alias("vec"))
    return staged(rows.mapInArrow(run, "id long, dim int, v binary"), "vectors")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), dim)


def products(q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Exact integer inner products, (queries, rows)."""
    if not q.size or not s.size:
        return np.zeros((len(q), len(s)), np.int64)
    top = float(np.abs(q).max()) * float(np.abs(s).max()) * q.shape[1]
    if top < 2.0**53:
        return (q.astype(np.float64) @ s.astype(np.float64).T).astype(np.int64)
    return q @ s.T


def _bounds(s: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of scores, (rows, groups), with a margin for
    rounding."""
    x = s.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    mid = x @ pivots.T
    slack = norm[:, None] * radius[None, :]
    margin = 1e-9 * (np.abs(mid) + slack) + 1e-6
    return mid - slack - margin, mid + slack + margin


def _cells(queries: DataFrame, dim: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Queries with their group, and the groups' centres and radii."""
    n = queries.count()
    sample = queries.orderBy(F.xxhash64("id", "v")).limit(max(1, min(MAX_PIVOTS, math.isqrt(n)))).collect()
    pivots = np.array([np.frombuffer(r["v"], np.int64) for r in sample], np.float64).reshape(len(sample), dim)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b["v"], dim).astype(np.float64)
            d = (x * x).sum(axis=1)[:, None] - 2 * (x @ pivots.T) + (pivots * pivots).sum(axis=1)[None, :]
            cell = d.argmin(axis=1)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [b["id"], b["v"], pa.array(cell, pa.int64()), pa.array(away)], ["id", "v", "cell", "away"]
            )

    placed = staged(queries.select("id", "v").mapInArrow(nearest, "id long, v binary, cell long, away double"), "cells")
    # one row per cell, at most MAX_PIVOTS
    size = placed.groupBy("cell").agg(F.ceil(F.count("*") / GROUP_QUERIES).alias("parts"))
    placed = placed.join(F.broadcast(size), "cell").withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("parts")))
    groups = placed.groupBy("cell", "block").agg(F.max("away").alias("radius")).orderBy("cell", "block").collect()
    number = {(r["cell"], r["block"]): i for i, r in enumerate(groups)}
    table = queries.sparkSession.createDataFrame([(c, b, i) for (c, b), i in number.items()], "cell long, block long, g int")
    placed = placed.join(F.broadcast(table), ["cell", "block"]).select("id", "v", "g")
    centre = pivots[[r["cell"] for r in groups]].reshape(len(groups), dim)
    return placed, centre, np.array([r["radius"] for r in groups])


def _thresholds(data: DataFrame, dim: int, centre: np.ndarray, radius: np.ndarray, k: int) -> np.ndarray:
    """Per group, a score that each of its queries reaches k times: the
    (k+1)-th largest lower bound over distinct ids, -inf if there are fewer."""
    groups = len(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, owner = np.zeros((0, groups)), np.zeros((0, groups), np.int64)
        for b in batches:
            s, ids = matrix(b["v"], dim), b["id"].to_numpy()
            for lo in range(0, len(s), 4096):
                part = s[lo : lo + 4096]
                if not len(part):
                    continue
                low = np.vstack([best, _bounds(part, centre, radius)[0]])
                own = np.vstack([owner, np.repeat(ids[lo : lo + 4096, None], groups, axis=1)])
                # a repeated id counts once: its later rows fall to -inf
                at = np.argsort(-low, axis=0, kind="stable")[: 8 * (k + 1)]
                best, owner = np.take_along_axis(low, at, 0), np.take_along_axis(own, at, 0)
                if len(ids) and len(np.unique(ids)) < len(ids) or len(best) > k + 1:
                    for g in range(groups):
                        _, first = np.unique(owner[:, g], return_index=True)
                        again = np.ones(len(owner), bool)
                        again[first] = False
                        best[again, g] = -np.inf
                    at = np.argsort(-best, axis=0, kind="stable")[: k + 1]
                    best, owner = np.take_along_axis(best, at, 0), np.take_along_axis(owner, at, 0)
        g = np.broadcast_to(np.arange(groups), best.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(g.ravel(), pa.int32()), pa.array(best.ravel()), pa.array(owner.ravel())], ["g", "low", "id"]
        )

    tops = data.select("id", "v").mapInArrow(run, "g int, low double, id long")
    tops = tops.groupBy("g", "id").agg(F.max("low").alias("low"))
    order = Window.partitionBy("g").orderBy(F.desc("low"))
    last = tops.withColumn("n", F.row_number().over(order)).filter(F.col("n") == k + 1).collect()
    out = np.full(groups, -np.inf)
    for r in last:
        out[r["g"]] = r["low"]
    return out


def _replicated(data: DataFrame, dim: int, centre: np.ndarray, radius: np.ndarray, floor: np.ndarray, splits: int) -> DataFrame:
    """Chunks of the vectors that each group needs: (g, split, ids, v), one per
    batch, group and split."""

    def handed(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.binary()),
                pa.array([r[3] for r in rows], pa.binary()),
            ],
            ["g", "split", "ids", "v"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            # rows in the order of their splits, so that a split is a stretch
            split = b["split"].to_numpy()
            order = np.argsort(split, kind="stable")
            split, ids, s = split[order], b["id"].to_numpy()[order], matrix(b["v"], dim)[order]
            need = np.vstack(
                [_bounds(s[lo : lo + CHUNK], centre, radius)[1] >= floor[None, :] for lo in range(0, len(s), CHUNK)]
            )
            rows, size = [], 0
            for g in np.flatnonzero(need.any(axis=0)):
                at = np.flatnonzero(need[:, g])
                for part in np.split(at, np.flatnonzero(np.diff(split[at])) + 1):
                    rows.append((int(g), int(split[part[0]]), ids[part].tobytes(), s[part].tobytes()))
                    size += len(rows[-1][3])
                if size >= HANDED_BYTES:
                    yield handed(rows)
                    rows, size = [], 0
            yield handed(rows)

    # neither file order nor the pattern of the ids decides on the split
    dealt = F.pmod(F.xxhash64("id", "v"), F.lit(splits)).cast("int").alias("split")
    return data.select("id", "v", dealt).mapInArrow(run, "g int, split int, ids binary, v binary")


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int):
    """Best k rows of each query (own id left out): rows, columns, scores."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q)
    for lo in range(0, len(s), BLOCK_ROWS):
        own, score = ids[lo : lo + BLOCK_ROWS], products(q, s[lo : lo + BLOCK_ROWS])
        for i in range(len(q)):
            row, (held, top) = score[i], best[i]
            ok = own != q_ids[i]
            if len(top) == k:
                ok &= row >= top[-1]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            if len(at) > k:
                cut = np.partition(row[at], len(at) - k)[len(at) - k]
                at = at[row[at] >= cut]
            held, top = np.concatenate([held, own[at]]), np.concatenate([top, row[at]])
            order = np.lexsort((held, -top))[:k]
            best[i] = held[order], top[order]
    return [(i, int(j), int(x)) for i, (held, top) in enumerate(best) for j, x in zip(held, top)]


def _solver(dim: int, k: int):
    """Local top-k of one (group, split)."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids = np.array(left["id"].to_pylist(), np.int64)
        q = matrix(left["v"], dim)
        found: list[tuple[int, int, int]] = []
        if len(q_ids) and right.num_rows:
            ids = np.frombuffer(b"".join(right["ids"].to_pylist()), np.int64)
            s = np.frombuffer(b"".join(right["v"].to_pylist()), np.int64).reshape(len(ids), dim)
            found = _best(q_ids, q, ids, s, k)
        return pa.table(
            {
                "query_id": pa.array([q_ids[i] for i, _, _ in found], pa.int64()),
                "qv": pa.array([q[i].tobytes() for i, _, _ in found], pa.binary()),
                "vec_id": pa.array([j for _, j, _ in found], pa.int64()),
                "score": pa.array([x for _, _, x in found], pa.int64()),
            }
        )

    return solve


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` holds
    (an expression over the column ``id``)."""
    spark = vectors.sparkSession
    usable = integers(vectors, vec_id, vector, scale)
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # one pass per vector length; a table of embeddings has one
    for dim, count in sorted(map(tuple, usable.groupBy("dim").count().collect())):
        data = usable.filter(F.col("dim") == dim)
        queries = data.filter(is_query).select("id", "v").distinct()
        if queries.isEmpty():
            continue
        placed, centre, radius = _cells(queries, dim)
        floor = _thresholds(data, dim, centre, radius, k)
        splits = max(MIN_SPLITS, -(-count // SPLIT_ROWS))
        chunks = _replicated(data, dim, centre, radius, floor, splits)
        wanted = placed.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
        wanted = wanted.select("g", "split", "id", "v")

        local = (
            wanted.groupBy("g", "split")
            .cogroup(chunks.groupBy("g", "split"))
            .applyInArrow(_solver(dim, k), "query_id long, qv binary, vec_id long, score long")
        )
        order = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "vec_id")
        ranked = local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        result = result.unionByName(ranked.select("query_id", "rank", "vec_id", "score"))
    return result
