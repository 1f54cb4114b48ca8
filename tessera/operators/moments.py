"""Distributed TSQR: the R factor of [design | y], per group, in one job.

Each partition folds its Arrow batches into one small upper-triangular R per
group (``mapInArrow``; the batch's buffer is the matrix, and several batches
are stacked before each QR); the partial factors are then merged by
``applyInPandas`` (QR of stacked R's): for large inputs over a fixed tree keyed by
the partition number, then to one factor per group.  RᵀR = [X y]ᵀ[X y], so everything a
least-squares, ridge or squared-loss gradient-descent fit needs follows from
R, and ``lstsq(R[:, S], R[:, y])`` is the least-squares fit on any subset S
of the design columns.  Rows never leave the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import FAN_IN, array_of, by_group, matrix, tree_merged
from tessera.session import is_small, split_estimate, spread, wide_projection

MAX_COLUMNS = 2000
#: Designs with more columns are computed by a wide projection.
WIDE_COLUMNS = 32
# Factors of groups (folds, split sides, segments) held by a task; beyond these
# bytes they are handed on and the task starts afresh.
HELD_BYTES = 256 << 20
# Rows of a group are stacked up to this many times the design's width, or these
# bytes in all groups, before they are folded into the group's factor: stacks
# that stay in a core's cache take about half the time of larger ones.
STACK_WIDTHS = 8
STACK_BYTES = 64 << 20

_SCHEMA = "_g string, _part long, _n long, _r array<double>"


def _qr_r(m: np.ndarray, k: int) -> np.ndarray:
    r = np.linalg.qr(m, mode="r")
    if r.shape[0] < k:  # fewer rows than columns so far
        r = np.vstack([r, np.zeros((k - r.shape[0], k))])
    return r


class _Factors:
    """Factor and waiting rows of each group of a task."""

    def __init__(self, k: int):
        self.k = k
        self.factor: dict = {}
        self.count: dict = {}
        self.waiting: dict = {}
        self.waiting_rows = 0

    def add(self, g, rows: np.ndarray) -> None:
        complete = ~np.isnan(rows).any(axis=1)
        if not complete.all():
            rows = rows[complete]
        stack = STACK_WIDTHS * self.k
        for at in range(0, len(rows), stack):
            piece = rows[at : at + stack]
            self.count[g] = self.count.get(g, 0) + len(piece)
            self.waiting.setdefault(g, []).append(piece)
            self.waiting_rows += len(piece)
            if sum(map(len, self.waiting[g])) >= stack:
                self.fold(g)
        if 8 * self.k * self.waiting_rows >= STACK_BYTES:
            for each in list(self.waiting):
                self.fold(each)

    def fold(self, g) -> None:
        rows = self.waiting.pop(g)
        self.waiting_rows -= sum(map(len, rows))
        above = [self.factor[g]] if g in self.factor else []
        self.factor[g] = _qr_r(np.vstack([*above, *rows]), self.k)

    def handed_on(self, part: int) -> pa.RecordBatch:
        for each in list(self.waiting):
            self.fold(each)
        groups = list(self.factor)
        out = [
            pa.array([None if g is None else str(g) for g in groups], pa.string()),
            pa.array([part] * len(groups), pa.int64()),
            pa.array([self.count[g] for g in groups], pa.int64()),
            pa.array([self.factor[g].ravel() for g in groups], pa.list_(pa.float64())),
        ]
        self.factor.clear()
        self.count.clear()
        return pa.RecordBatch.from_arrays(out, ["_g", "_part", "_n", "_r"])


def _partial_factors(k: int, grouped: bool, held: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        factors = _Factors(k)
        for b in batches:
            x = matrix(b["_x"], k)
            for g, rows in by_group(b["_g"]) if grouped else [(None, slice(None))]:
                factors.add(g, x[rows])
                if 8 * k * k * len(factors.count) > held:
                    yield factors.handed_on(part)
        if factors.count:
            yield factors.handed_on(part)

    return run


def _merge(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.asarray(r, dtype=np.float64).reshape(k, k) for r in pdf["_r"]])
        return pd.DataFrame(
            {
                "_g": [pdf["_g"].iloc[0]],
                "_part": [int(pdf["_part"].iloc[0])],
                "_n": [int(pdf["_n"].sum())],
                "_r": [_qr_r(stacked, k).ravel()],
            }
        )

    return run


def factor_table(
    df: DataFrame, columns: Sequence[Column], group: Column | None = None, fan_in: int = FAN_IN, tree: bool | None = None
) -> DataFrame:
    """One row per group: (_g, _n, _r), the row count and the flat R factor.

    Rows with a NULL or NaN in any column are skipped (complete cases).
    ``tree`` forces or forbids the merge tree (default: large inputs).
    """
    k = len(columns)
    if k > MAX_COLUMNS:
        raise ValueError(f"{k} design columns is beyond the dense-factor limit {MAX_COLUMNS}")
    if k > WIDE_COLUMNS:
        wide_projection(df.sparkSession)
    g = group.cast("string") if group is not None else F.lit(None).cast("string")
    proj = df.select(g.alias("_g"), array_of(columns).alias("_x"))
    tree = not is_small(proj) if tree is None else tree
    partials = spread(proj).mapInArrow(_partial_factors(k, group is not None, HELD_BYTES), _SCHEMA)
    if tree:
        splits = max(split_estimate(proj), fan_in * fan_in + 1)
        partials = tree_merged(partials, ["_g"], _merge(k), _SCHEMA, splits, 8 * k * k, fan_in)
    return partials.groupBy("_g").applyInPandas(_merge(k), _SCHEMA).select("_g", "_n", "_r")


def tsqr(
    df: DataFrame,
    columns: Sequence[Column],
    group: Column | None = None,
    fan_in: int = FAN_IN,
    tree: bool | None = None,
) -> dict:
    """R factor (k x k, k = len(columns)) and row count per group, on the
    driver: ``{group_value_as_str_or_None: (R, n)}``.  For few groups (folds,
    split sides); many are solved in place, see :func:`factor_table`."""
    k = len(columns)
    rows = factor_table(df, columns, group, fan_in, tree).collect()
    return {r["_g"]: (np.asarray(r["_r"], dtype=np.float64).reshape(k, k), r["_n"]) for r in rows}


def merge_factors(factors: Sequence[np.ndarray]) -> np.ndarray:
    """R of the union of row sets given their R factors."""
    k = factors[0].shape[1]
    return _qr_r(np.vstack(factors), k)
