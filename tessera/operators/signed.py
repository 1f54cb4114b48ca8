"""Sums of absolute errors over all rows for many nearby coefficients, from few
passes.

Σ|x·b − y| and its gradient Σ sign(x·b − y) x need the rows only for their
signs: while no sign changes, both are linear in b.  A pass at coefficients b
sums the rows whose sign is settled around b, and keeps the rows nearest to
their sign change as they are.  It holds for every b + δ with ‖δ·s‖ below the
least |x·b − y| / ‖x / s‖ of the settled rows (Cauchy-Schwarz; s = root mean
square of each term).  All sums are exact: no row is left out, and coefficients
that no pass holds for get a pass of their own.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rounds import Rows
from tessera.session import persisted, wide_projection

#: Rows near their sign change that a pass keeps, in bytes; and passes kept.
NEAR_BYTES = 16 << 20
PASSES = 4
#: Share of the reach that rounding may take.
SLACK = 1e-9


@dataclass(frozen=True)
class Pass:
    at: np.ndarray
    reach: float
    signed: np.ndarray  # Σ sign · [x, y] of the settled rows
    near: np.ndarray  # the others

    def holds(self, b: np.ndarray, scale: np.ndarray) -> bool:
        moved = np.linalg.norm((b - self.at) * scale)
        return moved == 0 or moved < self.reach * (1 - SLACK)

    def sums(self, b: np.ndarray) -> tuple[float, np.ndarray]:
        """Σ|x·b − y| and Σ sign(x·b − y) x over all rows."""
        x, e = self.near[:, :-1], self.near[:, :-1] @ b - self.near[:, -1]
        return self.signed[:-1] @ b - self.signed[-1] + np.abs(e).sum(), self.signed[:-1] + x.T @ np.sign(e)


class SignedSums:
    """Row number and sums at any coefficients, over persisted rows [x, y]
    without NULL or NaN.  ``passes`` counts the passes that ran."""

    def __init__(self, data: DataFrame, width: int):
        self.data, self.width, self.passes, self.kept = data, width, 0, []

        def run(batches):
            out = np.zeros(width)
            for rows in _complete(batches):
                out[0] += len(rows)
                out[1:] += (rows[:, :-1] ** 2).sum(axis=0)
            yield _one(out)

        parts = self._collect(run)
        self.tasks = max(1, len(parts))
        total = np.sum(parts, axis=0) if parts else np.zeros(width)
        self.n = int(total[0])
        self.scale = np.sqrt(total[1:] / max(self.n, 1))

    def _collect(self, run) -> list:
        # one short row of each task
        return [pickle.loads(r["v"]) for r in self.data.mapInArrow(run, "v binary").collect()]

    def at(self, b: np.ndarray) -> tuple[float, np.ndarray]:
        for i, each in enumerate(self.kept):
            if each.holds(b, self.scale):
                self.kept.insert(0, self.kept.pop(i))
                return each.sums(b)
        self.kept = [self._pass(b.copy()), *self.kept[: PASSES - 1]]
        return self.kept[0].sums(b)

    def _pass(self, b: np.ndarray) -> Pass:
        width, most = self.width, max(1, NEAR_BYTES // (8 * self.width * self.tasks))
        weight = np.divide(1.0, self.scale, out=np.zeros(width - 1), where=self.scale > 0)

        def run(batches):
            signed, near, reach = np.zeros(width), Rows(width + 1), np.inf

            def settle(rows, e):
                signed[:] += np.sign(e) @ rows

            def shrink():
                nonlocal near, reach
                held = near.rows()
                order = np.argpartition(held[:, -1], most)
                reach = min(reach, float(held[order[most], -1]))
                out = held[order[most:], :-1]
                settle(out, out[:, :-1] @ b - out[:, -1])
                fewer = Rows(width + 1)
                fewer.add(held[order[:most]])
                near = fewer

            for rows in _complete(batches):
                e = rows[:, :-1] @ b - rows[:, -1]
                size = np.sqrt(((rows[:, :-1] * weight) ** 2).sum(axis=1))
                # a row of zeros keeps its sign wherever b moves
                turn = np.divide(np.abs(e), size, out=np.full(len(e), np.inf), where=size > 0)
                close = turn < reach
                settle(rows[~close], e[~close])
                near.add(np.column_stack([rows[close], turn[close]]))
                if near.n > 2 * most:
                    shrink()
            if near.n > most:
                shrink()
            yield _one((signed, near.rows()[:, :-1].copy(), reach))

        self.passes += 1
        parts = self._collect(run)
        return Pass(b, min(p[2] for p in parts), np.sum([p[0] for p in parts], axis=0), np.concatenate([p[1] for p in parts]))


def _complete(batches):
    for batch in batches:
        if len(batch):
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield rows[~np.isnan(rows).any(axis=1)]


def _one(value) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(value)], pa.binary())], ["v"])


def numbers(df: DataFrame, columns: Sequence[Column]):
    """The columns as doubles, persisted (in memory, else on disk): every pass
    reads all of them.  No shuffle: the input's splits are the tasks."""
    wide_projection(df.sparkSession)
    proj = df.select(*[F.coalesce(c.cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(columns)])
    return persisted(proj)
