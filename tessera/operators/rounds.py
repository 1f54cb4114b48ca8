"""Iterations over rows that stay in memory, all in one Spark job.

Descent with an absolute loss and Lloyd's k-means need every row in every round
but exchange only a few sums.  For inputs that fit, :func:`in_one_job` runs a
barrier stage: each task reads its rows once, keeps them as one matrix, and the
tasks add up their sums with ``allGather`` after each round, in task order, so
all of them take the same next step.  A lost executor restarts the stage, which
is deterministic.  What does not fit (or a cluster that cannot run a barrier
stage) gets one job per round from the caller.
"""

from __future__ import annotations

import base64
import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.operators.blocks import matrix
from tessera.session import is_small, size_estimate

#: Bytes that one task may hold, its rows and what the caller keeps for each of
#: them; beyond it the caller's other way runs.
HELD_BYTES = 128 << 20
#: Input bytes (the optimizer's estimate) that are worth a task of their own.  A
#: gathering takes about a second however little it moves (Spark polls for it),
#: so inputs below this bound are one block of one task and need none.
TASK_BYTES = 16 << 20


def slots(df: DataFrame) -> int:
    """Tasks that the cluster can run at the same time."""
    sc = df.sparkSession.sparkContext._jsc.sc()
    return sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile())


def can_hold(df: DataFrame) -> bool:
    """Whether a barrier stage over ``df`` may be tried: a small input, and no
    dynamic allocation (which Spark does not combine with barriers)."""
    dynamic = df.sparkSession.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false")
    return is_small(df) and dynamic != "true" and slots(df) > 0


class Rows:
    """A matrix that takes in blocks; it grows in place by a quarter, so that no
    second copy of it is ever held."""

    def __init__(self, width: int):
        self.held = np.empty((0, width))
        self.n = 0

    def add(self, block: np.ndarray) -> None:
        n = self.n + len(block)
        if n > len(self.held):
            self.held.resize((max(n, len(self.held) * 5 // 4), self.held.shape[1]), refcheck=False)
        self.held[self.n : n] = block
        self.n = n

    def rows(self) -> np.ndarray:
        return self.held[: self.n]


def in_one_job(df: DataFrame, width: int, body: Callable, extra: int = 0, most: int | None = None):
    """``body(rows, total)`` in a barrier stage over the array column ``_x``.

    ``rows`` is the task's matrix (NULL as NaN) and ``total(part)`` the sum of
    all tasks' parts.  The result of the first task is returned; None means
    that some task's rows are too many to hold: more than ``HELD_BYTES`` (or
    ``most``, if less) with the ``extra`` bytes that ``body`` keeps for each row.
    """
    tasks = max(1, min(slots(df), -(-size_estimate(df) // TASK_BYTES)))
    held = HELD_BYTES if most is None else min(most, HELD_BYTES)
    row_bytes = 8 * width + extra

    def run(batches):
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()

        def total(part: np.ndarray) -> np.ndarray:
            if tasks == 1:
                return part
            sent = base64.b64encode(np.ascontiguousarray(part, np.float64).tobytes()).decode()
            parts = [np.frombuffer(base64.b64decode(s)) for s in context.allGather(sent)]
            return np.sum(parts, axis=0).reshape(part.shape)

        kept, n = Rows(width), 0
        for b in batches:
            n += len(b)
            if row_bytes * n <= held:
                kept.add(matrix(b["_x"], width))
            else:
                kept = Rows(width)
        result = None
        if total(np.array([float(row_bytes * n > held)]))[0] == 0:
            result = body(kept.rows(), total)
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(result)], pa.binary())], ["result"])

    dealt = df.select("_x").repartition(tasks)
    return pickle.loads(dealt.mapInArrow(run, "result binary", barrier=True).collect()[0]["result"])
