"""Packing documents into sequences by cutting-stock column generation.

* Pieces: every document's ids, followed by an end id, are cut every
  ``seq_len`` ids.  One scan of the texts writes a row per piece with its
  class (length in units, rounded up) and its position among the pieces of
  the same class in its partition.
* Histogram: pieces per class, at most ``UNITS`` rows; only it reaches the
  driver.
* Column generation: the linear program that covers the histogram with the
  fewest patterns (multisets of classes that fit a sequence).  A knapsack
  dynamic program over the duals prices the next column, until none helps.
* Rounding: every pattern is used the whole number of times the program says;
  the few classes left over are packed by best fit, decreasing.
* Assignment: a piece's rank in its class (position in the partition plus the
  partitions before) tells pattern, sequence and slot.  Offsets inside a
  sequence are sums over its few pieces.

Defined results: NULL and empty text is one piece with the end id alone;
repeated rows are separate documents; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged, worker_cache
from tessera.llm.tokens import encoder

SEQ_LEN = 4096
#: Length classes of a sequence; lengths are rounded up to seq_len / UNITS ids.
UNITS = 512
#: The program stops at the optimum, or as soon as it is this close to the volume
#: bound (which no packing beats), or after so many pivots; whenever it stops,
#: its patterns cover everything.
GAP = 0.0005
MAX_PIVOTS = 6000
#: Columns taken from one round of pricing.
COLUMNS = 16


# -- column generation over the histogram (bounded: at most UNITS classes) ----


def best_patterns(value: np.ndarray, units: np.ndarray, capacity: int) -> list[tuple[float, np.ndarray]]:
    """Unbounded knapsack: for every class, the pattern of largest value within
    ``capacity`` that holds it; the best first, equal patterns once."""
    order = np.argsort(units, kind="stable")
    units, value = units[order], value[order]
    f = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fitting = np.searchsorted(units, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        f[c], pick[c] = f[c - 1], -1
        n = fitting[c]
        if n:
            gain = f[c - units[:n]] + value[:n]
            k = int(gain.argmax())
            if gain[k] > f[c]:
                f[c], pick[c] = gain[k], k
    held = value + f[capacity - units]
    picked, lengths = pick.tolist(), units.tolist()
    found: dict[bytes, tuple[float, np.ndarray]] = {}
    for first in np.argsort(-held, kind="stable")[: 2 * COLUMNS].tolist():
        pattern, c = np.zeros(len(units)), capacity - lengths[first]
        pattern[first] = 1
        while c > 0:
            k = picked[c]
            if k < 0:
                c -= 1
            else:
                pattern[k] += 1
                c -= lengths[k]
        whole = np.zeros(len(units))
        whole[order] = pattern
        found.setdefault(whole.tobytes(), (float(held[first]), whole))
        if len(found) == COLUMNS:
            break
    return list(found.values())


def solve_patterns(units: np.ndarray, demand: np.ndarray, capacity: int = UNITS) -> list[tuple[np.ndarray, float]]:
    """Column generation by the revised simplex method: (pattern, times).  A
    round of pricing gives several columns; each enters if the duals that the
    ones before left still price it above one."""
    m = len(units)
    basis = [np.zeros(m) for _ in range(m)]
    for i in range(m):
        basis[i][i] = capacity // units[i]
    inverse = np.diag([1.0 / basis[i][i] for i in range(m)])
    x = inverse @ demand
    bound = float(demand @ units) / capacity
    dual = inverse.sum(axis=0)
    pivots = 0
    while pivots < MAX_PIVOTS and x.sum() > (1 + GAP) * bound:
        entered = 0
        for _, pattern in best_patterns(dual.copy(), units, capacity):
            if dual @ pattern <= 1 + 1e-7:  # its value under the duals as they are
                continue
            use = np.flatnonzero(pattern)
            column = inverse[:, use] @ pattern[use]
            room = np.where(column > 1e-9, x / np.where(column > 1e-9, column, 1), np.inf)
            out = int(room.argmin())
            pivot = inverse[out] / column[out]
            step = x[out] / column[out]
            # only the rows and columns that the pivot touches change
            rows, cols = np.flatnonzero(np.abs(column) > 1e-12), np.flatnonzero(pivot)
            inverse[np.ix_(rows, cols)] -= np.outer(column[rows], pivot[cols])
            inverse[out] = pivot
            dual += (1 - column.sum()) * pivot
            x = np.maximum(x - column * step, 0)
            x[out] = step
            basis[out] = pattern
            entered, pivots = entered + 1, pivots + 1
        if not entered:
            break
    return [(basis[i], float(x[i])) for i in range(m) if x[i] > 1e-9]


def best_fit(items: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing for the leftovers of rounding."""
    by_room: dict[int, list[list[int]]] = defaultdict(list)
    for u in sorted(items, reverse=True):
        room = next((r for r in range(u, capacity + 1) if by_room[r]), None)
        bin_ = by_room[room].pop() if room is not None else []
        bin_.append(u)
        by_room[capacity - sum(bin_)].append(bin_)
    return [b for bins in by_room.values() for b in bins]


def plan_sequences(hist: dict[int, int], capacity: int = UNITS) -> list[tuple[dict[int, int], int]]:
    """Whole-number packing of a class histogram: (pattern, times) pairs that
    use every class exactly as often as it occurs."""
    plan: list[tuple[dict[int, int], int]] = []
    left = {u: n for u, n in hist.items() if n}
    classes = np.array(sorted(left))
    if len(classes):
        demand = np.array([left[u] for u in classes], float)
        for pattern, times in solve_patterns(classes, demand, capacity):
            use = {int(classes[i]): int(k) for i, k in enumerate(pattern) if k}
            n = min([int(times + 1e-6), *(left[u] // k for u, k in use.items())])
            if n > 0:
                plan.append((use, n))
                for u, k in use.items():
                    left[u] -= k * n
    rest = [u for u, n in left.items() for _ in range(n)]
    for b in best_fit(rest, capacity):
        plan.append((dict(zip(*np.unique(b, return_counts=True))), 1))
    return [({int(u): int(k) for u, k in p.items()}, n) for p, n in plan]


# -- Spark side ---------------------------------------------------------------

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, seen long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, seq_len: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece, written once (texts are read a single time)."""
    unit = seq_len // UNITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(f"encoder:{tokenizer}", lambda: encoder(tokenizer))
        tail = end_id.to_bytes(4, "little")
        seen = np.zeros(UNITS + 1, np.int64)
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            ids_of, texts = b["doc_id"].to_pylist(), b["text"]
            for k, doc in enumerate(ids_of):
                ids = encode(texts[k].as_py() or "") + tail
                total = len(ids) // 4
                for start in range(0, total, seq_len):
                    part = ids[4 * start : 4 * (start + seq_len)]
                    n = len(part) // 4
                    cls = -(-n // unit)
                    row = (doc, start, n, zlib.crc32(part), total, cls, int(seen[cls]))
                    seen[cls] += 1
                    for c, v in zip(cols, row):
                        c.append(v)
            types = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            names = [p.split()[0] for p in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return staged(rows.mapInArrow(run, PIECES).withColumn("part", F.spark_partition_id()), "pieces")


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per class, rows (first rank, items per sequence, first sequence, first
    slot), ordered by first rank: the plan as look-up tables."""
    used: dict[int, int] = defaultdict(int)
    rows: dict[int, list] = defaultdict(list)
    sequence = 0
    for pattern, times in plan:
        slot = 0
        for u in sorted(pattern, reverse=True):
            rows[u].append((used[u], pattern[u], sequence, slot))
            used[u] += pattern[u] * times
            slot += pattern[u]
        sequence += times
    return {u: np.array(r, np.int64) for u, r in rows.items()}


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    seq_len: int = SEQ_LEN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset."""
    if seq_len % UNITS:
        raise ValueError(f"seq_len must be a multiple of {UNITS}")
    pieces = cut_pieces(docs, tokenizer, end_id, seq_len, doc_id, text)
    counts = pieces.groupBy("part", "cls").agg(F.count("*").alias("n"))
    counts = staged(counts, "classes")
    before = counts.withColumn(
        "ahead", F.sum("n").over(Window.partitionBy("cls").orderBy("part")) - F.col("n")
    ).drop("n")
    hist = {r["cls"]: r["n"] for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan_sequences(hist))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = b["cls"].to_numpy()
            rank = b["seen"].to_numpy() + b["ahead"].to_numpy()
            sequence, slot = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for u in np.unique(cls):
                at = np.flatnonzero(cls == u)
                table = places[int(u)]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                k = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + k // row[:, 1]
                slot[at] = row[:, 3] + k % row[:, 1]
            keep = [b[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence), pa.array(slot)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
            )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"
    placed = pieces.join(before, ["part", "cls"]).mapInArrow(assign, schema)
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
