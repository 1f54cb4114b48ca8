"""Lloyd's k-means over DataFrame columns.

* init: the k rows with the smallest seeded hash of their key (k distinct
  rows), or explicit centres;
* assignment: nearest centre by squared Euclidean distance, ties to the
  lowest index;
* update: means of the assigned rows; an empty cluster keeps its centre;
* stop: total squared centre shift < tol, or max_iter.

Inputs that fit in memory run all rounds in one job
(:mod:`tessera.operators.rounds`): every row carries an upper bound of the
distance to its own centre and a lower bound of that to any other, both moved
by the centres' shifts (triangle inequality), and only rows whose bounds meet
look at the centres again.  Larger inputs run one aggregation per round: a Column
expression with the centres as literals (codegen'd ``groupBy``), or, for wide
problems (k·d > ``WIDE``, the expression would pass the 64 KB code-generation
limit), per-task partial sums over Arrow blocks (k rows per task).

Rows with a NULL or NaN coordinate are left out of the fit and get a NULL label.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import col_of, nearest_center
from tessera.operators.blocks import array_of, matrix
from tessera.operators.rank import hash_key
from tessera.operators.rounds import can_hold, in_one_job
from tessera.session import staged

# Above this many centre coordinates (k * d) assignment is vectorised in Python.
WIDE = 64
#: Bytes of rows that an assignment works on at a time.
PART_BYTES = 4 << 20
#: Label and two bounds of a held row, in bytes.
BOUND_BYTES = 4 + 8 + 8
#: Bounds closer than this share of them count as meeting (rounding).
SLACK = 1e-9


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = np.empty((x.shape[0], centers.shape[0]))
    for j, c in enumerate(centers):
        d[:, j] = ((x - c) ** 2).sum(axis=1)
    return d


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Index of the nearest centre per row (first index on ties)."""
    return _squared(x, centers).argmin(axis=1)


def _sums(x: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """Per label the sum of the rows, and their number in the last column."""
    out = np.zeros((k, x.shape[1] + 1))
    for j in range(k):
        mine = x[labels == j]
        out[j, :-1], out[j, -1] = mine.sum(axis=0), len(mine)
    return out


class BoundedRows:
    """Rows with their labels and distance bounds from round to round.

    Rounds go through the rows in parts, so besides the rows and ``BOUND_BYTES``
    for each of them nothing grows with their number."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.labels = None
        self.looked = 0  # rows that were compared with every centre

    def parts(self) -> list[slice]:
        step = max(1, PART_BYTES // (8 * max(1, self.x.shape[1])))
        return [slice(at, at + step) for at in range(0, len(self.x), step)]

    def assign(self, centers: np.ndarray, shifts: np.ndarray | None) -> np.ndarray:
        """Labels under ``centers``, which moved by ``shifts`` since the last
        call."""
        first = self.labels is None
        if first:
            self.labels = np.empty(len(self.x), np.int32)
            self.own, self.other = np.empty(len(self.x)), np.empty(len(self.x))
        if first or len(centers) < 2:
            for part in self.parts():
                self.labels[part], self.own[part], self.other[part] = self._look(self.x[part], centers)
            return self.labels
        # the largest move among the other centres
        order = np.argsort(shifts)
        most = np.full(len(centers), shifts[order[-1]])
        most[order[-1]] = shifts[order[-2]]
        between = np.sqrt(_squared(centers, centers))
        np.fill_diagonal(between, np.inf)
        for part in self.parts():
            self._move(part, centers, shifts, most, between.min(axis=1) / 2)
        return self.labels

    def _move(self, part: slice, centers: np.ndarray, shifts: np.ndarray, most: np.ndarray, half: np.ndarray) -> None:
        # views: what changes here changes the whole
        x, labels, own, other = self.x[part], self.labels[part], self.own[part], self.other[part]
        own += shifts[labels]
        other -= most[labels]
        safe = np.maximum(half[labels], other)
        near = np.flatnonzero(own * (1 + SLACK) >= safe)
        own[near] = np.sqrt(((x[near] - centers[labels[near]]) ** 2).sum(axis=1))
        near = near[own[near] * (1 + SLACK) >= safe[near]]
        labels[near], own[near], other[near] = self._look(x[near], centers)

    def sums(self, k: int) -> np.ndarray:
        """:func:`_sums` of all rows under their labels."""
        out = np.zeros((k, self.x.shape[1] + 1))
        for part in self.parts():
            out += _sums(self.x[part], self.labels[part], k)
        return out

    def _look(self, x: np.ndarray, centers: np.ndarray):
        self.looked += len(x)
        d = _squared(x, centers)
        labels = d.argmin(axis=1)
        rows = np.arange(len(x))
        own = np.sqrt(d[rows, labels])
        d[rows, labels] = np.inf
        return labels, own, np.sqrt(d.min(axis=1)) if len(centers) > 1 else np.full(len(x), np.inf)


def lloyd(centers: np.ndarray, sums_of, tol: float, max_iter: int) -> tuple[np.ndarray, int, float, bool]:
    """Rounds until the stop rule; ``sums_of(centers, shifts)`` gives the sums
    and numbers of the rows of each centre.  Returns (centres, rounds, last
    shift, whether the rule stopped it)."""
    shift, n_iter, shifts = float("inf"), 0, None
    for n_iter in range(1, max_iter + 1):
        sums = sums_of(centers, shifts)
        filled = sums[:, -1] > 0
        new = centers.copy()
        new[filled] = sums[filled, :-1] / sums[filled, -1:]
        moved = ((centers - new) ** 2).sum(axis=1)
        shift, shifts, centers = float(np.sum((centers - new) ** 2)), np.sqrt(moved), new
        if shift < tol:
            return centers, n_iter, shift, True
    return centers, n_iter, shift, False


def _label_udf(centers: np.ndarray):
    @F.arrow_udf("int")
    def label(x: pa.Array) -> pa.Array:
        m = matrix(x, centers.shape[1])
        gone = np.isnan(m).any(axis=1)
        return pa.array(_nearest(m, centers).astype(np.int32), mask=gone)

    return label


@dataclass(frozen=True)
class KMeansModel:
    centers: tuple[tuple[float, ...], ...]
    n_iter: int
    shift: float
    converged: bool

    @property
    def k(self) -> int:
        return len(self.centers)

    def label(self, points: Sequence[str | Column]) -> Column:
        pts = [col_of(p) for p in points]
        if len(self.centers) * len(pts) > WIDE:
            return _label_udf(np.asarray(self.centers, dtype=float))(array_of(pts))
        return nearest_center(pts, self.centers)

    def predict(self, df: DataFrame, points: Sequence[str | Column], out: str = "zone") -> DataFrame:
        """Stateless: works on batch and streaming DataFrames."""
        return df.withColumn(out, self.label(points))

    def centers_df(self, spark: SparkSession, zone_col: str = "zone") -> DataFrame:
        return spark.createDataFrame(
            [(z, [float(x) for x in c]) for z, c in enumerate(self.centers)], f"{zone_col} int, center array<double>"
        )


def kmeans_fit(
    df: DataFrame,
    points: Sequence[str | Column],
    k: int = 2,
    max_iter: int = 100,
    tol: float = 1e-4,
    seed: int = 42,
    key_cols: Sequence[str] | None = None,
    init: Sequence[Sequence[float]] | None = None,
) -> KMeansModel:
    pts = [col_of(p) for p in points]
    d = len(pts)
    complete = None
    for i, p in enumerate(pts):
        c = p.isNotNull() & ~F.isnan(p.cast("double"))
        complete = c if complete is None else complete & c
    keys = list(key_cols or [])
    proj = df.filter(complete).select(array_of(pts).alias("_x"), *keys)
    if init is not None:
        centers = np.asarray(init, dtype=float)
        if centers.shape != (k, d):
            raise ValueError(f"init must be {k} x {d}")
    else:
        if not key_cols:
            raise ValueError("key_cols are needed for the seeded initialisation")
        first = proj.orderBy(hash_key(seed, key_cols), *key_cols).limit(k).collect()
        if len(first) < k:
            raise ValueError(f"fewer than {k} complete rows")
        centers = np.array([r["_x"] for r in first], dtype=float)
    proj = proj.select("_x")

    def body(rows, total):
        bounded = BoundedRows(rows)

        def sums_of(c, shifts):
            bounded.assign(c, shifts)
            return total(bounded.sums(k))

        return lloyd(centers, sums_of, tol, max_iter)

    found = in_one_job(proj, d, body, BOUND_BYTES) if can_hold(proj) else None
    if found is None:
        with staged(proj) as data:
            found = lloyd(centers, lambda c, _: _sums_by_job(data, c), tol, max_iter)
    centers, n_iter, shift, converged = found
    return KMeansModel(tuple(tuple(map(float, c)) for c in centers), n_iter, shift, converged)


def _sums_by_job(data: DataFrame, centers: np.ndarray) -> np.ndarray:
    """Sums and numbers of the rows of each centre, at most k rows per task
    before they are merged."""
    k, d = centers.shape
    out = np.zeros((k, d + 1))
    if k * d > WIDE:

        def run(batches):
            total = np.zeros((k, d + 1))
            for b in batches:
                x = matrix(b["_x"], d)
                total += _sums(x, _nearest(x, centers), k)
            label, at = np.divmod(np.arange(total.size), d + 1)
            columns = [pa.array(label), pa.array(at), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["l", "at", "v"])

        part = data.mapInArrow(run, "l long, at long, v double").groupBy("l", "at").agg(F.sum("v").alias("v"))
        for r in part.collect():
            out[r["l"], r["at"]] = r["v"]
        return out
    x = [F.col("_x")[i] for i in range(d)]
    label = nearest_center(x, [tuple(c) for c in centers])
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(x)]
    for r in data.groupBy(label.alias("_l")).agg(*sums, F.count(F.lit(1)).alias("n")).collect():
        out[r["_l"]] = [*[r[f"s{i}"] for i in range(d)], r["n"]]
    return out


def kmeans_fit_predict(df: DataFrame, points: Sequence[str | Column], out: str = "zone", **kwargs) -> tuple[KMeansModel, DataFrame]:
    """Fit, then label every row with the FINAL centres."""
    model = kmeans_fit(df, points, **kwargs)
    return model, model.predict(df, points, out)


def kmeans_fit_mllib(
    df: DataFrame,
    points: Sequence[str | Column],
    k: int = 2,
    max_iter: int = 100,
    tol: float = 1e-4,
    seed: int = 42,
) -> KMeansModel:
    """MLlib's k-means (k-means|| init, its own stop rule) as an alternative
    backend; the result is the same frozen :class:`KMeansModel`.

    Its initialisation and convergence test differ from the Lloyd loop
    above, so it is a cross-check, not a drop-in equal.
    """
    from pyspark.ml.clustering import KMeans as MLKMeans
    from pyspark.ml.feature import VectorAssembler

    pts = [col_of(p).cast("double") for p in points]
    complete = None
    for p in pts:
        known = p.isNotNull() & ~F.isnan(p)
        complete = known if complete is None else complete & known
    names = [f"_p{i}" for i in range(len(pts))]
    data = df.filter(complete).select(*[p.alias(n) for p, n in zip(pts, names)])
    vec = VectorAssembler(inputCols=names, outputCol="_v").transform(data)
    model = MLKMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol="_v").fit(vec)
    summary = model.summary
    return KMeansModel(
        tuple(tuple(map(float, c)) for c in model.clusterCenters()), summary.numIter, float("nan"), summary.numIter < max_iter
    )
