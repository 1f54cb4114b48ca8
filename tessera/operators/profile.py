"""Profiling aggregates.  Each is one (or a fixed few) aggregate jobs whatever
the number of columns; wide results are reshaped with ``explode``/``stack``."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import dlit
from tessera.operators.blocks import array_of, matrix, tree_merged
from tessera.operators.prep import numeric_columns
from tessera.operators.rank import column_stats, exact_quantiles
from tessera.session import split_estimate, staged

# Correlations hold six dense matrices of this width at most per task.
MAX_COLUMNS = 1000

DESCRIBE_SCHEMA = (
    "column string, position int, count long, unique long, top string, freq long, mean double, std double, "
    "min double, p25 double, p50 double, p75 double, max double"
)


def describe_all(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: count, unique/top/freq (non-numeric), mean/std/min/quartiles/max (numeric).

    Three scans: moments and brackets of the quartiles, the values inside the
    brackets, and the value counts of the non-numeric columns.  Quartiles
    interpolate linearly; ``exact=False`` uses ``percentile_approx``.
    Top value ties go to the smallest value.
    """
    with staged(df) as data:
        return _describe(data, exact)


def _describe(df: DataFrame, exact: bool) -> DataFrame:
    spark = df.sparkSession
    cols = df.columns
    nums = numeric_columns(df)
    others = [c for c in cols if c not in nums]
    quartiles = [0.25, 0.5, 0.75]
    stats = column_stats(df, nums, quartiles) if nums else {}
    if exact:
        quant = exact_quantiles(df, nums, quartiles, stats=stats) if nums else {}
    else:
        quant = {(None, c, q): stats[c]["approx"][q] for c in nums for q in quartiles}
    tops = {}
    if others:
        long = df.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in others])).alias("_s")
        ).select("_s.c", "_s.v").filter(F.col("v").isNotNull())
        counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        # count, distinct values and most frequent value (ties to the smallest)
        # all follow from one grouped count
        top = counts.groupBy("c").agg(
            F.min_by("v", F.struct((-F.col("n")).alias("k"), F.col("v").alias("v"))).alias("top"), F.max("n").alias("freq"),
            F.sum("n").alias("cnt"), F.count("*").alias("uniq"),
        )
        tops = {r["c"]: (r["cnt"], r["uniq"], r["top"], r["freq"]) for r in top.collect()}
    rows = []
    for i, c in enumerate(cols):
        if c in nums:
            v = stats[c]
            q = [quant.get((None, c, p)) for p in quartiles]
            rows.append((c, i, v["n"], None, None, None, v["mean"], v["std"], v["min"], *q, v["max"]))
        else:
            cnt, uniq, top, freq = tops.get(c, (0, 0, None, None))
            rows.append((c, i, cnt, uniq, top, freq, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, DESCRIBE_SCHEMA)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, only_positive: bool = True) -> DataFrame:
    """(column, nulls) for columns with at least one NULL (or all columns)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls")) for c in cols])).alias("_s")
    ).select("_s.*")
    return long.filter(F.col("nulls") > 0) if only_positive else long


def null_cells_total(df: DataFrame) -> DataFrame:
    total = None
    for c in df.columns:
        e = F.count_if(F.col(c).isNull())
        total = e if total is None else total + e
    return df.agg(total.cast("long").alias("null_cells"))


def any_null(columns: Sequence[str]) -> Column:
    e = None
    for c in columns:
        e = F.col(c).isNull() if e is None else (e | F.col(c).isNull())
    return e


def rows_with_null(df: DataFrame) -> DataFrame:
    """Rows that would be lost by dropping every row with any NULL."""
    return df.agg(F.count_if(any_null(df.columns)).cast("long").alias("rows_with_null"))


_CO_SCHEMA = "_part long, _n array<double>, _s array<double>, _q array<double>, _p array<double>, _lo array<double>, _hi array<double>"
_CO_SUMS, _CO_ENDS = ("_n", "_s", "_q", "_p"), ("_lo", "_hi")


class CoMoments:
    """Pairwise-complete co-moments of a block of rows about given centres, as
    p x p matrices that add up over blocks.  Entry (i, j) covers the rows where
    columns i and j are both known: their number, the sums of x_i, x_i² and
    x_i x_j, and the smallest and largest x_i."""

    def __init__(self, centre: np.ndarray):
        p = len(centre)
        self.centre = centre
        self.values = {c: np.zeros((p, p)) for c in _CO_SUMS} | {"_lo": np.full((p, p), np.inf), "_hi": np.full((p, p), -np.inf)}

    def add(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        v = self.values
        gone = np.isnan(rows)
        if not gone.any():
            x = rows - self.centre
            ones = np.ones((1, x.shape[1]))
            v["_n"] += len(x)
            v["_s"] += x.sum(axis=0)[:, None] @ ones
            v["_q"] += (x * x).sum(axis=0)[:, None] @ ones
            v["_p"] += x.T @ x
            np.minimum(v["_lo"], rows.min(axis=0)[:, None], out=v["_lo"])
            np.maximum(v["_hi"], rows.max(axis=0)[:, None], out=v["_hi"])
            return
        known = (~gone).astype(np.float64)
        x = np.where(gone, 0.0, rows - self.centre)
        v["_n"] += known.T @ known
        v["_s"] += x.T @ known
        v["_q"] += (x * x).T @ known
        v["_p"] += x.T @ x
        low, high = np.where(gone, np.inf, rows), np.where(gone, -np.inf, rows)
        # columns that are known in the same rows see the same extremes
        patterns, which = np.unique(known, axis=1, return_inverse=True)
        for i in range(patterns.shape[1]):
            use, at = patterns[:, i] > 0, np.flatnonzero(which.ravel() == i)
            if use.any():
                v["_lo"][:, at] = np.minimum(v["_lo"][:, at], low[use].min(axis=0)[:, None])
                v["_hi"][:, at] = np.maximum(v["_hi"][:, at], high[use].max(axis=0)[:, None])

    def merge(self, columns: dict) -> None:
        shape = self.values["_n"].shape
        for c in _CO_SUMS:
            self.values[c] += np.asarray(columns[c], np.float64).reshape(shape)
        for c, join in zip(_CO_ENDS, (np.minimum, np.maximum)):
            join(self.values[c], np.asarray(columns[c], np.float64).reshape(shape), out=self.values[c])

    def correlations(self) -> np.ndarray:
        """NaN where a pair has no common row or a column is constant there."""
        v = self.values
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = v["_s"] / v["_n"]
            variance = v["_q"] / v["_n"] - mean * mean
            cov = v["_p"] / v["_n"] - mean * mean.T
            r = cov / np.sqrt(variance * variance.T)
        constant = ~(v["_lo"] < v["_hi"])
        return np.where(constant | constant.T | ~np.isfinite(r), np.nan, r)


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete), long form (a, b, r).

    Two passes whatever the number of columns: the means, and mergeable
    co-moment matrices about them (:class:`CoMoments`), one small row per task,
    merged over a tree on large inputs.  NULL when one column of a pair is
    constant on the rows where both are known.
    """
    cols = list(columns or numeric_columns(df))
    p = len(cols)
    if p > MAX_COLUMNS:
        raise ValueError(f"{p} columns are beyond the dense-matrix limit {MAX_COLUMNS}")
    schema = "a string, b string, r double"
    if not p:
        return df.sparkSession.createDataFrame([], schema)
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols]
    with staged(df.select(array_of(x).alias("_x"))) as data:
        means = _column_means(data, p)

        def block(batches):
            from pyspark import TaskContext

            total = CoMoments(means)
            for b in batches:
                total.add(matrix(b["_x"], p))
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            flat = [pa.array([total.values[c].ravel()], pa.list_(pa.float64())) for c in (*_CO_SUMS, *_CO_ENDS)]
            yield pa.RecordBatch.from_arrays([part, *flat], ["_part", *_CO_SUMS, *_CO_ENDS])

        def merge(pdf: pd.DataFrame) -> pd.DataFrame:
            total = CoMoments(means)
            for _, row in pdf.iterrows():
                total.merge(row)
            return pd.DataFrame({"_part": [int(pdf["_part"].iloc[0])], **{c: [total.values[c].ravel()] for c in total.values}})

        partials = tree_merged(data.mapInArrow(block, _CO_SCHEMA), [], merge, _CO_SCHEMA, split_estimate(data), 48 * p * p)
        total, table = CoMoments(means), partials.toArrow()
        for i in range(table.num_rows):
            total.merge({c: table[c][i].values for c in total.values})
    r = total.correlations()
    rows = [(cols[i], cols[j], None if np.isnan(r[i, j]) else float(r[i, j])) for i in range(p) for j in range(p)]
    return df.sparkSession.createDataFrame(rows, schema)


def _column_means(data: DataFrame, p: int) -> np.ndarray:
    """Mean of the known values of each column of the array ``_x`` (0 if none)."""

    def sums(batches):
        total, n = np.zeros(p), np.zeros(p)
        for b in batches:
            rows = matrix(b["_x"], p)
            total += np.nansum(rows, axis=0)
            n += (~np.isnan(rows)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array(total), pa.array(n)], ["i", "s", "n"])

    means = np.zeros(p)
    for row in data.mapInArrow(sums, "i long, s double, n double").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
        means[row["i"]] = row["s"] / row["n"] if row["n"] else 0.0
    return means


def _range(df: DataFrame, col: str) -> tuple[float, float, int]:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1; x = hi folds into the last bin."""
    if lo is None or hi is None:
        return F.lit(None).cast("int")
    width = (hi - lo) if hi > lo else 1.0
    return F.least(F.floor((x - dlit(lo)) / dlit(width) * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """(bin, lo, hi, count, density) with density = count / (N · width)."""
    if lo is None or hi is None:
        lo0, hi0, _ = _range(df, col)
        lo = lo0 if lo is None else lo
        hi = hi0 if hi is None else hi
    if lo is None or hi is None:  # no value at all: no bin
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count long, density double")
    width = (hi - lo) / bins if hi > lo else 1.0 / bins
    x = F.col(col).cast("double")
    counted = (
        df.filter(x.isNotNull() & (x >= lo) & (x <= hi))
        .groupBy(bin_index(x, lo, hi, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # total over the small (<= bins rows) table of bin counts
    return counted.withColumn("t", F.sum("count").over(Window.partitionBy())).select(
        "bin",
        (dlit(lo) + F.col("bin") * dlit(width)).alias("lo"),
        (dlit(lo) + (F.col("bin") + 1) * dlit(width)).alias("hi"),
        "count",
        (F.col("count") / (F.col("t") * dlit(width))).alias("density"),
    )


def kde_grid(df: DataFrame, col: str, points: int = 100, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on ``points`` even grid points from min to max.

    Exact over all rows, in one scan for any number of points: tasks sum the
    kernels of their rows on the whole grid.  No value gives no row.  Default bandwidth is Scott's rule, sample std · n^(-1/5).
    """
    x = F.col(col).cast("double")
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("s")).first()
    lo, hi, n, s = r["lo"], r["hi"], r["n"], r["s"]
    schema = "i int, x double, density double"
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    h = bandwidth if bandwidth is not None else (s or 1.0) * n ** (-0.2)
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    grid = np.array([lo + i * step for i in range(points)])

    def kernel_sums(batches):
        total = np.zeros(points)
        for pdf in batches:
            values = pdf["_x"].to_numpy(np.float64)
            for at in range(0, len(values), 2048):
                total += np.exp(-0.5 * ((grid[:, None] - values[None, at : at + 2048]) / h) ** 2).sum(axis=1)
        yield pd.DataFrame({"i": np.arange(points, dtype=np.int32), "k": total})

    data = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    sums = data.mapInPandas(kernel_sums, "i int, k double").groupBy("i").agg(F.sum("k").alias("k")).collect()
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    rows = sorted((r["i"], float(grid[r["i"]]), float(r["k"]) * norm) for r in sums)
    return df.sparkSession.createDataFrame(rows, schema)


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 20, hue: str | None = None) -> DataFrame:
    """2-D bin counts of a column pair (optionally per hue): the table behind a scatter plot."""
    r = df.agg(F.min(x).alias("xl"), F.max(x).alias("xh"), F.min(y).alias("yl"), F.max(y).alias("yh")).first()
    keys = [bin_index(F.col(x).cast("double"), r["xl"], r["xh"], bins).alias("bx"),
            bin_index(F.col(y).cast("double"), r["yl"], r["yh"], bins).alias("by")]
    if hue:
        keys.append(F.col(hue))
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def pair_bins(df: DataFrame, columns: Sequence[str], bins: int = 10, hue: str | None = None) -> DataFrame:
    """2-D bin counts for every pair of ``columns`` (the table behind a pair
    plot), in one scan: ranges in one aggregate, then rows exploded to
    (x, y, bx, by) and counted with one ``groupBy``."""
    cols = list(columns)
    r = df.agg(*[F.min(c).cast("double").alias(f"lo_{i}") for i, c in enumerate(cols)],
               *[F.max(c).cast("double").alias(f"hi_{i}") for i, c in enumerate(cols)]).first()
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if i != j]
    structs = []
    for i, j in pairs:
        xi, xj = F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")
        ok = xi.isNotNull() & xj.isNotNull()
        structs.append(
            F.when(ok, F.struct(F.lit(cols[i]).alias("x"), F.lit(cols[j]).alias("y"),
                                bin_index(xi, r[f"lo_{i}"], r[f"hi_{i}"], bins).alias("bx"),
                                bin_index(xj, r[f"lo_{j}"], r[f"hi_{j}"], bins).alias("by")))
        )
    keep = [F.col(hue)] if hue else []
    long = df.select(*keep, F.explode(F.array(*structs)).alias("_s")).filter(F.col("_s").isNotNull())
    keys = [F.col("_s.x").alias("x"), F.col("_s.y").alias("y"), F.col("_s.bx").alias("bx"), F.col("_s.by").alias("by")]
    return long.groupBy(*keys, *keep).agg(F.count(F.lit(1)).alias("count"))
