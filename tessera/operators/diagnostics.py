"""Tables behind the diagnostic plots: residuals, reference lines, Q-Q,
normal overlay, weight paths and metric curves."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import dlit, normal_quantile
from tessera.operators.rank import exact_rank
from tessera.operators.regress import fit


def residuals(df: DataFrame, y: str, y_hat: str, transform: Callable[[Column], Column] | None = None, out: str = "residual") -> DataFrame:
    """residual = y − ŷ, after an optional transform of both."""
    yc, pc = F.col(y), F.col(y_hat)
    if transform is not None:
        yc, pc = transform(yc), transform(pc)
    return df.withColumn(out, yc - pc)


def perfect_line(df: DataFrame, y: str, y_hat: str) -> DataFrame:
    """End points of the y = ŷ line: min and max over both columns."""
    return df.agg(
        F.least(F.min(y), F.min(y_hat)).alias("lo"),
        F.greatest(F.max(y), F.max(y_hat)).alias("hi"),
    )


def polyfit_curve(df: DataFrame, y: str, y_hat: str, degree: int = 1, points: int = 100) -> DataFrame:
    """Fit ŷ ~ poly(y) and evaluate it on ``points`` even points of y's range.

    y is centred and scaled first (conditioning); the curve is in y units.
    """
    r = df.agg(F.avg(y).alias("m"), F.stddev_samp(y).alias("s"), F.min(y).alias("lo"), F.max(y).alias("hi")).first()
    s = r["s"] or 1.0
    base = {y: (F.col(y) - dlit(r["m"])) / dlit(s)}
    model = fit(df, [y], y_hat, degree, base=base)
    step = (r["hi"] - r["lo"]) / (points - 1) if points > 1 else 0.0
    grid = df.sparkSession.range(points).select(
        F.col("id").cast("int").alias("i"), (dlit(r["lo"]) + F.col("id") * dlit(step)).alias(y)
    )
    return grid.select("i", F.col(y).alias("x"), model.prediction(base).alias("fitted"))


def normal_pdf_overlay(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """N(mean, population std) density on ``points`` even points from min to max."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.avg(col).alias("m"), F.stddev_pop(col).alias("s")).first()
    s, m = r["s"], r["m"]
    if not s:  # no values, or all equal: there is no density to draw
        return df.sparkSession.createDataFrame([], "i int, x double, pdf double")
    step = (r["hi"] - r["lo"]) / (points - 1) if points > 1 else 0.0
    x = dlit(r["lo"]) + F.col("id") * dlit(step)
    pdf = dlit(1.0 / (s * math.sqrt(2 * math.pi))) * F.exp(-F.pow(x - dlit(m), 2) / dlit(2 * s * s))
    return df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"), x.alias("x"), pdf.alias("pdf"))


def qq_table(df: DataFrame, col: str, tiebreak_cols: Sequence[str]) -> DataFrame:
    """Sorted values with p = (i − 0.5)/n and the theoretical normal quantile.

    The rank is exact and global (range sort + partition offsets); equal
    values are spread over partitions by the tie-break columns.
    """
    data = df.filter(F.col(col).isNotNull()).select(col, *tiebreak_cols)
    n = data.count()
    ranked = exact_rank(data, [col], list(tiebreak_cols), "i")
    p = (F.col("i") - 0.5) / F.lit(n)
    return ranked.select("i", F.col(col).alias("observed"), p.alias("p"), normal_quantile(p).alias("theoretical"))


def qq_line(qq: DataFrame) -> DataFrame:
    """Least-squares line of observed on theoretical quantiles, and their correlation."""
    return qq.agg(
        F.regr_slope("observed", "theoretical").alias("slope"),
        F.regr_intercept("observed", "theoretical").alias("intercept"),
        F.corr("theoretical", "observed").alias("r"),
    )


def weight_paths(wide: DataFrame, param_col: str, features: Sequence[str]) -> DataFrame:
    """Wide (param, f1, f2, …) -> long (param, feature, weight)."""
    return wide.unpivot([param_col], list(features), "feature", "weight")


def metric_curve(curve: DataFrame, param_col: str, metric: str, minimize: bool, position_col: str = "position") -> DataFrame:
    """(position, param, value, is_best): the optimum (first on ties) marked."""
    from tessera.plans.select import best_param

    best = best_param(curve, param_col, metric, minimize, position_col).first()[position_col]
    return curve.select(
        position_col, param_col, F.col(metric).alias("value"), (F.col(position_col) == F.lit(best)).alias("is_best")
    )
