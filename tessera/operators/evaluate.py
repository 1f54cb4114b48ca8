"""Evaluation: every metric in ONE aggregate, plus losses, penalties and
gradients as aggregates over the data (used to check fits and by tests)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import col_of, linear_combination
from tessera.functions.metrics import MSE, R2, Metric, get_metric


def evaluate(
    df: DataFrame,
    y: str | Column,
    y_hat: str | Column,
    metrics: Sequence[str | Metric] = (MSE, R2),
    inverse: Callable[[Column], Column] | None = None,
    round_prediction: bool = False,
) -> DataFrame:
    """One row per metric ``(metric, value)``.

    ``inverse`` is applied to BOTH y and ŷ first (e.g. ``F.exp`` after a log
    target).  Rows with NULL y or ŷ are left out.
    """
    yc, pc = col_of(y), col_of(y_hat)
    if inverse is not None:
        yc, pc = inverse(yc), inverse(pc)
    if round_prediction:
        pc = F.rint(pc)
    ms = [get_metric(m) for m in metrics]
    scored = df.select(yc.alias("_y"), pc.alias("_p")).filter(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    row = scored.agg(*[m(F.col("_y"), F.col("_p")) for m in ms])
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(m.name).alias("metric"), F.col(m.name).cast("double").alias("value")) for m in ms])).alias("_m")
    ).select("_m.*")


def evaluate_dict(df: DataFrame, y, y_hat, metrics=(MSE, R2), inverse=None, round_prediction=False) -> dict[str, float]:
    return {r["metric"]: r["value"] for r in evaluate(df, y, y_hat, metrics, inverse, round_prediction).collect()}


def multi_target_mse(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Mean over targets of the per-target MSE (aggregate Column)."""
    parts = [F.avg(F.pow(F.col(p) - F.col(y), 2)) for y, p in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return (out / len(parts)).alias("mse")


def regularized_loss(
    df: DataFrame,
    y: str,
    terms: Sequence[Column],
    beta: Sequence[float],
    loss: str = "mse",
    regularization: str | None = None,
    alpha: float = 0.0,
    l1_ratio: float = 0.5,
    exclude_intercept: bool = True,
) -> float:
    """Base loss over the data + penalty on the coefficients (first = intercept)."""
    from tessera.operators.regress import Penalty

    loss = loss.lower()
    e = linear_combination(0.0, beta, terms) - F.col(y)
    aggs = {
        "mse": F.avg(F.pow(e, 2)),
        "mae": F.avg(F.abs(e)),
        "l2": F.sqrt(F.sum(F.pow(e, 2))),
        "l1": F.sum(F.abs(e)),
    }
    if loss not in aggs:
        raise ValueError(f"no such loss: {loss!r}")
    base = df.agg(aggs[loss].alias("v")).first()["v"]
    penalty = Penalty.of(regularization, alpha, l1_ratio, exclude_intercept)
    return base + float(penalty.value(np.asarray(beta, dtype=float)))


def loss_gradient(
    df: DataFrame,
    y: str,
    terms: Sequence[Column],
    beta: Sequence[float],
    loss: str = "mse",
    regularization: str | None = None,
    alpha: float = 0.0,
    l1_ratio: float = 0.5,
    exclude_intercept: bool = True,
) -> np.ndarray:
    """∂loss/∂β in one aggregate: mse 2/m Xᵀe; mae 1/m Xᵀsign(e); l2 Xᵀe/‖e‖; l1 Xᵀsign(e)."""
    from tessera.operators.regress import Penalty

    loss = loss.lower()
    if loss not in ("mse", "mae", "l1", "l2"):
        raise ValueError(f"no such loss: {loss!r}")
    e = linear_combination(0.0, beta, terms) - F.col(y)
    w = F.signum(e) if loss in ("mae", "l1") else e
    row = df.agg(
        F.count(F.lit(1)).alias("m"),
        F.sqrt(F.sum(F.pow(e, 2))).alias("norm"),
        *[F.sum(t * w).alias(f"g{i}") for i, t in enumerate(terms)],
    ).first()
    g = np.array([row[f"g{i}"] for i in range(len(terms))], dtype=float)
    m = row["m"]
    if loss == "mse":
        g = 2.0 / m * g
    elif loss == "mae":
        g = g / m
    elif loss == "l2":
        g = np.zeros_like(g) if row["norm"] < 1e-10 else g / row["norm"]
    beta = np.asarray(beta, dtype=float)
    return g + Penalty.of(regularization, alpha, l1_ratio, exclude_intercept).gradient(beta)


def coefficient_penalties(coefs: DataFrame, alpha: float, l1_ratio: float = 0.5, group_cols: Sequence[str] = ()) -> DataFrame:
    """Ridge, lasso and elastic-net penalties over a coefficient table
    ``(…group, term, coefficient)``, intercept excluded."""
    w = F.col("coefficient")
    sq = F.sum(F.pow(w, 2))
    ab = F.sum(F.abs(w))
    return (
        coefs.filter(F.col("term") != "intercept")
        .groupBy(*group_cols)
        .agg(
            (0.5 * alpha * sq).alias("ridge"),
            (alpha * ab).alias("lasso"),
            (alpha * l1_ratio * ab + 0.5 * alpha * (1 - l1_ratio) * sq).alias("elasticnet"),
        )
    )
