"""Metrics as aggregate Column builders.  Each metric carries its optimisation
direction instead of guessing it from the name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    name: str
    minimize: bool
    agg: Callable[[Column, Column], Column]  # (y, y_hat) -> aggregate Column

    def __call__(self, y: Column, p: Column) -> Column:
        return self.agg(y, p).alias(self.name)


def _mse(y: Column, p: Column) -> Column:
    return F.avg(F.pow(p - y, 2))


def _r2(y: Column, p: Column) -> Column:
    # 1 - SSres / SStot in one pass; constant y -> NULL (no division by zero).
    return 1 - F.try_divide(F.sum(F.pow(y - p, 2)), F.var_pop(y) * F.count(y))


def _mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(p - y))


def _l2(y: Column, p: Column) -> Column:
    return F.sqrt(F.sum(F.pow(p - y, 2)))


def _l1(y: Column, p: Column) -> Column:
    return F.sum(F.abs(p - y))


MSE = Metric("mse", True, _mse)
R2 = Metric("r2", False, _r2)
MAE = Metric("mae", True, _mae)
L2 = Metric("l2", True, _l2)
L1 = Metric("l1", True, _l1)

METRICS = {m.name: m for m in (MSE, R2, MAE, L2, L1)}


def get_metric(m: str | Metric) -> Metric:
    if isinstance(m, Metric):
        return m
    try:
        return METRICS[m.lower()]
    except KeyError:
        raise ValueError(f"unknown metric {m!r}; known: {sorted(METRICS)}") from None

