"""Column builders.  Everything here is a built-in Spark expression, so it stays
inside whole-stage codegen and works on streaming DataFrames too."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the Winitzki inverse-error-function approximation.
WINITZKI_A = 0.147


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dlit(v: float) -> Column:
    """A DOUBLE literal (never a DECIMAL one)."""
    return F.lit(float(v)).cast("double")


def round_even(c: str | Column) -> Column:
    """Round half to even, as an integer (``rint(2.5) = 2``)."""
    return F.rint(col_of(c)).cast("long")


def round_half_up(c: str | Column, digits: int) -> Column:
    """``round`` of a DOUBLE column, the same values: a decimal number is built
    only for values near a tie or too large to scale exactly enough."""
    x, unit = col_of(c), F.lit(10.0**digits)
    scaled = x * unit
    whole = F.rint(scaled)
    clear = (F.abs(scaled) < F.lit(2.0**42)) & (F.abs(scaled - whole) < F.lit(0.49))
    return F.when(clear, whole / unit + F.lit(0.0)).otherwise(F.round(x, digits))


def erfinv(y: str | Column) -> Column:
    """Inverse error function, Winitzki's approximation with a = 0.147."""
    y = col_of(y)
    ln = F.log(1 - y * y)
    t = 2 / (math.pi * WINITZKI_A) + ln / 2
    return F.signum(y) * F.sqrt(F.greatest(F.lit(0.0), F.sqrt(t * t - ln / WINITZKI_A) - t))


def normal_quantile(p: str | Column) -> Column:
    """Theoretical normal quantile sqrt(2) * erfinv(2p - 1)."""
    return math.sqrt(2.0) * erfinv(2 * col_of(p) - 1)


def display_name(c: str | Column) -> Column:
    """'has_pool' -> 'Pool', 'house_area' -> 'House Area'."""
    return F.initcap(F.replace(F.replace(col_of(c), F.lit("_"), F.lit(" ")), F.lit("has "), F.lit("")))


def poly_terms(features: Sequence[str], degree: int, base: dict[str, Column] | None = None) -> list[tuple[str, Column]]:
    """Degree-major polynomial terms without cross products: c, d, c^2, d^2, ...

    ``base`` optionally maps a feature name to the Column to raise (e.g. a
    normalised version of it).  The intercept is not included.
    """
    if degree < 1:
        raise ValueError("degree must be >= 1")
    base = base or {}
    terms = []
    for i in range(1, degree + 1):
        for c in features:
            x = base.get(c, F.col(c))
            name = c if i == 1 else f"{c}^{i}"
            terms.append((name, x if i == 1 else F.pow(x, F.lit(float(i)))))
    return terms


def linear_combination(intercept: float, coefs: Sequence[float], terms: Sequence[Column]) -> Column:
    """Σ as a balanced tree, so the expression's depth grows with the logarithm
    of the number of terms."""
    level = [dlit(intercept), *[dlit(b) * t for b, t in zip(coefs, terms)]]
    while len(level) > 1:
        level = [a + b for a, b in zip(level[::2], level[1::2])] + level[len(level) & ~1 :]
    return level[0]


def squared_distances(points: Sequence[Column], centers: Sequence[Sequence[float]]) -> list[Column]:
    """Squared Euclidean distance of the row's point to every centre."""
    out = []
    for c in centers:
        d = None
        for x, cj in zip(points, c):
            term = F.pow(x - dlit(cj), F.lit(2.0))
            d = term if d is None else d + term
        out.append(d)
    return out


def nearest_center(points: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre (0-based); ties go to the lowest index.

    A row with a NULL or NaN coordinate gets NULL.
    """
    dists = F.array(*squared_distances(points, centers))
    label = (F.array_position(dists, F.array_min(dists)) - 1).cast("int")
    any_null = None
    for x in points:
        gone = x.isNull() | F.isnan(x.cast("double"))
        any_null = gone if any_null is None else (any_null | gone)
    return F.when(any_null, F.lit(None).cast("int")).otherwise(label)


def distance_to_own_center(points: Sequence[Column], zone: Column, centers: Sequence[Sequence[float]]) -> Column:
    """Euclidean distance of the row's point to the centre of its own zone."""
    expr = None
    for z, d in enumerate(squared_distances(points, centers)):
        expr = F.when(zone == z, d) if expr is None else expr.when(zone == z, d)
    return F.sqrt(expr)

