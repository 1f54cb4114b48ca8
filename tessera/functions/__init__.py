from tessera.functions.expr import (
    display_name,
    distance_to_own_center,
    erfinv,
    linear_combination,
    nearest_center,
    normal_quantile,
    poly_terms,
    round_even,
    squared_distances,
)
from tessera.functions.metrics import L1, L2, MAE, METRICS, MSE, R2, Metric, get_metric

__all__ = [
    "display_name",
    "distance_to_own_center",
    "erfinv",
    "linear_combination",
    "nearest_center",
    "normal_quantile",
    "poly_terms",
    "round_even",
    "squared_distances",
    "Metric",
    "METRICS",
    "MSE",
    "R2",
    "MAE",
    "L1",
    "L2",
    "get_metric",
]
