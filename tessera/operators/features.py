"""Feature engineering as single projections (one ``withColumns`` each), plus
the per-feature and per-zone statistics that go with it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import distance_to_own_center, poly_terms
from tessera.operators.prep import numeric_columns
from tessera.operators.rank import grouped_quantiles
from tessera.session import materialize, wide_projection

# Centres of zones sent to every task (one short row each).
MAX_BROADCAST_CENTERS = 100_000

FeatureOp = Mapping[str, "str | Callable[[DataFrame], Column] | Column"]


def _op_column(df: DataFrame, op) -> Column:
    if isinstance(op, Column):
        return op
    if isinstance(op, str):
        return F.expr(op)
    if callable(op):
        return op(df)
    raise TypeError(f"unsupported feature operation {op!r}")


def engineer_features(df: DataFrame, ops: Sequence[FeatureOp]) -> DataFrame:
    """Add ``{name, operation}`` features in ONE projection.

    Every operation sees only the original columns (not earlier new ones);
    an operation is a SQL expression string, a Column, or ``df -> Column``.
    """
    names = [op["name"] for op in ops]
    dup = {n for n in names if names.count(n) > 1} | (set(names) & set(df.columns))
    if dup:
        raise ValueError(f"feature names already present: {sorted(dup)}")
    return df.withColumns({op["name"]: _op_column(df, op["operation"]) for op in ops})


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """mean, sample std, min, max of each feature, one row per feature.

    Aggregated in long form (feature, value) with one ``groupBy``: a single
    scan, and a few aggregation buffers regardless of the number of features
    (a wide ``agg`` of many features would pass whole-stage codegen's field limit).
    """
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])).alias("_s")
    ).select("_s.feature", "_s.v")
    return long.groupBy("feature").agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )


def product_features(
    df: DataFrame,
    products: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Products of columns; defaults pool_house = has_pool * is_house, house_area = area * is_house."""
    if products is None:
        products = {"pool_house": ("has_pool", "is_house"), "house_area": ("area", "is_house")}
    ops = []
    for name, cols in products.items():
        expr = None
        for c in cols:
            expr = F.col(c) if expr is None else expr * F.col(c)
        ops.append({"name": name, "operation": expr})
    return engineer_features(df, ops)


def dist_to_center(
    df: DataFrame,
    location_cols: Sequence[str],
    zone_col: str,
    centers: Sequence[Sequence[float]],
    out: str = "dist_to_cluster_center",
) -> DataFrame:
    """Euclidean distance of each row's location to the centre of its own zone."""
    return df.withColumn(
        out, distance_to_own_center([F.col(c) for c in location_cols], F.col(zone_col), centers)
    )


def zone_interaction_columns(
    df: DataFrame, features: Sequence[str], zone_col: str, n_zones: int
) -> dict[str, Column]:
    """``f_zone_z = f * (zone = z)``; NULL * 0 stays NULL, as in the source data model."""
    out = {}
    for f in features:
        if f not in df.columns:
            continue
        for z in range(n_zones):
            out[f"{f}_zone_{z}"] = F.col(f) * (F.col(zone_col) == z).cast("int")
    return out


def zone_interactions(df: DataFrame, features: Sequence[str], zone_col: str, n_zones: int) -> DataFrame:
    cols = zone_interaction_columns(df, features, zone_col, n_zones)
    return df.withColumns(cols) if cols else df


def power_feature_names(
    df: DataFrame, powers: Sequence[int] = range(1, 40), cap: int | None = None, exclude: Sequence[str] = ()
) -> list[tuple[str, str, int]]:
    """(name, column, power) in column-major order; ``cap`` keeps the first ones."""
    out = []
    for c in numeric_columns(df, exclude):
        for p in powers:
            if cap is not None and len(out) >= cap:
                return out
            out.append((f"{c}_power_{p}", c, p))
    return out


def power_features(
    df: DataFrame, powers: Sequence[int] = range(1, 40), cap: int | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """``c_power_k`` for each numeric column (target excluded via ``exclude``), one projection."""
    specs = power_feature_names(df, powers, cap, exclude)
    wide_projection(df.sparkSession)
    return df.withColumns({name: F.pow(F.col(c), F.lit(float(p))) for name, c, p in specs})


def poly_design(df: DataFrame, features: Sequence[str], degree: int, keep: Sequence[str] = ()) -> DataFrame:
    """Design matrix: intercept = 1, then degree-major powers, no cross terms."""
    terms = poly_terms(features, degree)
    return df.select(*keep, F.lit(1.0).alias("intercept"), *[c.alias(n) for n, c in terms])


def zone_stats(
    df: DataFrame,
    zone_col: str,
    features: Sequence[str],
    centers: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """Per zone x feature: mean, exact median, sample std, missing; per zone:
    size, percentage of all rows and centre.

    Two scans, one for the aggregates and one for the medians, in long form:
    nothing grows with the number of zones but the rows of the result.
    """
    spark = df.sparkSession
    values = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    long = df.select(zone_col, F.explode(values).alias("_s")).select(zone_col, "_s.feature", "_s.v")
    stats = materialize(
        long.groupBy(zone_col, "feature").agg(
            F.count(F.lit(1)).alias("size"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
            F.count_if(F.col("v").isNull()).alias("missing"),
        )
    )
    total = stats.filter(F.col("feature") == features[0]).agg(F.sum("size").alias("n")).first()["n"] or 0
    medians = grouped_quantiles(df, features, [0.5], zone_col).select(
        F.col("group").alias("_zone"), F.col("feature").alias("_feature"), F.col("value").alias("median")
    )
    same = F.col(zone_col).eqNullSafe(F.col("_zone")) & (F.col("feature") == F.col("_feature"))
    percentage = (F.col("size") / F.lit(total) * 100).alias("percentage")
    out = stats.join(medians, same, "left").select(zone_col, "size", percentage, "feature", "mean", "std", "missing", "median")
    if centers is not None:
        # one row per centre of a model that the driver holds
        cdf = spark.createDataFrame(
            [(z, [float(x) for x in c]) for z, c in enumerate(centers)], f"{zone_col} int, center array<double>"
        )
        if len(centers) <= MAX_BROADCAST_CENTERS:
            cdf = F.broadcast(cdf)
        out = out.join(cdf, zone_col, "left")
    return out
