"""The data-preparation composite: cluster locations -> zone statistics ->
impute (per zone or global) -> engineered features -> zone interactions ->
split off the location part.

``fit_prepare`` learns every parameter once (k-means centres, imputation
means, nothing else is data-dependent) and returns a frozen
:class:`FittedPrep`; ``FittedPrep.transform`` is then a pure projection
(plus a literal CASE for zone means), so the same preparation applies to
test data, to single new rows and to streaming DataFrames.
:func:`process_dataset` without a fitted ``prep`` re-learns on the data it is
given (what the original workflow does for every table); with one it applies
the frozen parameters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import dlit, distance_to_own_center
from tessera.operators.features import (
    engineer_features,
    feature_stats,
    zone_interaction_columns,
    zone_stats,
)
from tessera.operators.kmeans import KMeansModel, kmeans_fit
from tessera.operators.prep import fit_mean
from tessera.session import staged

ZONE = "location_zone"

# Default interaction features of the original workflow.
DEFAULT_INTERACTIONS = ("area", "rooms", "age", "has_pool", "is_house")


def default_ops(location_cols: Sequence[str] | None, kmeans: KMeansModel | None) -> list[dict]:
    """pool_house, house_area and (with locations) the distance to the own centre."""
    ops = [
        {"name": "pool_house", "operation": lambda d: F.col("has_pool") * F.col("is_house")},
        {"name": "house_area", "operation": lambda d: F.col("area") * F.col("is_house")},
    ]
    if location_cols and kmeans is not None:
        ops.append(
            {
                "name": "dist_to_cluster_center",
                "operation": lambda d: distance_to_own_center([F.col(c) for c in location_cols], F.col(ZONE), kmeans.centers),
            }
        )
    return ops


@dataclass(frozen=True)
class FittedPrep:
    kmeans: KMeansModel | None
    location_cols: tuple[str, ...]
    impute_cols: tuple[str, ...]
    impute_by_zone: bool
    zone_means: tuple[tuple, ...]  # ((zone, mean_c1, mean_c2, …), …)
    global_means: tuple[tuple[str, float | None], ...]
    ops: tuple
    interactions: tuple[str, ...] | None

    def _impute(self, df: DataFrame) -> DataFrame:
        out = {}
        if self.impute_by_zone:
            for i, c in enumerate(self.impute_cols):
                expr = None
                for row in self.zone_means:
                    z, m = row[0], row[1 + i]
                    if m is None:
                        continue  # a zone with only NULLs stays NULL
                    cond = F.col(ZONE) == F.lit(z)
                    expr = F.when(cond, dlit(m)) if expr is None else expr.when(cond, dlit(m))
                if expr is not None:
                    out[c] = F.coalesce(F.col(c), expr)
        else:
            for c, m in self.global_means:
                if m is not None:
                    out[c] = F.coalesce(F.col(c), dlit(m))
        return df.withColumns(out) if out else df

    def transform_all(self, df: DataFrame) -> DataFrame:
        """Every output column, locations included (one projection chain, no job)."""
        if self.location_cols:
            df = df.withColumn(ZONE, self.kmeans.label([F.col(c) for c in self.location_cols]))
        df = self._impute(df)
        df = engineer_features(df, list(self.ops))
        if self.interactions is not None and self.location_cols:
            cols = zone_interaction_columns(df, self.interactions, ZONE, self.kmeans.k)
            if cols:
                df = df.withColumns(cols)
        return df

    def transform(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(features without locations, locations + zone)."""
        full = self.transform_all(df)
        if not self.location_cols:
            return full, None
        pos = full.select(*self.location_cols, ZONE)
        return full.drop(*self.location_cols), pos

    def new_feature_names(self, df: DataFrame) -> list[str]:
        full = self.transform_all(df)
        return [c for c in full.columns if c not in df.columns and c != ZONE]


def fit_prepare(df: DataFrame, **settings) -> FittedPrep:
    """Learn the parameters; see :func:`_fit` for the settings."""
    return _fit(df, **settings)[0]


def _fit(
    df: DataFrame,
    k: int = 2,
    location_cols: Sequence[str] | None = ("lat", "lon"),
    features_to_impute: Sequence[str] = ("age", "rooms"),
    impute_by_zone: bool = False,
    feature_ops: Sequence[dict] | None = None,
    create_zone_interactions: bool = False,
    zone_interaction_features: Sequence[str] = DEFAULT_INTERACTIONS,
    key_cols: Sequence[str] | None = None,
    kmeans_params: dict | None = None,
) -> tuple[FittedPrep, DataFrame | None]:
    """The frozen parameters, and the zone statistics where the imputation
    means were read from them (zone imputation)."""
    loc = tuple(location_cols or ())
    if impute_by_zone and not loc:
        raise ValueError("zone imputation needs location columns")
    km = kmeans_fit(df, list(loc), k=k, key_cols=key_cols, **(kmeans_params or {})) if loc else None
    zone_means: tuple = ()
    global_means: tuple = ()
    stats = None
    if features_to_impute:
        if impute_by_zone:
            stats = _zone_table(df, km, loc, features_to_impute)
            means = {(r[ZONE], r["feature"]): r["mean"] for r in stats.collect()}
            zones = sorted({z for z, _ in means})
            zone_means = tuple(tuple([z, *[means[z, c] for c in features_to_impute]]) for z in zones)
        else:
            global_means = tuple(fit_mean(df, list(features_to_impute)).items())
    ops = tuple(feature_ops) if feature_ops is not None else tuple(default_ops(loc, km))
    prep = FittedPrep(
        km,
        loc,
        tuple(features_to_impute),
        impute_by_zone,
        zone_means,
        global_means,
        ops,
        tuple(zone_interaction_features) if create_zone_interactions else None,
    )
    return prep, stats


def _zone_table(df: DataFrame, kmeans: KMeansModel, location_cols: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Zone statistics before imputation, as a small fixed table (at most one
    row per centre and feature)."""
    labelled = df.withColumn(ZONE, kmeans.label([F.col(c) for c in location_cols])).filter(F.col(ZONE).isNotNull())
    z = zone_stats(labelled, ZONE, list(features), kmeans.centers)
    return df.sparkSession.createDataFrame(z.collect(), z.schema)


@dataclass(frozen=True)
class PrepResult:
    df: DataFrame
    df_pos: DataFrame | None
    zone_stats: DataFrame | None
    feature_stats: DataFrame
    prep: FittedPrep


def process_dataset(
    df: DataFrame,
    prep: FittedPrep | None = None,
    save_path: str | None = None,
    **fit_kwargs,
) -> PrepResult:
    """Fit (unless ``prep`` is given) and apply the preparation.

    Zone statistics are taken before imputation; feature statistics cover the
    engineered features and the interactions.
    """
    spark = df.sparkSession
    with staged(df, by=fit_kwargs.get("key_cols")) as data:
        zs = None
        if prep is None:
            prep, zs = _fit(data, **fit_kwargs)
        if zs is None and prep.location_cols and prep.impute_cols:
            zs = _zone_table(data, prep.kmeans, prep.location_cols, prep.impute_cols)
        full, _ = prep.transform(data)
        new = [c for c in full.columns if c not in df.columns and c != ZONE]
        fs = None
        if new:
            f = feature_stats(full, new)
            fs = spark.createDataFrame(f.collect(), f.schema)
    out, pos = prep.transform(df)
    if save_path is not None:
        out.write.mode("overwrite").parquet(save_path)
    return PrepResult(out, pos, zs, fs, prep)
