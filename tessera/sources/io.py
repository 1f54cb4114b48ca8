"""Scans and sinks.  NaN is turned into NULL on ingest: Spark aggregates skip
NULL but not NaN, and the semantics we follow treat a missing number as NULL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Schema of the house tables (header CSV, as inferred).
HOUSE_SCHEMA = T.StructType(
    [
        T.StructField("area", T.DoubleType()),
        T.StructField("area_units", T.StringType()),
        T.StructField("is_house", T.IntegerType()),
        T.StructField("has_pool", T.IntegerType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("rooms", T.DoubleType()),
    ]
)


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns (one projection)."""
    floats = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        and (columns is None or f.name in columns)
    }
    if not floats:
        return df
    return df.withColumns(
        {c: F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in floats}
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Header CSV -> DataFrame; empty cells are NULL; types from ``schema`` or inferred."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, ``{sf_dir}/{name}.parquet``."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Sink: parquet by default, CSV with a header row (no index column)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def open_frame(df: DataFrame | str) -> DataFrame:
    """``df`` itself, or the rows of a CSV file with a header or a Parquet table."""
    if not isinstance(df, str):
        return df
    spark = SparkSession.active()
    return read_csv(spark, df) if df.lower().endswith(".csv") else read_parquet(spark, df)


def load_xy(
    df: DataFrame | str,
    target: str,
    features: Sequence[str] | None = None,
    transform_target: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Pick features (default: all but the target) and the (optionally transformed) target.

    X and y stay in one DataFrame so rows never need re-aligning.  ``df`` may be
    the path of a CSV file with a header, or of a Parquet table.
    """
    df = open_frame(df)
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    feats = [c for c in df.columns if c != target] if features is None else list(features)
    y = transform_target(F.col(target)) if transform_target else F.col(target)
    return df.select(*feats, y.alias(target)), feats
