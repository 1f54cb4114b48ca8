"""Stateless scoring of streaming DataFrames with frozen parameters.

Every fitted step of the library becomes Column expressions with literals
(normalisation, polynomial terms, coefficients, nearest-centre labels), so the
same objects that score a batch DataFrame score a ``readStream`` one.  No
state store is involved: each micro-batch is scored independently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.kmeans import KMeansModel
from tessera.plans.training import FittedPipeline
from tessera.plans.prepare import FittedPrep


def score_stream(stream: DataFrame, pipeline: FittedPipeline, out: str = "prediction", original_scale: bool = True) -> DataFrame:
    """Add predictions to every row of a streaming (or batch) DataFrame."""
    return pipeline.transform(stream, out, original_scale=original_scale)


def zone_stream(stream: DataFrame, model: KMeansModel, points: Sequence[str | Column], out: str = "zone") -> DataFrame:
    """Label every row with its nearest fitted centre."""
    return model.predict(stream, points, out)


def prepare_stream(stream: DataFrame, prep: FittedPrep) -> DataFrame:
    """Apply a fitted preparation (zones, imputation, features, interactions)."""
    return prep.transform_all(stream)


def run_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Write a streaming DataFrame once over all available input, then stop.

    ``checkpoint`` must be a folder shared by the cluster (it holds the
    stream's offsets, so a restarted query resumes where it stopped).
    """
    query = (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
