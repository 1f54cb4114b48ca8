"""Blocks of numbers in Arrow batches, and their merging over a fixed tree.

An array column of doubles is a matrix whose values already lie one after the
other in the batch: :func:`matrix` reads it in place, with no Python object for
any value.  Partial results (factors, co-moments) are one small row per task;
:func:`tree_merged` combines them over a tree keyed by the partition number, so
that no task meets more than a bounded number of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 32
#: Partial results that one merge holds.
MERGE_BYTES = 256 << 20


def array_of(columns: Sequence[Column]) -> Column:
    """One array column of doubles, however many columns there are."""
    return F.array(*[c.cast("double") for c in columns])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows x width) doubles of an array column; NULL values arrive as NaN.

    Without NULLs this is a view of the batch's own buffer.
    """
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def by_group(column: pa.Array) -> Iterator[tuple[str | None, np.ndarray | slice]]:
    """(group, rows) of a string column; a batch of one group is not copied."""
    encoded = column.dictionary_encode()
    codes = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = encoded.dictionary.to_pylist()
    present = np.unique(codes)
    for code in present:
        rows = slice(None) if len(present) == 1 else np.flatnonzero(codes == code)
        yield (None if code < 0 else names[code]), rows


def tree_merged(
    partials: DataFrame, keys: Sequence[str], merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str, splits: int,
    row_bytes: int, fan_in: int = FAN_IN,
) -> DataFrame:
    """At most ``fan_in`` rows per key from rows per (key, ``_part``) of about
    ``splits`` tasks; ``merge`` joins the rows of a frame into one.

    Each level merges the rows whose partition numbers agree modulo the number
    of its slots; a merge meets about ``fan_in`` rows, fewer where that many
    would hold more than ``MERGE_BYTES``.
    """
    fan = max(2, min(fan_in, MERGE_BYTES // max(row_bytes, 1)))
    levels, slots = [], fan
    while slots < splits:
        levels.append(slots)
        slots *= fan
    for slots in reversed(levels):
        keyed = partials.withColumn("_part", F.col("_part") % slots)
        partials = keyed.groupBy(*keys, "_part").applyInPandas(merge, schema)
    return partials
