"""Exact, seeded, layout-independent split and folds.

Order = md5('seed|key…'), then the key.  A split needs only the row at
position n_train of that order; folds need K-1 such rows.  Finding them is
two small jobs (bucket counts, then a rank inside the few buckets that hold
the cut positions); tagging rows is then a pure column expression, so neither
the split nor the folds shuffle the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.rank import hash_key, lex_le, rank_thresholds


def _order_cols(seed, key_cols: Sequence[str], h: Column | None = None) -> list[Column]:
    return [hash_key(seed, key_cols) if h is None else h, *[F.col(k) for k in key_cols]]


def _order_types(df: DataFrame, key_cols: Sequence[str]) -> list:
    return [T.StringType(), *[df.schema[k].dataType for k in key_cols]]


def _check_cuts(df: DataFrame, below: Sequence[Column], cuts: Sequence[int], key_cols: Sequence[str]) -> None:
    """Rows up to each cut must be as many as the cut says; rows that share a
    key fall on one side together and would change the sizes unseen."""
    got = df.agg(*[F.count_if(b).alias(f"c{i}") for i, b in enumerate(below)]).first()
    if list(got) != list(cuts):
        raise ValueError(f"the key {list(key_cols)} is not unique: {list(got)} rows up to cuts at {list(cuts)}")


def split_column(
    df: DataFrame,
    key_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    n: int | None = None,
    h: Column | None = None,
) -> Column:
    """Boolean Column: True for the test part.

    ``n_test = int(n * test_size)``; the first ``n - n_test`` rows of the
    seeded order are the training part.  ``h`` may name a column that
    already holds ``hash_key(seed, key_cols)`` (computed once, reused).
    """
    if not 0 <= test_size <= 1:
        raise ValueError("test_size must be in [0, 1]")
    n = df.count() if n is None else n
    n_test = int(n * test_size)
    n_train = n - n_test
    if n_test == 0:
        return F.lit(False)
    if n_train == 0:
        return F.lit(True)
    h = hash_key(seed, key_cols) if h is None else h
    (thr,) = rank_thresholds(df, h, key_cols, [n_train], n)
    below = lex_le(_order_cols(seed, key_cols, h), thr, _order_types(df, key_cols))
    _check_cuts(df, [below], [n_train], key_cols)
    return ~below


def train_test_split(
    df: DataFrame,
    key_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    split_col: str = "is_test",
) -> DataFrame:
    """Tag every row with ``split_col`` (True = test).  No copies, no shuffle."""
    return df.withColumn(split_col, split_column(df, key_cols, test_size, seed))


def fold_column(
    df: DataFrame, key_cols: Sequence[str], n_splits: int = 5, seed: int = 42, n: int | None = None, h: Column | None = None
) -> Column:
    """Integer fold id: ``fold = min((rank - 1) // (n // K), K - 1)``."""
    if n_splits < 2:
        raise ValueError("n_splits must be >= 2")
    n = df.count() if n is None else n
    if n < n_splits:
        raise ValueError(f"cannot make {n_splits} folds of {n} rows")
    fold_size = n // n_splits
    cuts = [fold_size * i for i in range(1, n_splits)]
    h = hash_key(seed, key_cols) if h is None else h
    thresholds = rank_thresholds(df, h, key_cols, cuts, n)
    order = _order_cols(seed, key_cols, h)
    types = _order_types(df, key_cols)
    below = [lex_le(order, thr, types) for thr in thresholds]
    _check_cuts(df, below, cuts, key_cols)
    fold = F.lit(0)
    for b in below:
        fold = fold + F.when(b, 0).otherwise(1)
    return fold.cast("int")


def kfold(df: DataFrame, key_cols: Sequence[str], n_splits: int = 5, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    return df.withColumn(fold_col, fold_column(df, key_cols, n_splits, seed))


def sample_n(df: DataFrame, key_cols: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, seeded: the n smallest of the hash order (TakeOrdered)."""
    return df.orderBy(*_order_cols(seed, key_cols)).limit(n)


def head_n(df: DataFrame, order_cols: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First rows of an explicit order."""
    return df.orderBy(*order_cols).limit(n)
