"""Projections, predicates, unit conversion, imputation and normalisation.

Stateful steps follow ``fit(df) -> frozen params`` + ``apply(df, params)``:
fitting is one aggregate job, applying is a projection with literals.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expr import dlit
from tessera.session import materialize

# Unit conversion factor (square feet to square metres).
SQFT_TO_M2 = 0.092903

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)

# Above this many groups a fitted group table is joined instead of inlined.
MAX_INLINE_GROUPS = 256
# Above this many groups the group table is not broadcast.
MAX_BROADCAST_GROUPS = 100_000
ROWS = "_group_rows"


# ------------------------------------------------------------ simple projections

def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Drop columns; absent names are ignored (single or multi-target)."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.drop(*[c for c in cols if c in df.columns])


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in set(exclude)
    ]


def select_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def convert_units(
    df: DataFrame,
    value_col: str = "area",
    unit_col: str = "area_units",
    factors: Mapping[str, float] | None = None,
) -> DataFrame:
    """Multiply ``value_col`` by the factor of its unit and drop the unit column.

    Units without a factor (and NULL units) leave the value unchanged.
    """
    if unit_col not in df.columns:
        raise ValueError(f"no unit column {unit_col!r} to convert by")
    factors = {"sqft": SQFT_TO_M2} if factors is None else dict(factors)
    expr = None
    for unit, factor in factors.items():
        cond = F.col(unit_col) == F.lit(unit)
        val = F.col(value_col) * dlit(factor)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    converted = F.col(value_col) if expr is None else expr.otherwise(F.col(value_col))
    return df.withColumn(value_col, converted).drop(unit_col)


def round_to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Round listed columns half-to-even to integers; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.rint(F.col(c)).cast("long") for c in present})


TARGET_TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "log": F.log,
    "exp": F.exp,
}


def target_transform(fn: str | Callable[[Column], Column] | None) -> Callable[[Column], Column] | None:
    if fn is None or callable(fn):
        return fn
    try:
        return TARGET_TRANSFORMS[fn]
    except KeyError:
        raise ValueError(f"unknown transform {fn!r}") from None


def transform_target(df: DataFrame, column: str, fn: str | Callable[[Column], Column]) -> DataFrame:
    """Forward or inverse target map (``'log'``, ``'exp'`` or Column -> Column)."""
    return df.withColumn(column, target_transform(fn)(F.col(column)))


# ------------------------------------------------------------------ imputation

def fit_mean(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Global column means (NULLs skipped) in one aggregate."""
    if not columns:
        return {}
    row = df.agg(*[F.avg(F.col(c)).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def impute_mean(df: DataFrame, means: Mapping[str, float | None]) -> DataFrame:
    """Fill NULL with the fitted global mean."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), dlit(m)) if m is not None else F.col(c) for c, m in means.items() if c in df.columns}
    )


@dataclass(frozen=True)
class GroupMeans:
    """Per-group means.  A group whose values are all NULL keeps NULL, and so do
    rows whose group is NULL, however many groups there are."""

    group_col: str
    columns: tuple[str, ...]
    table: DataFrame  # (group_col, *columns)
    inline: tuple[tuple, ...] | None = None  # collected rows when the table is small
    n_groups: int | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if self.inline is not None:
            out = {}
            for i, c in enumerate(self.columns):
                expr = None
                for row in self.inline:
                    g, m = row[0], row[1 + i]
                    if g is None or m is None:
                        continue
                    cond = F.col(self.group_col) == F.lit(g)
                    expr = F.when(cond, dlit(m)) if expr is None else expr.when(cond, dlit(m))
                if expr is not None and c in df.columns:
                    out[c] = F.coalesce(F.col(c), expr)
            return df.withColumns(out) if out else df
        means = self.table.select(
            F.col(self.group_col).alias("_grp"), F.col(ROWS), *[F.col(c).alias(f"_mean_{c}") for c in self.columns]
        )
        same = F.col(self.group_col) == F.col("_grp")
        if self.n_groups <= MAX_BROADCAST_GROUPS:
            return self._filled(df.join(F.broadcast(means), same, "left"))
        # fewer groups than the limit can hold more than this many rows each
        total = means.agg(F.sum(ROWS).alias("n")).first()["n"]
        large = F.col(ROWS) > total // MAX_BROADCAST_GROUPS
        heavy = F.broadcast(means.filter(large))
        there = self._filled(df.join(heavy, same, "inner"))
        # rows without a group have no mean to meet
        rest = df.join(heavy, same, "left_anti")
        ungrouped = rest.filter(F.col(self.group_col).isNull())
        tail = rest.filter(F.col(self.group_col).isNotNull()).join(means.filter(~large), same, "left")
        return there.unionByName(self._filled(tail)).unionByName(ungrouped)

    def _filled(self, joined: DataFrame) -> DataFrame:
        names = [c for c in self.columns if c in joined.columns]
        filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in names})
        return filled.drop("_grp", ROWS, *[f"_mean_{c}" for c in self.columns])


def fit_group_mean(df: DataFrame, columns: Sequence[str], group_col: str) -> GroupMeans:
    """Means per group: one aggregate with map-side partial aggregation.

    Many groups are written once, with their numbers of rows: applying them
    broadcasts the groups that hold a counted share of all rows and joins only
    the tail by shuffle, so no group meets in one task.
    """
    known = df.filter(F.col(group_col).isNotNull())
    means = known.groupBy(group_col).agg(*[F.avg(F.col(c)).alias(c) for c in columns], F.count(F.lit(1)).alias(ROWS))
    table = means.drop(ROWS)
    first = table.take(MAX_INLINE_GROUPS + 1)
    if len(first) <= MAX_INLINE_GROUPS:
        return GroupMeans(group_col, tuple(columns), table, tuple(tuple(r) for r in first), len(first))
    means = materialize(means)
    return GroupMeans(group_col, tuple(columns), means, None, means.count())


def impute_group_mean(df: DataFrame, columns: Sequence[str], group_col: str) -> DataFrame:
    """Fill NULL with the mean of the row's group (fit on ``df`` itself)."""
    return fit_group_mean(df, columns, group_col).apply(df)


# --------------------------------------------------------------- normalisation

@dataclass(frozen=True)
class NormParams:
    mean: dict[str, float]
    std: dict[str, float]
    binary: tuple[str, ...] = field(default_factory=tuple)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(self.mean[c]) if self.mean[c] is not None else None,
                 float(self.std[c]) if self.std[c] is not None else None) for c in self.mean]
        return spark.createDataFrame(rows, "feature string, mean double, std double")

    @staticmethod
    def from_df(df: DataFrame) -> "NormParams":
        rows = df.collect()
        return NormParams({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["std"] for r in rows})

    def columns(self, c: str) -> Column:
        return (F.col(c) - dlit(self.mean[c])) / dlit(self.std[c])


def binary_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns whose values are all in {0, 1}; a NULL makes a column non-binary."""
    if not columns:
        return []
    aggs = []
    for c in columns:
        aggs.append(F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(True)).alias(f"b_{c}"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_{c}"))
    row = df.agg(*aggs).first()
    return [c for c in columns if row[f"b_{c}"] and row[f"n_{c}"] == 0]


def moments(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> dict:
    """avg and stddev_samp of every column in one aggregate."""
    aggs = []
    for c in columns:
        aggs += [F.avg(F.col(c)).alias(f"m_{c}"), F.stddev_samp(F.col(c)).alias(f"s_{c}")]
    return df.agg(*aggs, *extra).first().asDict()


def fit_zscore(df: DataFrame, columns: Sequence[str], mode: str = "skip_binary") -> NormParams:
    """Fit z-score parameters.

    * ``skip_binary``: binary columns get (0, 1); std 0 -> 1.
    * ``all``: every column; std 0 -> 1 (the splitter's variant).
    * ``cv``: every column; std 0 -> 1e-8 (the cross-validation variant).
    """
    if mode not in ("skip_binary", "all", "cv"):
        raise ValueError(f"unknown normalisation mode {mode!r}")
    columns = list(columns)
    extra = []
    if mode == "skip_binary":
        for c in columns:
            extra.append(F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(True)).alias(f"b_{c}"))
            extra.append(F.count_if(F.col(c).isNull()).alias(f"n_{c}"))
    r = moments(df, columns, extra)
    zero_std = 1e-8 if mode == "cv" else 1.0
    mean, std, binary = {}, {}, []
    for c in columns:
        if mode == "skip_binary" and r[f"b_{c}"] and r[f"n_{c}"] == 0:
            mean[c], std[c] = 0.0, 1.0
            binary.append(c)
            continue
        s = r[f"s_{c}"]
        mean[c] = r[f"m_{c}"]
        std[c] = zero_std if s == 0 else s
    return NormParams(mean, std, tuple(binary))


def apply_params(df: DataFrame, params: NormParams) -> DataFrame:
    """Normalise with stored params, only the columns present in both."""
    cols = [c for c in df.columns if c in params.mean and c in params.std]
    return df.withColumns({c: params.columns(c) for c in cols})


def zscore_skip_binary(train: DataFrame, test: DataFrame, columns: Sequence[str]):
    params = fit_zscore(train, columns, "skip_binary")
    return apply_params(train, params), apply_params(test, params), params
