"""Registered queries: one per operator of the inventory, each with a Spark
implementation over the driver tables and (where SQL can express it) the
equivalent DuckDB SQL used as the correctness oracle.

Conventions shared by both sides:

* inputs are the house-like views of :mod:`tessera.sources.tables`;
* the seeded row order is md5('42|l_orderkey|l_partkey|l_suppkey|l_linenumber')
  then the key;
* per-row floats are rounded to fixed decimals; small result tables (fits,
  metrics) are rounded to 8 significant digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.expr import erfinv, round_half_up
from tessera.operators import diagnostics as dg
from tessera.operators import features as fe
from tessera.operators import prep as pr
from tessera.operators import profile as pf
from tessera.operators import split as sp
from tessera.operators.evaluate import coefficient_penalties, evaluate, loss_gradient, regularized_loss
from tessera.operators.kmeans import kmeans_fit, kmeans_fit_predict
from tessera.operators.regress import fit
from tessera.plans import select as sel
from tessera.plans.training import evaluate_new_data, predict_new_rows, train_and_evaluate
from tessera.plans.prepare import ZONE, process_dataset
from tessera.session import spread
from tessera.sources.io import load_xy
from tessera.sources.tables import (
    CUSTOMER_LOCATIONS_SQL,
    HOUSES_CONVERTED_SQL,
    LINEITEM_HOUSES_SQL,
    LINEITEM_KEY,
    customer_locations,
    embedding_points,
    lineitem_houses,
)

SEED = 42
LAM = '"lambda"'  # reserved word in DuckDB: quoted identifier
KEY = LINEITEM_KEY
KEYS_SQL = ", ".join(KEY)
ORDER_SQL = f"md5(concat_ws('|', '{SEED}', {KEYS_SQL})), {KEYS_SQL}"
SIG = 8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ----------------------------------------------------------- shared pieces

def sig(x: float | None, digits: int = SIG) -> float | None:
    if x is None or (isinstance(x, float) and not math.isfinite(x)):
        return None
    if x == 0:
        return 0.0
    return float(f"{x:.{digits - 1}e}")


def ssig(expr: str, digits: int = SIG) -> str:
    """SQL twin of :func:`sig`."""
    return (
        f"(CASE WHEN ({expr}) IS NULL OR isnan(({expr})::DOUBLE) THEN NULL WHEN ({expr}) = 0 THEN 0.0::DOUBLE "
        f"ELSE round(({expr})::DOUBLE, {digits} - 1 - CAST(floor(log10(abs(({expr})::DOUBLE))) AS INTEGER)) END)"
    )


def small(df: DataFrame, float_cols: list[str]) -> DataFrame:
    """Round a SMALL result (a few rows) to significant digits on the driver."""
    rows = df.collect()
    idx = {c: i for i, c in enumerate(df.columns)}
    out = []
    for r in rows:
        vals = list(r)
        for c in float_cols:
            vals[idx[c]] = sig(vals[idx[c]])
        out.append(tuple(vals))
    return df.sparkSession.createDataFrame(out, df.schema)


def houses(spark, sf) -> DataFrame:
    return lineitem_houses(spark, sf)


def conv(spark, sf) -> DataFrame:
    return pr.convert_units(lineitem_houses(spark, sf))


def r(c: str | Column, d: int) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, d)


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


HOUSES = f"houses AS ({LINEITEM_HOUSES_SQL})"
CONV = f"conv AS ({HOUSES_CONVERTED_SQL})"
CUST = f"cust AS ({CUSTOMER_LOCATIONS_SQL})"


def split_cte(src: str = "conv", test_size: float = 0.2) -> str:
    return (
        f"split AS (SELECT *, rn > n - CAST(floor(n * {test_size}::DOUBLE) AS BIGINT) AS is_test FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) AS rn, count(*) OVER () AS n FROM {src}))"
    )


def fold_cte(src: str = "conv", k: int = 5) -> str:
    return (
        f"folded AS (SELECT *, CAST(least((rn - 1) // (n // {k}), {k - 1}) AS INTEGER) AS fold FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) AS rn, count(*) OVER () AS n FROM {src}))"
    )


HOUSE_COLS = ["area", "area_units", "is_house", "has_pool", "age", "rooms", "price", "lat", "lon"]
HOUSE_NUM = ["area", "is_house", "has_pool", "age", "rooms", "price", "lat", "lon"]


# ------------------------------------------------------- 2.1 sources, access

@query("scan_houses", f"{LINEITEM_HOUSES_SQL}")
def q_scan(spark, sf):
    return houses(spark, sf)


@query("load_xy", W(HOUSES, CONV) + "SELECT area, age, rooms, round(ln(price), 9) AS price FROM conv")
def q_load_xy(spark, sf):
    df, _ = load_xy(conv(spark, sf), "price", ["area", "age", "rooms"], F.log)
    return df.withColumn("price", r("price", 9))


@query("sample_n", W(HOUSES) + f"SELECT * FROM houses ORDER BY {ORDER_SQL} LIMIT 5")
def q_sample(spark, sf):
    return sp.sample_n(houses(spark, sf), KEY, 5, SEED)


@query("head_n", W(HOUSES) + f"SELECT * FROM houses ORDER BY {KEYS_SQL} LIMIT 5")
def q_head(spark, sf):
    return sp.head_n(houses(spark, sf), KEY, 5)


# ------------------------------------------- 2.2 projections and predicates

@query("project", W(HOUSES) + "SELECT area, price FROM houses")
def q_project(spark, sf):
    return pr.project(houses(spark, sf), ["area", "price"])


@query("drop_columns", W(HOUSES) + f"SELECT {KEYS_SQL}, area, is_house, has_pool, age, rooms, price FROM houses")
def q_drop(spark, sf):
    return pr.drop_columns(houses(spark, sf), ["lat", "lon", "area_units", "not_there"])


@query("filter_eq", W(HOUSES) + "SELECT * FROM houses WHERE is_house = 1")
def q_filter(spark, sf):
    return pr.filter_eq(houses(spark, sf), "is_house", 1)


@query("select_numeric", W(HOUSES) + f"SELECT {KEYS_SQL}, area, is_house, has_pool, age, rooms, price, lat, lon FROM houses")
def q_numeric(spark, sf):
    return pr.select_numeric(houses(spark, sf))


@query("convert_units", W(HOUSES, CONV) + "SELECT * FROM conv")
def q_convert(spark, sf):
    return conv(spark, sf)


@query(
    "round_to_int",
    W(HOUSES) + f"SELECT {KEYS_SQL}, CAST(round_even(area / 2, 0) AS BIGINT) AS half_area, "
    "CAST(round_even(price, 0) AS BIGINT) AS price FROM houses",
)
def q_round(spark, sf):
    df = houses(spark, sf).select(*KEY, (F.col("area") / 2).alias("half_area"), "price")
    return pr.round_to_int(df, ["half_area", "price", "absent"])


@query(
    "transform_target",
    W(HOUSES, CONV) + f"SELECT {KEYS_SQL}, round(ln(price), 9) AS log_price, round(exp(ln(price)), 6) AS back FROM conv",
)
def q_transform(spark, sf):
    df = pr.transform_target(conv(spark, sf), "price", "log")
    return df.select(*KEY, r("price", 9).alias("log_price"), r(F.exp("price"), 6).alias("back"))


# ------------------------------------------------------------ 2.3 profiling

def _describe_sql() -> str:
    parts = []
    for i, c in enumerate(HOUSE_COLS):
        if c == "area_units":
            parts.append(
                f"SELECT '{c}' AS column, {i} AS position, count({c}) AS count, count(DISTINCT {c}) AS unique, "
                f"(SELECT {c} FROM houses WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
                f"(SELECT count(*) FROM houses WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq, "
                "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, "
                "NULL::DOUBLE AS p75, NULL::DOUBLE AS max FROM houses"
            )
        else:
            x = f"{c}::DOUBLE"
            parts.append(
                f"SELECT '{c}' AS column, {i} AS position, count({c}) AS count, NULL::BIGINT AS unique, NULL::VARCHAR AS top, "
                f"NULL::BIGINT AS freq, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
                f"round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50, "
                f"round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM houses"
            )
    return W(HOUSES) + "\nUNION ALL\n".join(parts)


@query("describe_all", _describe_sql())
def q_describe(spark, sf):
    d = pf.describe_all(houses(spark, sf).select(*HOUSE_COLS))
    return d.select(*[r(c, 6).alias(c) if c in ("mean", "std", "min", "p25", "p50", "p75", "max") else c for c in d.columns])


@query(
    "null_counts",
    W(HOUSES)
    + "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM houses" for c in HOUSE_COLS)
    + ") WHERE nulls > 0",
)
def q_nulls(spark, sf):
    return pf.null_counts(houses(spark, sf).select(*HOUSE_COLS))


@query(
    "null_cells_total",
    W(HOUSES) + "SELECT CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in HOUSE_COLS) + " AS BIGINT) AS null_cells FROM houses",
)
def q_null_cells(spark, sf):
    return pf.null_cells_total(houses(spark, sf).select(*HOUSE_COLS))


@query(
    "rows_with_null",
    W(HOUSES) + "SELECT count(*) FILTER (WHERE " + " OR ".join(f"{c} IS NULL" for c in HOUSE_COLS) + ") AS rows_with_null FROM houses",
)
def q_rows_null(spark, sf):
    return pf.rows_with_null(houses(spark, sf).select(*HOUSE_COLS))


def _corr_sql() -> str:
    parts = []
    for a in HOUSE_NUM:
        for b in HOUSE_NUM:
            x, y = sorted([a, b], key=HOUSE_NUM.index)
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({x}::DOUBLE, {y}::DOUBLE), 9) AS r FROM houses")
    return W(HOUSES) + "\nUNION ALL\n".join(parts)


@query("corr_matrix", _corr_sql())
def q_corr(spark, sf):
    return pf.corr_matrix(houses(spark, sf), HOUSE_NUM).withColumn("r", r("r", 9))


@query(
    "histogram",
    W(HOUSES, "rg AS (SELECT min(price) AS lo, max(price) AS hi FROM houses)",
      "b AS (SELECT CAST(least(floor((price - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, count(*) AS count "
      "FROM houses, rg WHERE price IS NOT NULL GROUP BY 1)")
    + "SELECT bin, round(lo + bin * ((hi - lo) / 10), 6) AS lo, round(lo + (bin + 1) * ((hi - lo) / 10), 6) AS hi, count, "
    "round(count / (sum(count) OVER () * ((hi - lo) / 10)), 12) AS density FROM b, rg",
)
def q_hist(spark, sf):
    h = pf.histogram(houses(spark, sf), "price", 10)
    return h.select("bin", r("lo", 6).alias("lo"), r("hi", 6).alias("hi"), "count", r("density", 12).alias("density"))


@query(
    "kde_grid",
    W(HOUSES,
      "st AS (SELECT min(price) AS lo, max(price) AS hi, count(price) AS n, stddev_samp(price) * pow(count(price), -0.2) AS h FROM houses)",
      "g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * ((hi - lo) / 99) AS x FROM range(100) t(i), st)")
    + "SELECT g.i, round(g.x, 6) AS x, round(sum(exp(-0.5 * pow((g.x - price) / h, 2))) * (1.0 / (n * h * sqrt(2 * pi()))), 12) AS density "
    "FROM g, houses, st WHERE price IS NOT NULL GROUP BY g.i, g.x, n, h",
)
def q_kde(spark, sf):
    k = pf.kde_grid(houses(spark, sf), "price", 100)
    return k.select("i", r("x", 6).alias("x"), r("density", 12).alias("density"))


@query(
    "binned_scatter",
    W(HOUSES, "rg AS (SELECT min(area) AS xl, max(area) AS xh, min(price) AS yl, max(price) AS yh FROM houses)")
    + "SELECT CAST(least(floor((area - xl) / (xh - xl) * 10), 9) AS INTEGER) AS bx, "
    "CAST(least(floor((price - yl) / (yh - yl) * 10), 9) AS INTEGER) AS by, is_house, count(*) AS count "
    "FROM houses, rg WHERE area IS NOT NULL AND price IS NOT NULL GROUP BY ALL",
)
def q_binned(spark, sf):
    return pf.binned_scatter(houses(spark, sf), "area", "price", 10, hue="is_house")


# ------------------------------------------- 2.4 imputation, normalisation

@query(
    "impute_mean",
    W(HOUSES, CONV, "m AS (SELECT avg(age) AS ma, avg(rooms) AS mr FROM conv)")
    + f"SELECT {KEYS_SQL}, round(coalesce(age, ma), 9) AS age, round(coalesce(rooms, mr), 9) AS rooms FROM conv, m",
)
def q_impute_mean(spark, sf):
    df = conv(spark, sf)
    out = pr.impute_mean(df, pr.fit_mean(df, ["age", "rooms"]))
    return out.select(*KEY, r("age", 9).alias("age"), r("rooms", 9).alias("rooms"))


@query(
    "impute_group_mean",
    W(HOUSES, CONV)
    + f"SELECT {KEYS_SQL}, is_house, round(coalesce(age, avg(age) OVER (PARTITION BY is_house)), 9) AS age, "
    "round(coalesce(rooms, avg(rooms) OVER (PARTITION BY is_house)), 9) AS rooms FROM conv",
)
def q_impute_group(spark, sf):
    out = pr.impute_group_mean(conv(spark, sf), ["age", "rooms"], "is_house")
    return out.select(*KEY, "is_house", r("age", 9).alias("age"), r("rooms", 9).alias("rooms"))


@query(
    "binary_columns",
    W(HOUSES, CONV)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column FROM conv HAVING coalesce(bool_and({c} IN (0, 1)), true) AND count(*) FILTER (WHERE {c} IS NULL) = 0"
        for c in ["area", "is_house", "has_pool", "age", "rooms", "price", "lat", "lon"]
    ),
)
def q_binary(spark, sf):
    cols = pr.binary_columns(conv(spark, sf), ["area", "is_house", "has_pool", "age", "rooms", "price", "lat", "lon"])
    return spark.createDataFrame([(c,) for c in cols], "column string")


Z_FEATS = ["area", "is_house", "has_pool", "age"]


def _zscore_sql(mode: str) -> str:
    stats = []
    cols = []
    for c in Z_FEATS:
        stats.append(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}, "
                     f"coalesce(bool_and({c} IN (0, 1)), true) AND count(*) FILTER (WHERE {c} IS NULL) = 0 AS b_{c}")
        if mode == "skip_binary":
            mean = f"CASE WHEN b_{c} THEN 0.0 ELSE m_{c} END"
            std = f"CASE WHEN b_{c} THEN 1.0 WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END"
        else:
            mean = f"m_{c}"
            std = f"CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END"
        cols.append(f"round(({c} - ({mean})) / ({std}), 7) AS {c}")
    return (
        W(HOUSES, CONV, split_cte(), "st AS (SELECT " + ", ".join(stats) + " FROM split WHERE NOT is_test)")
        + f"SELECT {KEYS_SQL}, " + ", ".join(cols) + ", is_test FROM split, st"
    )


def _zscore(spark, sf, mode):
    s = sp.train_test_split(conv(spark, sf), KEY, 0.2, SEED)
    params = pr.fit_zscore(s.filter(~F.col("is_test")), Z_FEATS, mode)
    out = pr.apply_params(s, params)
    return out.select(*KEY, *[r(c, 7).alias(c) for c in Z_FEATS], "is_test")


@query("zscore_skip_binary", _zscore_sql("skip_binary"))
def q_z_skip(spark, sf):
    return _zscore(spark, sf, "skip_binary")


@query("zscore_all", _zscore_sql("all"))
def q_z_all(spark, sf):
    return _zscore(spark, sf, "all")


@query(
    "zscore_cv",
    W(HOUSES, CONV, fold_cte(), "ks AS (SELECT DISTINCT fold AS k FROM folded)")
    + " UNION ALL ".join(
        f"SELECT k AS fold, '{c}' AS feature, round(avg({c}), 9) AS mean, "
        f"round(CASE WHEN stddev_samp({c}) = 0 THEN 1e-8 ELSE stddev_samp({c}) END, 9) AS std "
        f"FROM ks JOIN folded ON folded.fold <> ks.k GROUP BY k"
        for c in ["area", "age", "lon"]
    ),
)
def q_z_cv(spark, sf):
    return sel.fold_norm_params(conv(spark, sf), ["area", "age", "lon"], KEY, 5, SEED).select(
        "fold", "feature", r("mean", 9).alias("mean"), r("std", 9).alias("std")
    )


@query(
    "apply_params",
    W(HOUSES, CONV, "st AS (SELECT avg(area) AS ma, stddev_samp(area) AS sa, avg(price) AS mp, stddev_samp(price) AS sp FROM conv)")
    + f"SELECT {KEYS_SQL}, round((area - ma) / sa, 6) AS area, area_units, round((price - mp) / sp, 6) AS price, age FROM houses, st",
)
def q_apply(spark, sf):
    params = pr.fit_zscore(conv(spark, sf), ["area", "price"], "all")
    out = pr.apply_params(houses(spark, sf), params)
    return out.select(*KEY, r("area", 6).alias("area"), "area_units", r("price", 6).alias("price"), "age")


# ------------------------------------------------------------ 2.5 splitting

@query("train_test_split", W(HOUSES, CONV, split_cte()) + f"SELECT {KEYS_SQL}, is_test FROM split")
def q_split(spark, sf):
    return sp.train_test_split(conv(spark, sf), KEY, 0.2, SEED).select(*KEY, "is_test")


@query("kfold", W(HOUSES, CONV, fold_cte()) + f"SELECT {KEYS_SQL}, fold FROM folded")
def q_kfold(spark, sf):
    return sp.kfold(conv(spark, sf), KEY, 5, SEED).select(*KEY, "fold")


# ------------------------------------------------------ 2.6 feature building

def eng_ops() -> list[dict]:
    """A SQL string, a DataFrame -> Column callable and a Column."""
    return [
        {"name": "area_x_house", "operation": "area * is_house"},
        {"name": "log_price", "operation": lambda d: F.log(F.col("price"))},
        {"name": "age_plus_rooms", "operation": F.col("age") + F.col("rooms")},
    ]


ENG_NAMES = ["area_x_house", "log_price", "age_plus_rooms"]


@query(
    "engineer_features",
    W(HOUSES, CONV)
    + f"SELECT {KEYS_SQL}, round(area * is_house, 9) AS area_x_house, round(ln(price), 9) AS log_price, "
    "round(age + rooms, 9) AS age_plus_rooms FROM conv",
)
def q_engineer(spark, sf):
    out = fe.engineer_features(conv(spark, sf), eng_ops())
    return out.select(*KEY, *[r(c, 9).alias(c) for c in ENG_NAMES])


@query(
    "feature_stats",
    W(HOUSES, CONV, "e AS (SELECT area * is_house AS area_x_house, ln(price) AS log_price, age + rooms AS age_plus_rooms FROM conv)")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std, round(min({c}), 8) AS min, "
        f"round(max({c}), 8) AS max FROM e"
        for c in ["area_x_house", "log_price", "age_plus_rooms"]
    ),
)
def q_feature_stats(spark, sf):
    out = fe.engineer_features(conv(spark, sf), eng_ops())
    st = fe.feature_stats(out, ENG_NAMES)
    return st.select("feature", *[r(c, 8).alias(c) for c in ("mean", "std", "min", "max")])


@query(
    "product_features",
    W(HOUSES, CONV) + f"SELECT {KEYS_SQL}, has_pool * is_house AS pool_house, round(area * is_house, 9) AS house_area FROM conv",
)
def q_products(spark, sf):
    out = fe.product_features(conv(spark, sf))
    return out.select(*KEY, "pool_house", r("house_area", 9).alias("house_area"))


def _power_sql() -> str:
    cols = [f"round(pow({e}, {p}), 12) AS {c}_power_{p}" for c, e in (("a", "lat / 10"), ("b", "lon / 10")) for p in range(1, 40)]
    return W(HOUSES, CONV) + f"SELECT {KEYS_SQL}, " + ", ".join(cols) + " FROM conv"


@query("power_features", _power_sql())
def q_powers(spark, sf):
    df = conv(spark, sf).select(*KEY, (F.col("lat") / 10).alias("a"), (F.col("lon") / 10).alias("b"), "price")
    out = fe.power_features(df, range(1, 40), exclude=[*KEY, "price"])
    names = [n for n, _, _ in fe.power_feature_names(df, range(1, 40), exclude=[*KEY, "price"])]
    return out.select(*KEY, *[round_half_up(c, 12).alias(c) for c in names])


@query(
    "poly_design",
    W(HOUSES, CONV)
    + f'SELECT {KEYS_SQL}, 1.0::DOUBLE AS intercept, round(area / 10, 9) AS a, round(lat, 9) AS b, round(pow(area / 10, 2), 9) AS "a^2", '
    'round(pow(lat, 2), 9) AS "b^2", round(pow(area / 10, 3), 9) AS "a^3", round(pow(lat, 3), 9) AS "b^3" FROM conv',
)
def q_poly_design(spark, sf):
    df = conv(spark, sf).select(*KEY, (F.col("area") / 10).alias("a"), F.col("lat").alias("b"))
    d = fe.poly_design(df, ["a", "b"], 3, keep=KEY)
    return d.select(*KEY, "intercept", *[r(F.col(f"`{c}`"), 9).alias(c) for c in ["a", "b", "a^2", "b^2", "a^3", "b^3"]])


# ---------------------------------------------------------- 2.7 clustering

KM_TOL = 1e-4


def kmeans_ctes(src: str, order_sql: str, coords: list[str], k: int, p: str, rounds: int = 20) -> tuple[list[str], str, str]:
    """CTE chain of Lloyd iterations with the stop rule (md5 init, lowest index
    on ties, empty cluster keeps its centre).  ``rounds`` lies beyond the
    iteration that stops: from there on the centres are handed on unchanged.
    Returns (ctes, final centres, final labels)."""
    d = len(coords)
    xs = ", ".join(f"{c} AS x{j}" for j, c in enumerate(coords))
    nn = " AND ".join(f"{c} IS NOT NULL" for c in coords)
    ctes = [
        f"{p}pts AS (SELECT *, {xs} FROM {src} WHERE {nn})",
        f"{p}c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {order_sql}) - 1 AS INTEGER) AS z, "
        + ", ".join(f"x{j}" for j in range(d))
        + f", false AS done FROM {p}pts ORDER BY {order_sql} LIMIT {k})",
    ]

    def pivot(t, name):
        return f"{name} AS MATERIALIZED (SELECT " + ", ".join(
            f"max(x{j}) FILTER (WHERE z = {i}) AS c{i}_{j}" for i in range(k) for j in range(d)
        ) + f" FROM {p}c{t})"

    def label():
        ds = ["(" + " + ".join(f"pow(x{j} - c{i}_{j}, 2)" for j in range(d)) + ")" for i in range(k)]
        m = "least(" + ", ".join(ds) + ")" if k > 1 else ds[0]
        return "CASE " + " ".join(f"WHEN {ds[i]} = {m} THEN {i}" for i in range(k)) + " END"

    for t in range(1, rounds + 1):
        ctes.append(pivot(t - 1, f"{p}w{t - 1}"))
        means = ", ".join(f"avg(x{j}) AS x{j}" for j in range(d))
        ctes.append(f"{p}m{t} AS MATERIALIZED (SELECT z, {means} FROM (SELECT {p}pts.*, {label()} AS z FROM {p}pts, {p}w{t - 1}) GROUP BY z)")
        keep = ", ".join(f"CASE WHEN c.done THEN c.x{j} ELSE coalesce(m.x{j}, c.x{j}) END AS x{j}" for j in range(d))
        shift = " + ".join(f"pow(coalesce(m.x{j}, c.x{j}) - c.x{j}, 2)" for j in range(d))
        ctes.append(
            f"{p}c{t} AS MATERIALIZED (SELECT c.z, {keep}, c.done OR sum({shift}) OVER () < {KM_TOL} AS done "
            f"FROM {p}c{t - 1} c LEFT JOIN {p}m{t} m ON c.z = m.z)"
        )
    ctes.append(pivot(rounds, f"{p}w"))
    ctes.append(f"{p}lab AS (SELECT {p}pts.*, {label()} AS z FROM {p}pts, {p}w)")
    return ctes, f"{p}c{rounds}", f"{p}lab"


CUST_ORDER = f"md5(concat_ws('|', '{SEED}', c_custkey)), c_custkey"
_cust_km, _cust_c, _cust_lab = kmeans_ctes("cust", CUST_ORDER, ["lat", "lon"], 3, "k")
_house_km, _house_c, _house_lab = kmeans_ctes("conv", ORDER_SQL, ["lat", "lon"], 2, "h")


def _cust_model(spark, sf):
    df = customer_locations(spark, sf)
    m = kmeans_fit(df, ["lat", "lon"], k=3, seed=SEED, key_cols=["c_custkey"])
    return df, m


def _house_model(spark, sf):
    df = conv(spark, sf)
    m = kmeans_fit(df, ["lat", "lon"], k=2, seed=SEED, key_cols=KEY)
    return df, m


@query(
    "kmeans_fit",
    W(CUST, *_cust_km, f"sz AS (SELECT z, count(*) AS size FROM {_cust_lab} GROUP BY z)")
    + f"SELECT c.z AS zone, coalesce(sz.size, 0) AS size, round(c.x0, 9) AS lat, round(c.x1, 9) AS lon "
    f"FROM {_cust_c} c LEFT JOIN sz ON c.z = sz.z",
)
def q_kmeans_fit(spark, sf):
    df, m = _cust_model(spark, sf)
    sizes = m.predict(df, ["lat", "lon"], "zone").groupBy("zone").agg(F.count(F.lit(1)).alias("size"))
    cen = spark.createDataFrame([(z, float(c[0]), float(c[1])) for z, c in enumerate(m.centers)], "zone int, lat double, lon double")
    return cen.join(sizes, "zone", "left").select(
        "zone", F.coalesce("size", F.lit(0)).alias("size"), r("lat", 9).alias("lat"), r("lon", 9).alias("lon")
    )


@query("kmeans_predict", W(CUST, *_cust_km) + f"SELECT c_custkey, z AS zone FROM {_cust_lab}")
def q_kmeans_predict(spark, sf):
    df, m = _cust_model(spark, sf)
    return m.predict(df, ["lat", "lon"], "zone").select("c_custkey", "zone")


@query(
    "kmeans_fit_predict",
    W(CUST, *_cust_km) + f"SELECT z AS zone, count(*) AS size FROM {_cust_lab} GROUP BY z",
)
def q_kmeans_fit_predict(spark, sf):
    _, out = kmeans_fit_predict(customer_locations(spark, sf), ["lat", "lon"], "zone", k=3, seed=SEED, key_cols=["c_custkey"])
    return out.groupBy("zone").agg(F.count(F.lit(1)).alias("size"))


# two of the three starting centres coincide, so one cluster stays empty
_EMPTY_INIT = [[0.0, 0.0], [0.0, 0.0], [500.0, 500.0]]
_empty_km, _empty_c, _ = kmeans_ctes("cust", CUST_ORDER, ["lat", "lon"], 3, "y")
_empty_km[1] = "yc0 AS MATERIALIZED (SELECT * FROM (VALUES " + ", ".join(
    f"({z}, {c[0]}::DOUBLE, {c[1]}::DOUBLE, false)" for z, c in enumerate(_EMPTY_INIT)
) + ") t(z, x0, x1, done))"


@query("kmeans_empty_cluster", W(CUST, *_empty_km) + f"SELECT z AS zone, round(x0, 9) AS lat, round(x1, 9) AS lon FROM {_empty_c}")
def q_kmeans_empty(spark, sf):
    m = kmeans_fit(customer_locations(spark, sf), ["lat", "lon"], k=3, init=_EMPTY_INIT)
    rows = [(z, float(c[0]), float(c[1])) for z, c in enumerate(m.centers)]
    return spark.createDataFrame(rows, "zone int, lat double, lon double").select("zone", r("lat", 9).alias("lat"), r("lon", 9).alias("lon"))


EMB_DIM = 64


def _wide_kmeans_sql(k: int = 10, rounds: int = 60) -> str:
    """Lloyd iterations over points and centres as lists, one small table each:
    no column per coordinate, so any number of rounds stays cheap to plan."""
    order = f"md5(concat_ws('|', '{SEED}', vec_id)), vec_id"
    ctes = [
        "pts AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {order}) - 1 AS z, v, false AS done FROM pts ORDER BY {order} LIMIT {k})",
    ]

    def label(t: int) -> str:
        return (
            "SELECT vec_id, v, z FROM (SELECT p.vec_id, p.v, c.z, row_number() OVER (PARTITION BY p.vec_id "
            f"ORDER BY list_distance(p.v, c.v), c.z) AS near FROM pts p CROSS JOIN c{t} c) WHERE near = 1"
        )

    for t in range(1, rounds + 1):
        ctes.append(
            f"m{t} AS MATERIALIZED (SELECT z, list(x ORDER BY j) AS v FROM (SELECT z, j, avg(x) AS x FROM "
            f"(SELECT z, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM ({label(t - 1)})) GROUP BY z, j) GROUP BY z)"
        )
        moved = "coalesce(m.v, c.v)"
        ctes.append(
            f"c{t} AS MATERIALIZED (SELECT c.z, CASE WHEN c.done THEN c.v ELSE {moved} END AS v, "
            f"c.done OR sum(pow(list_distance({moved}, c.v), 2)) OVER () < {KM_TOL} AS done "
            f"FROM c{t - 1} c LEFT JOIN m{t} m ON c.z = m.z)"
        )
    ctes.append(f"sz AS (SELECT z, count(*) AS size FROM ({label(rounds)}) GROUP BY z)")
    return (
        W(*ctes) + "SELECT CAST(c.z AS INTEGER) AS zone, coalesce(sz.size, 0) AS size, "
        + ", ".join(f"round(c.v[{j + 1}], 9) AS c{j}" for j in range(EMB_DIM))
        + f" FROM c{rounds} c LEFT JOIN sz ON c.z = sz.z"
    )


@query("kmeans_wide", _wide_kmeans_sql())
def q_kmeans_wide(spark, sf):
    df = embedding_points(spark, sf)
    pts = [F.col("embedding").getItem(j).cast("double") for j in range(EMB_DIM)]
    m = kmeans_fit(df, pts, k=10, seed=SEED, key_cols=["vec_id"])
    sizes = m.predict(df, pts, "zone").groupBy("zone").agg(F.count(F.lit(1)).alias("size"))
    names = [f"c{j}" for j in range(EMB_DIM)]
    cen = spark.createDataFrame([(z, *map(float, c)) for z, c in enumerate(m.centers)], "zone int, " + ", ".join(f"{c} double" for c in names))
    return cen.join(sizes, "zone", "left").select(
        "zone", F.coalesce("size", F.lit(0)).alias("size"), *[r(c, 9).alias(c) for c in names]
    )


def _zone_centre_sql() -> str:
    return ", ".join(f"round(max(CASE z WHEN 0 THEN c0_{j} WHEN 1 THEN c1_{j} END), 9) AS center_{j}" for j in range(2))


def _own_dist_sql(lab: str, cen_pivot: str, k: int, coords=("lat", "lon")) -> str:
    parts = " ".join(
        f"WHEN {i} THEN " + " + ".join(f"pow({c} - c{i}_{j}, 2)" for j, c in enumerate(coords)) for i in range(k)
    )
    return f"sqrt(CASE z {parts} END)"


@query(
    "dist_to_center",
    W(CUST, *_cust_km)
    + f"SELECT c_custkey, z AS zone, round({_own_dist_sql('', '', 3)}, 9) AS dist FROM {_cust_lab}, kw",
)
def q_dist(spark, sf):
    df, m = _cust_model(spark, sf)
    out = fe.dist_to_center(m.predict(df, ["lat", "lon"], "zone"), ["lat", "lon"], "zone", m.centers, "dist")
    return out.select("c_custkey", "zone", r("dist", 9).alias("dist"))


@query(
    "zone_interactions",
    W(HOUSES, CONV, *_house_km)
    + f"SELECT {KEYS_SQL}, z AS location_zone, "
    + ", ".join(f"round({f} * CAST(z = {i} AS INTEGER), 9) AS {f}_zone_{i}" for f in ("area", "age") for i in range(2))
    + ", " + ", ".join(f"is_house * CAST(z = {i} AS INTEGER) AS is_house_zone_{i}" for i in range(2))
    + f" FROM {_house_lab}",
)
def q_zone_inter(spark, sf):
    df, m = _house_model(spark, sf)
    out = fe.zone_interactions(m.predict(df, ["lat", "lon"], ZONE), ["area", "age", "is_house", "absent"], ZONE, 2)
    names = [f"{f}_zone_{i}" for f in ("area", "age") for i in range(2)]
    return out.select(*KEY, ZONE, *[r(c, 9).alias(c) for c in names], "is_house_zone_0", "is_house_zone_1")


ZONE_STATS_SQL = W(HOUSES, CONV, *_house_km, f"tot AS (SELECT count(*) AS t FROM {_house_lab})") + " UNION ALL ".join(
    f"SELECT z AS location_zone, '{f}' AS feature, count(*) AS size, round(CAST(count(*) AS DOUBLE) / max(t) * 100, 9) AS percentage, "
    f"round(avg({f}), 9) AS mean, round(median({f}), 9) AS median, round(stddev_samp({f}), 9) AS std, "
    f"count(*) FILTER (WHERE {f} IS NULL) AS missing, {_zone_centre_sql()} FROM {_house_lab}, tot, hw GROUP BY z"
    for f in ("age", "rooms")
)


def _zone_rows(zs: DataFrame) -> DataFrame:
    return zs.select(
        ZONE, "feature", "size", r("percentage", 9).alias("percentage"), r("mean", 9).alias("mean"),
        r("median", 9).alias("median"), r("std", 9).alias("std"), "missing",
        *[r(F.col("center")[j], 9).alias(f"center_{j}") for j in range(2)],
    )


@query("zone_stats", ZONE_STATS_SQL)
def q_zone_stats(spark, sf):
    df, m = _house_model(spark, sf)
    return _zone_rows(fe.zone_stats(m.predict(df, ["lat", "lon"], ZONE), ZONE, ["age", "rooms"], m.centers))


PROC_INTER = ["area", "rooms", "age", "has_pool", "is_house", "house_area", "pool_house", "dist_to_cluster_center"]
PROC_INT_COLS = {"has_pool", "is_house", "pool_house"}


def _process_ctes() -> list[str]:
    return [HOUSES, CONV, *_house_km,
            f"zm AS (SELECT z, avg(age) AS ma, avg(rooms) AS mr FROM {_house_lab} GROUP BY z)",
            f"imp AS (SELECT l.* REPLACE (coalesce(l.age, zm.ma) AS age, coalesce(l.rooms, zm.mr) AS rooms) FROM {_house_lab} l JOIN zm ON l.z = zm.z)",
            f"eng AS (SELECT imp.*, has_pool * is_house AS pool_house, area * is_house AS house_area, "
            f"{_own_dist_sql('', '', 2)} AS dist_to_cluster_center FROM imp, hw)"]


def _process_sql() -> str:
    cols = [KEYS_SQL, "round(area, 9) AS area", "is_house", "has_pool", "round(age, 9) AS age", "round(rooms, 9) AS rooms",
            "round(price, 9) AS price", "z AS location_zone", "pool_house", "round(house_area, 9) AS house_area",
            "round(dist_to_cluster_center, 9) AS dist_to_cluster_center"]
    for f in PROC_INTER:
        for i in range(2):
            e = f"{f} * CAST(z = {i} AS INTEGER)"
            cols.append(f"{e} AS {f}_zone_{i}" if f in PROC_INT_COLS else f"round({e}, 9) AS {f}_zone_{i}")
    return W(*_process_ctes()) + "SELECT " + ", ".join(cols) + " FROM eng"


def _processed(spark, sf):
    return process_dataset(
        conv(spark, sf), k=2, location_cols=["lat", "lon"], features_to_impute=["age", "rooms"], impute_by_zone=True,
        create_zone_interactions=True, zone_interaction_features=PROC_INTER, key_cols=KEY,
        kmeans_params={"seed": SEED},
    )


@query("process_dataset", _process_sql())
def q_process(spark, sf):
    out = _processed(spark, sf).df
    dtypes = dict(out.dtypes)
    return out.select(*[r(c, 9).alias(c) if dtypes[c] == "double" else F.col(c) for c in out.columns])


@query("process_dataset_pos", W(*_process_ctes()) + "SELECT round(lat, 9) AS lat, round(lon, 9) AS lon, z AS location_zone FROM eng")
def q_process_pos(spark, sf):
    return _processed(spark, sf).df_pos.select(r("lat", 9).alias("lat"), r("lon", 9).alias("lon"), ZONE)


@query("process_dataset_zone_stats", ZONE_STATS_SQL)
def q_process_zone_stats(spark, sf):
    return _zone_rows(_processed(spark, sf).zone_stats)


PROC_NEW = ["pool_house", "house_area", "dist_to_cluster_center", *[f"{f}_zone_{i}" for f in PROC_INTER for i in range(2)]]


@query(
    "process_dataset_feature_stats",
    W(*_process_ctes(), "wide AS (SELECT *, " + ", ".join(f"{f} * CAST(z = {i} AS INTEGER) AS {f}_zone_{i}" for f in PROC_INTER for i in range(2)) + " FROM eng)")
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS std, "
        f"round(CAST(min({c}) AS DOUBLE), 8) AS min, round(CAST(max({c}) AS DOUBLE), 8) AS max FROM wide" for c in PROC_NEW
    ),
)
def q_process_feature_stats(spark, sf):
    st = _processed(spark, sf).feature_stats
    return st.select("feature", *[r(c, 8).alias(c) for c in ("mean", "std", "min", "max")])


# ---------------------------------------------------------- 2.8 regression

def ols2_ctes(src: str, x1: str, x2: str, y: str, alpha: str = "0.0", name: str = "fit", where: str = "TRUE") -> list[str]:
    """Least squares / ridge (unpenalised intercept) with two regressors by Cramer's rule."""
    return [
        f"{name}_m AS (SELECT count(*)::DOUBLE AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my, covar_pop({x1}, {x1}) AS c11, "
        f"covar_pop({x1}, {x2}) AS c12, covar_pop({x2}, {x2}) AS c22, covar_pop({x1}, {y}) AS c1y, covar_pop({x2}, {y}) AS c2y "
        f"FROM {src} WHERE {where} AND {x1} IS NOT NULL AND {x2} IS NOT NULL AND {y} IS NOT NULL)",
        f"{name}_s AS (SELECT *, n * c11 + {alpha} AS a11, n * c12 AS a12, n * c22 + {alpha} AS a22, n * c1y AS r1, n * c2y AS r2 FROM {name}_m)",
        f"{name} AS (SELECT *, (r1 * a22 - r2 * a12) / (a11 * a22 - a12 * a12) AS b1, (r2 * a11 - r1 * a12) / (a11 * a22 - a12 * a12) AS b2 FROM {name}_s)",
    ]


def coef_rows_sql(fit: str, t1: str, t2: str, p2: int = 1) -> str:
    return (
        f"SELECT 'intercept' AS term, 0 AS power, {ssig('my - b1 * m1 - b2 * m2')} AS coefficient FROM {fit} "
        f"UNION ALL SELECT '{t1}', 1, {ssig('b1')} FROM {fit} UNION ALL SELECT '{t2}', {p2}, {ssig('b2')} FROM {fit}"
    )


def _coef_df(spark, model) -> DataFrame:
    return small(model.coef_table(spark), ["coefficient"])


RIDGE_ALPHA = 1e6


@query("fit_ols", W(HOUSES, CONV, *ols2_ctes("conv", "area", "lon", "price")) + coef_rows_sql("fit", "area", "lon"))
def q_fit_ols(spark, sf):
    return _coef_df(spark, fit(conv(spark, sf), ["area", "lon"], "price"))


@query("coef_table", W(HOUSES, CONV, *ols2_ctes("conv", "lat", "lon", "price")) + coef_rows_sql("fit", "lat", "lon"))
def q_coef_table(spark, sf):
    return _coef_df(spark, fit(conv(spark, sf), ["lat", "lon"], "price"))


@query(
    "fit_ridge",
    W(HOUSES, CONV, *ols2_ctes("conv", "area", "lon", "price", f"{RIDGE_ALPHA}::DOUBLE")) + coef_rows_sql("fit", "area", "lon"),
)
def q_fit_ridge(spark, sf):
    return _coef_df(spark, fit(conv(spark, sf), ["area", "lon"], "price", regularization="l2", alpha=RIDGE_ALPHA))


@query(
    "fit_poly",
    W(HOUSES, CONV, "pc AS (SELECT lon, pow(lon, 2) AS lon2, price FROM conv)", *ols2_ctes("pc", "lon", "lon2", "price"))
    + coef_rows_sql("fit", "lon", "lon^2", 2),
)
def q_fit_poly(spark, sf):
    return _coef_df(spark, fit(conv(spark, sf), ["lon"], "price", degree=2))


@query(
    "fit_linear",
    W(HOUSES, CONV, "f AS (SELECT regr_intercept(price, area) AS b0, regr_slope(price, area) AS b1 FROM conv)")
    + f"SELECT 'intercept' AS term, 0 AS power, {ssig('b0')} AS coefficient FROM f UNION ALL SELECT 'area', 1, {ssig('b1')} FROM f",
)
def q_fit_linear(spark, sf):
    from tessera.operators.regress import fit_linear

    return _coef_df(spark, fit_linear(conv(spark, sf), ["area"], "price"))


GD_EPOCHS = 1000
GD_LR = 0.01
_GD_CTES = [
    HOUSES, CONV,
    "gm AS (SELECT count(*)::DOUBLE AS n, sum(lon) AS sx, sum(lon * lon) AS sxx, sum(y) AS sy, sum(lon * y) AS sxy, sum(y * y) AS syy "
    "FROM (SELECT lon, price / 1000 AS y FROM conv))",
    f"gd(epoch, b0, b1) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL SELECT epoch + 1, "
    f"b0 - {GD_LR} * (2 / n) * (n * b0 + sx * b1 - sy), b1 - {GD_LR} * (2 / n) * (sx * b0 + sxx * b1 - sxy) "
    f"FROM gd, gm WHERE epoch < {GD_EPOCHS})",
]
GD_WITH = "WITH RECURSIVE " + ",\n".join(_GD_CTES) + "\n"


def _gd_model(spark, sf):
    df = conv(spark, sf).withColumn("y", F.col("price") / 1000)
    return fit(df, ["lon"], "y", method="gradient_descent", learning_rate=GD_LR, epochs=GD_EPOCHS, tolerance=1e-300)


@query(
    "fit_gd",
    GD_WITH
    + f"SELECT 'intercept' AS term, 0 AS power, {ssig('b0')} AS coefficient FROM gd WHERE epoch = {GD_EPOCHS} "
    f"UNION ALL SELECT 'lon', 1, {ssig('b1')} FROM gd WHERE epoch = {GD_EPOCHS}",
)
def q_fit_gd(spark, sf):
    return _coef_df(spark, _gd_model(spark, sf))


@query(
    "loss_history",
    GD_WITH
    + f"SELECT CAST(epoch AS INTEGER) AS epoch, {ssig('(b0 * b0 * n + 2 * b0 * b1 * sx + b1 * b1 * sxx - 2 * b0 * sy - 2 * b1 * sxy + syy) / n')} AS loss "
    f"FROM gd, gm WHERE epoch < {GD_EPOCHS}",
)
def q_loss_history(spark, sf):
    return small(_gd_model(spark, sf).loss_history(spark), ["loss"])


def _descent_sql(loss: str, lr: float, epochs: int, w1: float = 0.0, w2: float = 0.0) -> str:
    """Subgradient descent of y on lon over the rows, recursively; the state after the epoch with the lowest loss counts."""
    base = {"mse": "avg(e * e)", "l2": "sqrt(sum(e * e))", "mae": "avg(abs(e))", "l1": "sum(abs(e))"}[loss]
    scale = {"mse": "2 * avg({})", "l2": "sum({}) / sqrt(sum(e * e))", "mae": "avg({})", "l1": "sum({})"}[loss]
    part = "sign(e)" if loss in ("mae", "l1") else "e"
    g0, g1 = scale.format(part), scale.format(f"{part} * lon")
    data = "d AS MATERIALIZED (SELECT lon / 100 AS lon, price / 1000 AS y FROM conv)"
    descent = (
        "gd(epoch, b0, b1, low, w0, w1) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL "
        "SELECT epoch + 1, n0, n1, least(low, v), CASE WHEN v < low THEN n0 ELSE w0 END, CASE WHEN v < low THEN n1 ELSE w1 END FROM ("
        f"SELECT epoch, low, w0, w1, {base} + {w1} * abs(b1) + {w2} * b1 * b1 / 2 AS v, "
        f"b0 - {lr} * ({g0}) AS n0, b1 - {lr} * ({g1} + {w1} * sign(b1) + {w2} * b1) AS n1 "
        f"FROM (SELECT gd.*, d.lon, b0 + b1 * lon - y AS e FROM d, gd WHERE epoch < {epochs}) GROUP BY epoch, b0, b1, low, w0, w1))"
    )
    last = f"FROM gd WHERE epoch = {epochs}"
    return "WITH RECURSIVE " + ",\n".join([HOUSES, CONV, data, descent]) + (
        f"\nSELECT 'intercept' AS term, 0 AS power, {ssig('w0')} AS coefficient {last} UNION ALL SELECT 'lon', 1, {ssig('w1')} {last}"
    )


# rate and penalty weights of each; ridge stops before its loss is level to the
# last bit, where the epoch of the lowest loss is a matter of rounding
DESCENTS = {
    "fit_gd_mae": ({"loss": "mae"}, 2.0, (0, 0)),
    "fit_gd_l1": ({"loss": "l1"}, 2e-4, (0, 0)),
    "fit_gd_l2": ({"loss": "l2"}, 0.5, (0, 0)),
    "fit_gd_ridge": ({"regularization": "l2", "alpha": 0.4, "epochs": 120}, 0.1, (0, 0.4)),
    "fit_gd_elasticnet": ({"regularization": "elasticnet", "alpha": 0.4, "l1_ratio": 0.25}, 0.1, (0.1, 0.3)),
}
DESCENT_EPOCHS = 1000


def _descent_query(name: str, params: dict, lr: float, weights: tuple) -> None:
    settings = {"method": "gradient_descent", "learning_rate": lr, "epochs": DESCENT_EPOCHS, "tolerance": 1e-300, **params}

    @query(name, _descent_sql(params.get("loss", "mse"), lr, settings["epochs"], *weights))
    def run(spark, sf):
        df = conv(spark, sf).select((F.col("lon") / 100).alias("lon"), (F.col("price") / 1000).alias("y"))
        return _coef_df(spark, fit(df, ["lon"], "y", **settings))


for _name, (_params, _lr, _weights) in DESCENTS.items():
    _descent_query(_name, _params, _lr, _weights)


@query(
    "fit_ols_rank_deficient",
    W(HOUSES, CONV, *ols2_ctes("conv", "area", "lon", "price"))
    + f"SELECT {KEYS_SQL}, round((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon, 3) AS prediction FROM conv, fit",
)
def q_rank_deficient(spark, sf):
    # the minimum-norm solution of three dependent regressors predicts what two do
    df = conv(spark, sf).withColumn("mix", 2 * F.col("lon") + F.col("area"))
    m = fit(df, ["area", "lon", "mix"], "price")
    return m.predict(df).select(*KEY, r("prediction", 3).alias("prediction"))


WIDE_MODEL = 300


@query(
    "fit_predict_wide",
    W(HOUSES, CONV, *ols2_ctes("conv", "area", "lon", "price"))
    + f"SELECT {KEYS_SQL}, round((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon, 3) AS prediction FROM conv, fit",
)
def q_fit_wide(spark, sf):
    # 300 dependent regressors span the same space as two; the rows are dealt
    # to the cores while they are narrow
    df = spread(conv(spark, sf), KEY)
    parts = {f"x{i}": F.col("area") * (1 + i % 7) + F.col("lon") * (i % 5) for i in range(WIDE_MODEL)}
    wide = df.withColumns(parts)
    m = fit(wide, list(parts), "price")
    return m.predict(wide).select(*KEY, r("prediction", 3).alias("prediction"))


@query(
    "predict",
    W(HOUSES, CONV, *ols2_ctes("conv", "area", "lon", "price"))
    + f"SELECT {KEYS_SQL}, round((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon, 4) AS prediction FROM conv, fit",
)
def q_predict(spark, sf):
    df = conv(spark, sf)
    m = fit(df, ["area", "lon"], "price")
    return m.predict(df).select(*KEY, r("prediction", 4).alias("prediction"))


# --------------------------------------------------- 2.9 metrics and losses

PRED_CTE = "pr AS (SELECT *, regr_intercept(price, area) OVER () + regr_slope(price, area) OVER () * area AS pred FROM conv)"
METRIC_SQL = {
    "mse": "avg(pow(pred - price, 2))",
    "r2": "1 - sum(pow(price - pred, 2)) / (var_pop(price) * count(price))",
    "mae": "avg(abs(pred - price))",
    "l2": "sqrt(sum(pow(pred - price, 2)))",
    "l1": "sum(abs(pred - price))",
}


def _scored(spark, sf):
    df = conv(spark, sf)
    return fit(df, ["area"], "price").predict(df, "pred")


def _metric_sql(names) -> str:
    return W(HOUSES, CONV, PRED_CTE) + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {ssig(METRIC_SQL[m])} AS value FROM pr" for m in names
    )


@query("evaluate", _metric_sql(["mse", "r2", "mae", "l2", "l1"]))
def q_evaluate(spark, sf):
    return small(evaluate(_scored(spark, sf), "price", "pred", ["mse", "r2", "mae", "l2", "l1"]), ["value"])


for _m in ["mse", "r2", "mae", "l2", "l1"]:
    def _mq(spark, sf, _m=_m):
        return small(evaluate(_scored(spark, sf), "price", "pred", [_m]), ["value"])

    query(f"metric_{_m}", _metric_sql([_m]))(_mq)


@query(
    "metric_mse_rounded",
    W(HOUSES, CONV, PRED_CTE) + f"SELECT 'mse' AS metric, {ssig('avg(pow(round_even(pred, 0) - price, 2))')} AS value FROM pr",
)
def q_mse_rounded(spark, sf):
    return small(evaluate(_scored(spark, sf), "price", "pred", ["mse"], round_prediction=True), ["value"])


@query(
    "metric_mse_multi",
    W(HOUSES, CONV, "pr AS (SELECT *, regr_intercept(price, area) OVER () + regr_slope(price, area) OVER () * area AS p1, "
      "regr_intercept(lat, lon) OVER () + regr_slope(lat, lon) OVER () * lon AS p2 FROM conv)")
    + f"SELECT {ssig('(avg(pow(p1 - price, 2)) + avg(pow(p2 - lat, 2))) / 2')} AS mse FROM pr",
)
def q_mse_multi(spark, sf):
    from tessera.operators.evaluate import multi_target_mse

    df = conv(spark, sf)
    df = fit(df, ["area"], "price").predict(df, "p1")
    df = fit(df, ["lon"], "lat").predict(df, "p2")
    return small(df.agg(multi_target_mse(df, [("price", "p1"), ("lat", "p2")])), ["mse"])


PEN_ALPHA, PEN_RATIO = 0.5, 0.3


def _ridge_model(spark, sf):
    return fit(conv(spark, sf), ["area", "lon"], "price", regularization="l2", alpha=RIDGE_ALPHA)


_RIDGE = ols2_ctes("conv", "area", "lon", "price", f"{RIDGE_ALPHA}::DOUBLE")


@query(
    "penalties",
    W(HOUSES, CONV, *_RIDGE)
    + f"SELECT {ssig(f'0.5 * {PEN_ALPHA} * (b1 * b1 + b2 * b2)')} AS ridge, {ssig(f'{PEN_ALPHA} * (abs(b1) + abs(b2))')} AS lasso, "
    + ssig(f"{PEN_ALPHA} * {PEN_RATIO} * (abs(b1) + abs(b2)) + 0.5 * {PEN_ALPHA} * (1 - {PEN_RATIO}) * (b1 * b1 + b2 * b2)")
    + " AS elasticnet FROM fit",
)
def q_penalties(spark, sf):
    coefs = _ridge_model(spark, sf).coef_table(spark)
    return small(coefficient_penalties(coefs, PEN_ALPHA, PEN_RATIO), ["ridge", "lasso", "elasticnet"])


@query(
    "regularized_loss",
    W(HOUSES, CONV, *_RIDGE)
    + f"SELECT {ssig(f'avg(pow((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon - price, 2)) + 0.5 * {PEN_ALPHA} * (any_value(b1) * any_value(b1) + any_value(b2) * any_value(b2))')} AS loss "
    "FROM conv, fit",
)
def q_reg_loss(spark, sf):
    m = _ridge_model(spark, sf)
    beta = [m.intercept, *m.coef]
    v = regularized_loss(conv(spark, sf), "price", [F.lit(1.0), F.col("area"), F.col("lon")], beta, "mse", "l2", PEN_ALPHA)
    return spark.createDataFrame([(sig(v),)], "loss double")


@query(
    "loss_gradient",
    W(HOUSES, CONV, *_RIDGE, "e AS (SELECT area, lon, 0.5 * ((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon) - price AS err FROM conv, fit)")
    + " UNION ALL ".join(
        f"SELECT '{loss}' AS loss, '{t}' AS term, {ssig(g)} AS gradient FROM e"
        for loss, w in (("mse", "err"), ("mae", "sign(err)"))
        for t, x in (("intercept", "1"), ("area", "area"), ("lon", "lon"))
        for g in [f"{'2.0' if loss == 'mse' else '1.0'} / count(*) * sum({x} * {w})"]
    ),
)
def q_loss_grad(spark, sf):
    # evaluated at half the ridge vector, where no component is zero
    m = _ridge_model(spark, sf)
    beta = [0.5 * m.intercept, *[0.5 * b for b in m.coef]]
    df = conv(spark, sf)
    rows = []
    for loss in ("mse", "mae"):
        g = loss_gradient(df, "price", [F.lit(1.0), F.col("area"), F.col("lon")], beta, loss)
        rows += [(loss, t, sig(float(v))) for t, v in zip(("intercept", "area", "lon"), g)]
    return spark.createDataFrame(rows, "loss string, term string, gradient double")


# ------------------------------------------------ 2.10 pipelines, selection

def _split_metrics_sql(y_expr: str, inv: str) -> str:
    pred = "(my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon"
    yy, pp = (f"exp({y_expr})", f"exp({pred})") if inv == "exp" else (y_expr, pred)
    return (
        W(HOUSES, CONV, split_cte(), f"tr AS (SELECT *, {y_expr} AS yt FROM split)",
          *ols2_ctes("tr", "area", "lon", "yt", where="NOT is_test"),
          f"sc AS (SELECT {yy} AS y, {pp} AS p FROM tr, fit WHERE is_test)")
        + f"SELECT 'mse' AS metric, {ssig('avg(pow(p - y, 2))')} AS value FROM sc "
        f"UNION ALL SELECT 'r2', {ssig('1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y))')} FROM sc"
    )


@query("train_and_evaluate", _split_metrics_sql("price", ""))
def q_train_eval(spark, sf):
    res = train_and_evaluate(conv(spark, sf), "price", KEY, ["area", "lon"], 0.2, SEED, fit_params={"method": "pseudo_inverse"})
    return small(res.metrics, ["value"])


def _log_pipeline(spark, sf):
    df = conv(spark, sf)
    res = train_and_evaluate(df, "price", KEY, ["area", "lon"], 0.2, SEED, transform_target="log", inverse="exp",
                             fit_params={"method": "pseudo_inverse"})
    return res


@query("evaluate_new_data", _split_metrics_sql("ln(price)", "exp"))
def q_eval_new(spark, sf):
    res = _log_pipeline(spark, sf)
    test = res.data.filter(F.col(res.split_col))
    return small(evaluate_new_data(test, res.pipeline), ["value"])


@query(
    "predict_new_rows",
    W(HOUSES, CONV, split_cte(), "tr AS (SELECT *, ln(price) AS yt FROM split)", *ols2_ctes("tr", "area", "lon", "yt", where="NOT is_test"))
    + f"SELECT {KEYS_SQL}, round(exp((my - b1 * m1 - b2 * m2) + b1 * area + b2 * lon), 4) AS prediction FROM tr, fit WHERE is_test",
)
def q_predict_new(spark, sf):
    res = _log_pipeline(spark, sf)
    new = res.data.filter(F.col(res.split_col)).select(*KEY, "area", "lon")
    return predict_new_rows(new, res.pipeline).select(*KEY, r("prediction", 4).alias("prediction"))


# 200 weights, up to about twenty times the rows of a small table
SWEEP_LAMBDAS = [5000.0 * i for i in range(200)]


def _ridge_norm_ctes(src: str, stats_from: str, where: str, lambdas, group: str | None = None, zero: str = "1.0") -> list[str]:
    """Ridge on normalised (x - m)/s features, intercept = mean of y, per grid value (and group)."""
    g_sel = f"{group}, " if group else ""
    lam_rows = ", ".join(f"({i}, {float(v)}::DOUBLE)" for i, v in enumerate(lambdas))
    return [
        f"st AS (SELECT {g_sel}count(*)::DOUBLE AS n, avg(area) AS m1, CASE WHEN stddev_samp(area) = 0 THEN {zero} ELSE stddev_samp(area) END AS s1, "
        f"avg(lon) AS m2, CASE WHEN stddev_samp(lon) = 0 THEN {zero} ELSE stddev_samp(lon) END AS s2, avg(price) AS my, "
        f"covar_pop(area, area) AS c11, covar_pop(area, lon) AS c12, covar_pop(lon, lon) AS c22, covar_pop(area, price) AS c1y, "
        f"covar_pop(lon, price) AS c2y FROM {stats_from} WHERE {where} {'GROUP BY ' + group if group else ''})",
        f"lam AS (SELECT * FROM (VALUES {lam_rows}) t(position, {LAM}))",
        f"fs AS (SELECT *, n * c11 / (s1 * s1) + {LAM} AS a11, n * c12 / (s1 * s2) AS a12, n * c22 / (s2 * s2) + {LAM} AS a22, "
        "n * c1y / s1 AS r1, n * c2y / s2 AS r2 FROM st, lam)",
        "cf AS (SELECT *, (r1 * a22 - r2 * a12) / (a11 * a22 - a12 * a12) AS w1, (r2 * a11 - r1 * a12) / (a11 * a22 - a12 * a12) AS w2 FROM fs)",
    ]


SWEEP_PRED = "my + w1 * (area - m1) / s1 + w2 * (lon - m2) / s2"
_SWEEP = [HOUSES, CONV, split_cte(), *_ridge_norm_ctes("split", "split", "NOT is_test", SWEEP_LAMBDAS),
          f"sc AS (SELECT position, {LAM}, avg(pow(price - ({SWEEP_PRED}), 2)) AS mse, "
          f"1 - sum(pow(price - ({SWEEP_PRED}), 2)) / (var_pop(price) * count(price)) AS r2 FROM cf, split WHERE is_test GROUP BY position, {LAM})"]


def _sweep(spark, sf):
    return sel.lambda_sweep(conv(spark, sf), ["area", "lon"], "price", KEY, SWEEP_LAMBDAS, 0.2, SEED)


@query(
    "lambda_sweep",
    W(*_SWEEP) + f"SELECT CAST(position AS INTEGER) AS position, {LAM}, {ssig('mse')} AS mse, {ssig('r2')} AS r2 FROM sc",
)
def q_sweep(spark, sf):
    return small(_sweep(spark, sf).curve, ["mse", "r2"])


@query(
    "weight_paths",
    W(*_SWEEP) + f"SELECT {LAM}, 'area' AS feature, {ssig('w1')} AS weight FROM cf UNION ALL SELECT {LAM}, 'lon', {ssig('w2')} FROM cf",
)
def q_weights(spark, sf):
    weights = _sweep(spark, sf).weights
    wide = weights.groupBy("lambda").pivot("feature", ["area", "lon"]).agg(F.first("weight"))
    return small(dg.weight_paths(wide, "lambda", ["area", "lon"]), ["weight"])


@query(
    "metric_curve",
    W(*_SWEEP, "b AS (SELECT arg_min(position, (mse, position)) AS bp FROM sc)")
    + f"SELECT CAST(position AS INTEGER) AS position, {LAM}, {ssig('mse')} AS value, position = bp AS is_best FROM sc, b",
)
def q_metric_curve(spark, sf):
    curve = _sweep(spark, sf).curve
    return small(dg.metric_curve(curve, "lambda", "mse", True), ["value"])


@query(
    "best_param",
    W(*_SWEEP)
    + f"SELECT 'mse' AS metric, CAST(arg_min(position, (mse, position)) AS INTEGER) AS position, arg_min({LAM}, (mse, position)) AS {LAM}, "
    f"{ssig('min(mse)')} AS value FROM sc UNION ALL SELECT 'r2', CAST(arg_min(position, (-r2, position)) AS INTEGER), "
    f"arg_min({LAM}, (-r2, position)), {ssig('max(r2)')} FROM sc",
)
def q_best(spark, sf):
    curve = _sweep(spark, sf).curve
    rows = []
    for m, mn in (("mse", True), ("r2", False)):
        b = sel.best_param(curve, "lambda", m, mn).first()
        rows.append((m, b["position"], b["lambda"], sig(b[m])))
    return spark.createDataFrame(rows, "metric string, position int, lambda double, value double")


@query(
    "improvement_pct",
    W(*_SWEEP)
    + f"SELECT {ssig('(max(mse) FILTER (WHERE position = 0) - min(mse)) / max(mse) FILTER (WHERE position = 0) * 100')} AS mse_pct, "
    f"{ssig('(max(r2) - max(r2) FILTER (WHERE position = 0)) / max(r2) FILTER (WHERE position = 0) * 100')} AS r2_pct FROM sc",
)
def q_improve(spark, sf):
    curve = _sweep(spark, sf).curve
    agg = curve.agg(
        F.max(F.when(F.col("position") == 0, F.col("mse"))).alias("mse0"), F.min("mse").alias("mse1"),
        F.max(F.when(F.col("position") == 0, F.col("r2"))).alias("r20"), F.max("r2").alias("r21"),
    )
    out = agg.select(
        sel.improvement_pct(F.col("mse0"), F.col("mse1"), True).alias("mse_pct"),
        sel.improvement_pct(F.col("r20"), F.col("r21"), False).alias("r2_pct"),
    )
    return small(out, ["mse_pct", "r2_pct"])


CV_LAMBDAS = [0.0, 1e4, 1e5]
# 100 weights x 10 folds
CV_GRID = [1000.0 * i for i in range(100)]


def _cv_sql(lambdas, folds: int = 5) -> str:
    ctes = [HOUSES, CONV, fold_cte(k=folds), "ks AS (SELECT DISTINCT fold AS k FROM folded)",
            "trn AS (SELECT ks.k, folded.* FROM ks JOIN folded ON folded.fold <> ks.k)",
            *_ridge_norm_ctes("trn", "trn", "TRUE", lambdas, group="k", zero="1e-8"),
            f"sc AS (SELECT k, position, {LAM}, avg(pow(price - ({SWEEP_PRED}), 2)) AS mse, "
            f"1 - sum(pow(price - ({SWEEP_PRED}), 2)) / (var_pop(price) * count(price)) AS r2 "
            f"FROM cf JOIN folded ON folded.fold = cf.k GROUP BY k, position, {LAM})"]
    return W(*ctes) + f"SELECT CAST(position AS INTEGER) AS position, {LAM}, {ssig('avg(mse)')} AS mse, {ssig('avg(r2)')} AS r2 FROM sc GROUP BY position, {LAM}"


@query("cv_lambda", _cv_sql(CV_GRID, 10))
def q_cv_lambda(spark, sf):
    res = sel.cv_lambda(conv(spark, sf), ["area", "lon"], "price", KEY, CV_GRID, n_splits=10, seed=SEED)
    return small(res.curve, ["mse", "r2"])


def _cv_mae_sql(lambdas) -> str:
    sql = _cv_sql(lambdas)
    sql = sql.replace(f"avg(pow(price - ({SWEEP_PRED}), 2)) AS mse", f"avg(abs(price - ({SWEEP_PRED}))) AS mse")
    return sql.replace(" AS mse, " + ssig("avg(r2)") + " AS r2", " AS mae")


@query("cv_metric_mae", _cv_mae_sql(CV_LAMBDAS))
def q_cv_metric_mae(spark, sf):
    res = sel.cv_lambda(conv(spark, sf), ["area", "lon"], "price", KEY, CV_LAMBDAS, n_splits=5, seed=SEED, metrics=("mae",))
    return small(res.curve, ["mae"])


@query("cv_plain", _cv_sql([0.0]).replace("lambda", "param"))
def q_cv_plain(spark, sf):
    res = sel.cv_plain(conv(spark, sf), ["area", "lon"], "price", KEY, n_splits=5, seed=SEED)
    return small(res.curve, ["mse", "r2"])


def _cv_degrees_sql(top: int = 9, k: int = 5) -> str:
    """Degrees 1 to ``top`` of one feature by orthogonal polynomials: on each
    fold's training rows p(j+1) = (x - a) p(j) - b p(j-1), and the coefficient of
    p(j) is that of y alone, so every degree adds one term to the last fit."""
    ctes = [
        HOUSES, CONV, fold_cte(k=k), f"ks AS (SELECT unnest(range({k})) AS k)",
        "sc AS (SELECT avg(area) AS m, stddev_samp(area) AS s FROM conv)",
        "p0 AS MATERIALIZED (SELECT ks.k, folded.fold <> ks.k AS train, (area - m) / s AS x, ln(price) AS y, price, "
        "0.0::DOUBLE AS below, 1.0::DOUBLE AS p, 0.0::DOUBLE AS f FROM folded, ks, sc)",
    ]
    for j in range(top + 1):
        ctes.append(
            f"s{j} AS MATERIALIZED (SELECT k, sum(p * p) AS n, sum(x * p * p) / sum(p * p) AS a, sum(y * p) / sum(p * p) AS c "
            f"FROM p{j} WHERE train GROUP BY k)"
        )
        b, join = ("s.n / l.n", f"JOIN s{j - 1} l ON l.k = p.k") if j else ("0", "")
        ctes.append(
            f"p{j + 1} AS MATERIALIZED (SELECT p.k, p.train, p.x, p.y, p.price, p.p AS below, (p.x - s.a) * p.p - {b} * p.below AS p, "
            f"p.f + s.c * p.p AS f FROM p{j} p JOIN s{j} s ON s.k = p.k {join})"
        )
    fits = " UNION ALL ".join(
        f"SELECT {d - 1} AS position, {d}.0::DOUBLE AS degree, avg(pow(exp(f) - price, 2)) AS mse, "
        f"1 - sum(pow(price - exp(f), 2)) / (var_pop(price) * count(price)) AS r2 FROM p{d + 1} WHERE NOT train GROUP BY k"
        for d in range(1, top + 1)
    )
    return W(*ctes, f"sd AS ({fits})") + (
        f"SELECT CAST(position AS INTEGER) AS position, degree, {ssig('avg(mse)')} AS mse, {ssig('avg(r2)')} AS r2 FROM sd GROUP BY position, degree"
    )


@query("cv_degree_nine", _cv_degrees_sql())
def q_cv_degrees(spark, sf):
    res = sel.cv_degree(conv(spark, sf), ["area"], "price", KEY, list(range(1, 10)), n_splits=5, seed=SEED, transform_target="log", inverse="exp")
    return small(res.curve, ["mse", "r2"])


def _cv_degree_sql() -> str:
    """Degrees 1 and 2 of one feature, fold-normalised, log target scored after exp."""
    ctes = [
        HOUSES, CONV, fold_cte(), "ks AS (SELECT DISTINCT fold AS k FROM folded)",
        "nrm AS (SELECT ks.k, avg(lon) AS m, CASE WHEN stddev_samp(lon) = 0 THEN 1e-8 ELSE stddev_samp(lon) END AS s "
        "FROM ks JOIN folded ON folded.fold <> ks.k GROUP BY ks.k)",
        "zz AS (SELECT nrm.k, folded.fold, (lon - m) / s AS z, pow((lon - m) / s, 2) AS z2, ln(price) AS y FROM nrm, folded)",
        "d1 AS (SELECT k, regr_intercept(y, z) AS b0, regr_slope(y, z) AS b1 FROM zz WHERE fold <> k GROUP BY k)",
        # degree 2: two regressors (z, z^2) per training fold k, Cramer's rule
        "d2_m AS (SELECT k, count(*)::DOUBLE AS n, avg(z) AS m1, avg(z2) AS m2, avg(y) AS my, covar_pop(z, z) AS c11, "
        "covar_pop(z, z2) AS c12, covar_pop(z2, z2) AS c22, covar_pop(z, y) AS c1y, covar_pop(z2, y) AS c2y FROM zz WHERE fold <> k GROUP BY k)",
        "d2_s AS (SELECT *, n * c11 AS a11, n * c12 AS a12, n * c22 AS a22, n * c1y AS r1, n * c2y AS r2 FROM d2_m)",
        "d2 AS (SELECT *, (r1 * a22 - r2 * a12) / (a11 * a22 - a12 * a12) AS b1, (r2 * a11 - r1 * a12) / (a11 * a22 - a12 * a12) AS b2 FROM d2_s)",
        "pv AS (SELECT zz.k, exp(zz.y) AS yy, exp(d1.b0 + d1.b1 * zz.z) AS p1, "
        "exp((d2.my - d2.b1 * d2.m1 - d2.b2 * d2.m2) + d2.b1 * zz.z + d2.b2 * zz.z2) AS p2 "
        "FROM zz JOIN d1 ON zz.k = d1.k JOIN d2 ON zz.k = d2.k WHERE zz.fold = zz.k)",
        "sc AS (SELECT k, avg(pow(p1 - yy, 2)) AS mse1, 1 - sum(pow(yy - p1, 2)) / (var_pop(yy) * count(yy)) AS r21, "
        "avg(pow(p2 - yy, 2)) AS mse2, 1 - sum(pow(yy - p2, 2)) / (var_pop(yy) * count(yy)) AS r22 FROM pv GROUP BY k)",
    ]
    return (
        W(*ctes)
        + f"SELECT 0 AS position, 1.0::DOUBLE AS degree, {ssig('avg(mse1)')} AS mse, {ssig('avg(r21)')} AS r2 FROM sc "
        f"UNION ALL SELECT 1, 2.0::DOUBLE, {ssig('avg(mse2)')}, {ssig('avg(r22)')} FROM sc"
    )


@query("cv_degree", _cv_degree_sql())
def q_cv_degree(spark, sf):
    res = sel.cv_degree(conv(spark, sf), ["lon"], "price", KEY, [1, 2], n_splits=5, seed=SEED, transform_target="log", inverse="exp")
    return small(res.curve, ["mse", "r2"])


@query(
    "segment_fit",
    W(HOUSES, CONV, "g AS (SELECT CAST(is_house AS VARCHAR) AS segment, regr_intercept(price, area) AS b0, regr_slope(price, area) AS b1, "
      "count(*) AS n FROM conv GROUP BY is_house UNION ALL SELECT 'all', regr_intercept(price, area), regr_slope(price, area), count(*) FROM conv)")
    + f"SELECT segment, 'intercept' AS term, {ssig('b0')} AS coefficient, n FROM g UNION ALL SELECT segment, 'area', {ssig('b1')}, n FROM g",
)
def q_segment(spark, sf):
    coefs = sel.segment_fit(conv(spark, sf), ["area"], "price", "is_house")
    return small(coefs.select("segment", "term", "coefficient", "n"), ["coefficient"])


@query(
    "feature_impact",
    W(HOUSES, CONV, "g AS (SELECT CAST(is_house AS VARCHAR) AS segment, regr_slope(price, area) AS b1, avg(price) AS ap FROM conv GROUP BY is_house "
      "UNION ALL SELECT 'all', regr_slope(price, area), avg(price) FROM conv)")
    + f"SELECT segment, 'area' AS feature_name, 'Area' AS display_name, {ssig('b1')} AS absolute_impact, {ssig('ap')} AS average_target, "
    f"{ssig('b1 / ap * 100')} AS percentage_impact FROM g",
)
def q_impact(spark, sf):
    df = conv(spark, sf)
    coefs = sel.segment_fit(df, ["area"], "price", "is_house")
    out = sel.feature_impact(coefs, df, "is_house", "price", "area")
    return small(out, ["absolute_impact", "average_target", "percentage_impact"])


# ------------------------------------------------------- 2.11 diagnostics

RES_CTE = "rs AS (SELECT *, price - pred AS residual FROM pr)"


def _residual_df(spark, sf):
    return dg.residuals(_scored(spark, sf), "price", "pred")


@query("residuals", W(HOUSES, CONV, PRED_CTE, RES_CTE) + f"SELECT {KEYS_SQL}, round(residual, 4) AS residual FROM rs")
def q_residuals(spark, sf):
    return _residual_df(spark, sf).select(*KEY, r("residual", 4).alias("residual"))


@query(
    "perfect_line",
    W(HOUSES, CONV, PRED_CTE) + f"SELECT {ssig('least(min(price), min(pred))')} AS lo, {ssig('greatest(max(price), max(pred))')} AS hi FROM pr",
)
def q_perfect(spark, sf):
    return small(dg.perfect_line(_scored(spark, sf), "price", "pred"), ["lo", "hi"])


@query(
    "polyfit_curve",
    W(HOUSES, CONV, PRED_CTE, "f AS (SELECT regr_intercept(pred, price) AS a, regr_slope(pred, price) AS b, min(price) AS lo, max(price) AS hi FROM pr)")
    + "SELECT CAST(i AS INTEGER) AS i, round(lo + i * ((hi - lo) / 99), 4) AS x, round(a + b * (lo + i * ((hi - lo) / 99)), 4) AS fitted FROM range(100) t(i), f",
)
def q_polyfit(spark, sf):
    c = dg.polyfit_curve(_scored(spark, sf), "price", "pred", 1, 100)
    return c.select("i", r("x", 4).alias("x"), r("fitted", 4).alias("fitted"))


@query(
    "normal_pdf_overlay",
    W(HOUSES, CONV, PRED_CTE, RES_CTE, "st AS (SELECT min(residual) AS lo, max(residual) AS hi, avg(residual) AS m, stddev_pop(residual) AS s FROM rs)")
    + "SELECT CAST(i AS INTEGER) AS i, round(lo + i * ((hi - lo) / 99), 4) AS x, "
    "round((1.0 / (s * sqrt(2 * pi()))) * exp(-pow(lo + i * ((hi - lo) / 99) - m, 2) / (2 * s * s)), 12) AS pdf FROM range(100) t(i), st",
)
def q_normal(spark, sf):
    o = dg.normal_pdf_overlay(_residual_df(spark, sf), "residual", 100)
    return o.select("i", r("x", 4).alias("x"), r("pdf", 12).alias("pdf"))


def _erfinv_sql(y: str) -> str:
    ln = f"ln(1 - ({y}) * ({y}))"
    t = f"(2 / (pi() * 0.147) + {ln} / 2)"
    return f"sign({y}) * sqrt(greatest(0, sqrt({t} * {t} - {ln} / 0.147) - {t}))"


QQ_CTES = [HOUSES, CONV, PRED_CTE, RES_CTE,
           f"qq AS (SELECT CAST(row_number() OVER (ORDER BY residual, {KEYS_SQL}) AS BIGINT) AS i, residual AS observed, "
           "count(*) OVER () AS n FROM rs WHERE residual IS NOT NULL)",
           "qp AS (SELECT i, observed, (i - 0.5) / n AS p FROM qq)",
           f"qt AS (SELECT i, observed, p, sqrt(2) * ({_erfinv_sql('2 * p - 1')}) AS theoretical FROM qp)"]


def _qq(spark, sf):
    return dg.qq_table(_residual_df(spark, sf), "residual", KEY)


@query(
    "qq_table",
    W(*QQ_CTES) + "SELECT i, round(observed, 4) AS observed, round(p, 12) AS p, round(theoretical, 9) AS theoretical FROM qt",
)
def q_qq(spark, sf):
    return _qq(spark, sf).select("i", r("observed", 4).alias("observed"), r("p", 12).alias("p"), r("theoretical", 9).alias("theoretical"))


@query(
    "qq_line",
    W(*QQ_CTES)
    + f"SELECT {ssig('regr_slope(observed, theoretical)')} AS slope, round(regr_intercept(observed, theoretical), 4) + 0.0 AS intercept, "
    f"{ssig('corr(theoretical, observed)')} AS r FROM qt",
)
def q_qq_line(spark, sf):
    line = dg.qq_line(_qq(spark, sf))
    # the intercept is zero up to rounding noise: compare it at 4 decimals
    return small(line.withColumn("intercept", F.round("intercept", 4) + 0.0), ["slope", "r"])


# --------------------------------------------- lasso sweep (gradient descent)

LASSO_LAMBDAS = [0.0, 10.0, 50.0]
LASSO_GRID = [0.25 * i for i in range(200)]
# as many epochs as both engines follow to the last digit compared
LASSO_EPOCHS, LASSO_LR = 60, 0.01
LASSO_FIT = {"method": "gradient_descent", "regularization": "l1", "epochs": LASSO_EPOCHS, "learning_rate": LASSO_LR,
             "tolerance": 1e-12}


def _lasso_sql(select: str, lambdas) -> str:
    lam_rows = ", ".join(f"({i}, {v}::DOUBLE)" for i, v in enumerate(lambdas))
    g = ("g AS (SELECT n, n * c11 / (s1 * s1) AS g11, n * c12 / (s1 * s2) AS g12, n * c22 / (s2 * s2) AS g22, "
         "n * my AS t0, n * c1y / s1 AS t1, n * c2y / s2 AS t2, n * (vy + my * my) AS yy, m1, s1, m2, s2 FROM st)")
    st = ("st AS (SELECT count(*)::DOUBLE AS n, avg(area) AS m1, stddev_samp(area) AS s1, avg(lon) AS m2, stddev_samp(lon) AS s2, "
          "avg(price) AS my, var_pop(price) AS vy, covar_pop(area, area) AS c11, covar_pop(area, lon) AS c12, covar_pop(lon, lon) AS c22, "
          "covar_pop(area, price) AS c1y, covar_pop(lon, price) AS c2y FROM split WHERE NOT is_test)")
    loss = ("((n * b0 * b0 + g11 * b1 * b1 + g22 * b2 * b2 + 2 * g12 * b1 * b2 - 2 * (b0 * t0 + b1 * t1 + b2 * t2) + yy) / n "
            "+ lam * (abs(b1) + abs(b2)))")
    nb0 = f"b0 - {LASSO_LR} * (2 / n) * (n * b0 - t0)"
    nb1 = f"b1 - {LASSO_LR} * ((2 / n) * (g11 * b1 + g12 * b2 - t1) + lam * sign(b1))"
    nb2 = f"b2 - {LASSO_LR} * ((2 / n) * (g12 * b1 + g22 * b2 - t2) + lam * sign(b2))"
    gd = (
        "gd(position, lam, epoch, b0, b1, b2, prev, minl, w0, w1, w2, done) AS ("
        "SELECT position, \"lambda\", 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 'inf'::DOUBLE, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, false FROM lam "
        "UNION ALL SELECT position, lam, epoch + 1, "
        f"CASE WHEN abs(prev - L) < 1e-12 THEN b0 ELSE {nb0} END, CASE WHEN abs(prev - L) < 1e-12 THEN b1 ELSE {nb1} END, "
        f"CASE WHEN abs(prev - L) < 1e-12 THEN b2 ELSE {nb2} END, L, "
        "CASE WHEN abs(prev - L) >= 1e-12 AND L < minl THEN L ELSE minl END, "
        f"CASE WHEN abs(prev - L) >= 1e-12 AND L < minl THEN {nb0} ELSE w0 END, "
        f"CASE WHEN abs(prev - L) >= 1e-12 AND L < minl THEN {nb1} ELSE w1 END, "
        f"CASE WHEN abs(prev - L) >= 1e-12 AND L < minl THEN {nb2} ELSE w2 END, abs(prev - L) < 1e-12 "
        f"FROM (SELECT gd.*, g.*, {loss} AS L FROM gd, g) WHERE epoch < {LASSO_EPOCHS} AND NOT done)"
    )
    fin = ("fin AS (SELECT position, lam AS \"lambda\", arg_max(w0, epoch) AS w0, arg_max(w1, epoch) AS w1, arg_max(w2, epoch) AS w2 "
           "FROM gd GROUP BY position, lam)")
    return (
        "WITH RECURSIVE " + ",\n".join([HOUSES, CONV, split_cte(), st, g, f"lam AS (SELECT * FROM (VALUES {lam_rows}) t(position, \"lambda\"))", gd, fin])
        + "\n" + select
    )


def _lasso(spark, sf, lambdas):
    return sel.lambda_sweep(conv(spark, sf), ["area", "lon"], "price", KEY, lambdas, 0.2, SEED, fit_params=LASSO_FIT)


@query(
    "lasso_weights",
    _lasso_sql(
        f"SELECT CAST(position AS INTEGER) AS position, {LAM}, 'area' AS feature, {ssig('w1')} AS weight FROM fin "
        f"UNION ALL SELECT CAST(position AS INTEGER), {LAM}, 'lon', {ssig('w2')} FROM fin",
        LASSO_LAMBDAS,
    ),
)
def q_lasso_weights(spark, sf):
    return small(_lasso(spark, sf, LASSO_LAMBDAS).weights, ["weight"])


@query(
    "lasso_sweep",
    _lasso_sql(
        "SELECT CAST(fin.position AS INTEGER) AS position, fin.\"lambda\", "
        + ssig("avg(pow(price - (w0 + w1 * (area - m1) / s1 + w2 * (lon - m2) / s2), 2))") + " AS mse, "
        + ssig("1 - sum(pow(price - (w0 + w1 * (area - m1) / s1 + w2 * (lon - m2) / s2), 2)) / (var_pop(price) * count(price))")
        + " AS r2 FROM fin, g, split WHERE is_test GROUP BY fin.position, fin.\"lambda\"",
        LASSO_GRID,
    ),
)
def q_lasso_sweep(spark, sf):
    return small(_lasso(spark, sf, LASSO_GRID).curve, ["mse", "r2"])


# ------------------------------------------- separate keys of the inventory

_PEN_SQL = {
    "ridge": f"0.5 * {PEN_ALPHA} * (b1 * b1 + b2 * b2)",
    "lasso": f"{PEN_ALPHA} * (abs(b1) + abs(b2))",
    "elasticnet": f"{PEN_ALPHA} * {PEN_RATIO} * (abs(b1) + abs(b2)) + 0.5 * {PEN_ALPHA} * (1 - {PEN_RATIO}) * (b1 * b1 + b2 * b2)",
}

for _p in ("ridge", "lasso", "elasticnet"):
    def _pq(spark, sf, _p=_p):
        coefs = _ridge_model(spark, sf).coef_table(spark)
        return small(coefficient_penalties(coefs, PEN_ALPHA, PEN_RATIO).select(F.col(_p).alias("penalty")), ["penalty"])

    query(f"penalty_{_p}", W(HOUSES, CONV, *_RIDGE) + f"SELECT {ssig(_PEN_SQL[_p])} AS penalty FROM fit")(_pq)


@query(
    "erfinv",
    W(*QQ_CTES) + f"SELECT i, round({_erfinv_sql('2 * p - 1')}, 9) AS erfinv FROM qp",
)
def q_erfinv(spark, sf):
    qq = _qq(spark, sf)
    return qq.select("i", r(erfinv(2 * F.col("p") - 1), 9).alias("erfinv"))


def _csv_roundtrip(spark, sf, schema):
    from tessera.session import scratch_path
    from tessera.sources.io import HOUSE_SCHEMA, read_csv, write_table

    folder = scratch_path(spark, "csv")
    cols = [f.name for f in HOUSE_SCHEMA.fields]
    write_table(houses(spark, sf).select(*cols), folder, fmt="csv")
    return read_csv(spark, folder, HOUSE_SCHEMA if schema else None).select(*cols)


_CSV_SQL = W(HOUSES) + "SELECT area, area_units, is_house, has_pool, age, price, lat, lon, rooms FROM houses"


@query("sink_csv", _CSV_SQL)
def q_sink_csv(spark, sf):
    """Write the whole table as header CSV (shared folder), read it back with the schema."""
    return _csv_roundtrip(spark, sf, True)


@query("scan_csv", _CSV_SQL)
def q_scan_csv(spark, sf):
    """Header CSV scan with inferred types (double/string/int) and empty cells as NULL."""
    return _csv_roundtrip(spark, sf, False)


PAIR_COLS = ["area", "price", "age"]


def _pair_sql() -> str:
    parts = []
    for a in PAIR_COLS:
        for b in PAIR_COLS:
            if a == b:
                continue
            parts.append(
                f"SELECT '{a}' AS x, '{b}' AS y, CAST(least(floor(({a} - lo_{a}) / (hi_{a} - lo_{a}) * 10), 9) AS INTEGER) AS bx, "
                f"CAST(least(floor(({b} - lo_{b}) / (hi_{b} - lo_{b}) * 10), 9) AS INTEGER) AS by, is_house, count(*) AS count "
                f"FROM houses, rg WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL"
            )
    rg = "rg AS (SELECT " + ", ".join(f"min({c})::DOUBLE AS lo_{c}, max({c})::DOUBLE AS hi_{c}" for c in PAIR_COLS) + " FROM houses)"
    return W(HOUSES, rg) + "\nUNION ALL\n".join(parts)


@query("binned_pairs", _pair_sql())
def q_binned_pairs(spark, sf):
    return pf.pair_bins(houses(spark, sf), PAIR_COLS, 10, hue="is_house")
