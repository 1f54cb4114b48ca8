import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import prep as pr
from tessera.sources.io import load_xy, nan_to_null

from houses import to_spark


def test_convert_units_golden(spark):
    # fixed value from the reference's one-row example: 1119 sqft -> 103.958457 m2
    df = spark.createDataFrame([(1, 1119.0, "sqft"), (2, 50.0, "m2"), (3, 10.0, None)], "id long, area double, area_units string")
    out = {r["id"]: r["area"] for r in pr.convert_units(df).collect()}
    assert math.isclose(out[1], 103.958457, abs_tol=1e-9)
    assert out[2] == 50.0 and out[3] == 10.0
    assert "area_units" not in pr.convert_units(df).columns


def test_convert_units_requires_column(spark):
    with pytest.raises(ValueError):
        pr.convert_units(spark.createDataFrame([(1.0,)], "area double"))


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "v double")
    out = [r["v"] for r in pr.round_to_int(df, ["v", "absent"]).collect()]
    assert out == [0, 2, 2, 0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert nan_to_null(df).filter(F.col("v").isNull()).count() == 1


def test_drop_and_select(spark, houses):
    assert "price" not in pr.drop_columns(houses, ["price", "nope"]).columns
    assert "area_units" not in pr.select_numeric(houses).columns
    x, feats = load_xy(houses, "price", transform_target=F.log)
    assert "price" in x.columns and "price" not in feats


def test_impute_mean_and_group(spark, houses):
    pdf = houses.toPandas()
    means = pr.fit_mean(houses, ["age", "rooms"])
    assert math.isclose(means["age"], pdf["age"].mean(), rel_tol=1e-12)
    filled = pr.impute_mean(houses, means)
    assert filled.filter(F.col("age").isNull()).count() == 0
    grouped = pr.impute_group_mean(houses, ["age"], "is_house").toPandas().set_index("id")
    exp = pdf.groupby("is_house")["age"].transform("mean")
    want = pdf["age"].fillna(exp)
    assert np.allclose(grouped.loc[pdf["id"], "age"].values, want.values)


def test_group_with_only_nulls_stays_null(spark):
    df = spark.createDataFrame([(0, None), (0, None), (1, 2.0), (1, None)], "g int, v double")
    out = sorted((r["g"], r["v"]) for r in pr.impute_group_mean(df, ["v"], "g").collect())
    assert out == [(0, None), (0, None), (1, 2.0), (1, 2.0)]


def test_binary_columns(spark):
    df = spark.createDataFrame([(1.5, 0, 1, 7), (2.5, 1, None, 7)], "a double, b int, c int, k int")
    assert pr.binary_columns(df, ["a", "b", "c", "k"]) == ["b"]


def test_zscore_modes(spark):
    df = spark.createDataFrame([(1.0, 0, 5.0), (3.0, 1, 5.0), (5.0, 1, 5.0)], "a double, b int, k double")
    skip = pr.fit_zscore(df, ["a", "b", "k"], "skip_binary")
    assert skip.mean["b"] == 0.0 and skip.std["b"] == 1.0 and skip.std["k"] == 1.0
    assert math.isclose(skip.std["a"], 2.0)
    allm = pr.fit_zscore(df, ["a", "b", "k"], "all")
    assert math.isclose(allm.mean["b"], 2 / 3)
    cv = pr.fit_zscore(df, ["k"], "cv")
    assert cv.std["k"] == 1e-8


def test_apply_params_only_known_columns(spark):
    df = spark.createDataFrame([(1.0, 10.0)], "a double, z double")
    params = pr.NormParams({"a": 1.0, "absent": 0.0}, {"a": 2.0, "absent": 1.0})
    row = pr.apply_params(df, params).first()
    assert row["a"] == 0.0 and row["z"] == 10.0
    back = pr.NormParams.from_df(params.to_df(spark))
    assert back.mean["a"] == 1.0


def test_group_mean_join_path(spark, houses, monkeypatch):
    monkeypatch.setattr(pr, "MAX_INLINE_GROUPS", 1)  # force the (broadcast) join instead of an inline CASE
    fitted = pr.fit_group_mean(houses, ["age", "rooms"], "is_house")
    assert fitted.inline is None
    got = fitted.apply(houses).toPandas().set_index("id")
    pdf = houses.toPandas()
    want = pdf["age"].fillna(pdf.groupby("is_house")["age"].transform("mean"))
    assert np.allclose(got.loc[pdf["id"], "age"].values, want.values)
    assert list(fitted.apply(houses).columns) == houses.columns


def test_group_means_of_one_heavy_group_and_many_others(spark, monkeypatch):
    """Half of the rows in one group, more groups than may be broadcast: heavy
    groups are broadcast, only the tail is joined by shuffle."""
    monkeypatch.setattr(pr, "MAX_BROADCAST_GROUPS", 50)
    rng = np.random.default_rng(17)
    n = 6000
    g = np.where(rng.random(n) < 0.5, 7, rng.integers(0, 900, n))
    rows = [(i, None if i % 41 == 0 else int(g[i]), None if rng.random() < 0.2 else float(i % 97)) for i in range(n)]
    rows += [(n, 5000, None)]  # a group without any value
    df = spark.createDataFrame(rows, "id long, g long, v double").repartition(5)
    out = pr.impute_group_mean(df, ["v"], "g")
    sums = {}
    for _, k, v in rows:
        if k is not None and v is not None:
            s = sums.setdefault(k, [0.0, 0])
            s[0] += v
            s[1] += 1
    want = {i: v if v is not None or k is None or k not in sums else sums[k][0] / sums[k][1] for i, k, v in rows}
    got = {r["id"]: r["v"] for r in out.collect()}
    assert out.columns == ["id", "g", "v"] and got.keys() == want.keys()
    assert all((got[i] is None and want[i] is None) or abs(got[i] - want[i]) < 1e-9 for i in want)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan and "strategy=broadcast" in plan
