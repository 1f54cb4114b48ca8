import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import rank as rk
from tessera.operators import split as sp

from houses import to_spark


def _order(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))


def test_split_exact_and_matches_brute_force(spark):
    df = spark.range(1003).withColumnRenamed("id", "k").repartition(7)
    out = sp.train_test_split(df, ["k"], 0.2, 42).toPandas()
    n_test = int(1003 * 0.2)
    assert out["is_test"].sum() == n_test
    order = _order(range(1003))
    assert set(out.loc[out.is_test, "k"]) == set(order[1003 - n_test :])


def test_split_layout_independent(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = sp.train_test_split(df.repartition(1), ["k"], 0.3, 7).filter("is_test").select("k").collect()
    b = sp.train_test_split(df.repartition(9), ["k"], 0.3, 7).filter("is_test").select("k").collect()
    assert sorted(r.k for r in a) == sorted(r.k for r in b)


def test_folds_sizes_and_brute_force(spark):
    n, k = 1007, 5
    df = spark.range(n).withColumnRenamed("id", "key")
    out = sp.kfold(df, ["key"], k, 12).toPandas()
    fold_size = n // k
    sizes = out.groupby("fold").size().to_dict()
    assert sizes == {0: fold_size, 1: fold_size, 2: fold_size, 3: fold_size, 4: n - 4 * fold_size}
    order = _order(range(n), 12)
    want = {key: min(i // fold_size, k - 1) for i, key in enumerate(order)}
    assert all(want[r.key] == r.fold for r in out.itertuples())


def test_folds_need_enough_rows(spark):
    with pytest.raises(ValueError):
        sp.kfold(spark.range(3), ["id"], 5)


def test_thresholds_across_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(rk, "TARGET_BUCKET_ROWS", 50)
    df = spark.range(2000).withColumnRenamed("id", "k")
    out = sp.kfold(df, ["k"], 4, 3).toPandas()
    order = _order(range(2000), 3)
    want = {key: min(i // 500, 3) for i, key in enumerate(order)}
    assert all(want[r.k] == r.fold for r in out.itertuples())


def test_sample_and_head(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    got = [r.k for r in sp.sample_n(df, ["k"], 5, 42).collect()]
    assert got == _order(range(100))[:5]
    assert [r.k for r in sp.head_n(df, ["k"], 3).collect()] == [0, 1, 2]


def test_exact_rank_with_hot_value(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=3000)
    v[:1000] = 0.25  # a third of the rows hold one value
    pdf = pd.DataFrame({"id": np.arange(3000), "v": v})
    df = to_spark(spark, pdf, "id long, v double", partitions=6)
    out = rk.exact_rank(df, ["v"], ["id"], "rank").toPandas().sort_values("rank")
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    assert list(out["rank"]) == list(range(1, 3001))
    assert list(out["id"]) == list(want["id"])


def test_exact_quantiles_match_numpy(spark, monkeypatch):
    monkeypatch.setattr(rk, "SELECT_LEAF_ROWS", 20)
    monkeypatch.setattr(rk, "BRACKET_ACCURACY", 20)
    rng = np.random.default_rng(2)
    a = rng.lognormal(size=2001)
    b = np.where(rng.random(2001) < 0.4, 3.0, rng.normal(size=2001))
    g = rng.integers(0, 3, 2001)
    pdf = pd.DataFrame({"a": a, "b": b, "g": g})
    pdf.loc[::7, "a"] = np.nan
    df = to_spark(spark, pdf, "a double, b double, g long", partitions=4)
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = rk.exact_quantiles(df, ["a", "b"], qs)
    for c in ("a", "b"):
        for q in qs:
            assert np.isclose(got[(None, c, q)], np.nanquantile(pdf[c], q), rtol=0, atol=1e-12)
    per = rk.exact_quantiles(df, ["a"], [0.5], group_col="g")
    for grp, sub in pdf.groupby("g"):
        assert np.isclose(per[(str(grp), "a", 0.5)], sub["a"].median(), atol=1e-12)


@pytest.mark.parametrize("leaf", [50_000, 10])
def test_grouped_quantiles(spark, monkeypatch, leaf):
    """Ties, a group with half of the rows, NULL groups and values."""
    monkeypatch.setattr(rk, "SELECT_LEAF_ROWS", leaf)
    rng = np.random.default_rng(11)
    n = 4000
    g = np.where(rng.random(n) < 0.5, 7, rng.integers(0, 60, n)).astype(float)
    pdf = pd.DataFrame({"g": g, "a": rng.integers(0, 40, n) / 4.0, "b": rng.normal(size=n)})
    pdf.loc[::9, "a"] = np.nan
    pdf.loc[pdf.g == 3, "b"] = np.nan
    pdf.loc[::31, "g"] = np.nan
    df = to_spark(spark, pdf, "g double, a double, b double", partitions=5)
    qs = [0.0, 0.1, 0.5, 1.0]
    got = {(r["group"], r["feature"], r["q"]): r["value"] for r in rk.grouped_quantiles(df, ["a", "b"], qs, "g").collect()}
    want = {}
    for key, sub in pdf.groupby("g", dropna=False):
        for c in ("a", "b"):
            if sub[c].notna().any():
                for q in qs:
                    want[None if np.isnan(key) else key, c, q] = np.nanquantile(sub[c], q)
    assert got.keys() == want.keys()
    assert all(np.isclose(got[k], want[k], rtol=0, atol=1e-12) for k in want)


def test_quantiles_of_a_log_spread_column_need_few_jobs(spark):
    rng = np.random.default_rng(6)
    v = np.exp(rng.normal(0, 12, 60_000))
    df = to_spark(spark, pd.DataFrame({"v": v}), "v double", partitions=4).cache()
    df.count()
    spark.sparkContext.setJobGroup("log-spread", "log-spread")
    got = rk.exact_quantiles(df, ["v"], [0.5, 0.999])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("log-spread"))
    spark.sparkContext.setJobGroup("idle", "idle")
    assert np.isclose(got[(None, "v", 0.5)], np.quantile(v, 0.5)) and np.isclose(got[(None, "v", 0.999)], np.quantile(v, 0.999))
    assert jobs <= 8  # four scans, each with its aggregation


@pytest.mark.parametrize("leaf", [1, 5, 50_000])
def test_quantiles_with_hot_values(spark, monkeypatch, leaf):
    monkeypatch.setattr(rk, "SELECT_LEAF_ROWS", leaf)
    monkeypatch.setattr(rk, "BRACKET_ACCURACY", 50)
    rng = np.random.default_rng(7)
    v = np.where(rng.random(3000) < 0.9, 2.0, rng.normal(2, 1, 3000))
    df = to_spark(spark, pd.DataFrame({"v": v}), "v double", partitions=4).cache()
    qs = [0.0, 0.01, 0.04, 0.06, 0.5, 0.95, 0.99, 1.0]
    got = rk.exact_quantiles(df, ["v"], qs)
    assert np.allclose([got[(None, "v", q)] for q in qs], np.quantile(v, qs), atol=1e-12)


def test_thresholds_two_refinement_levels(spark, monkeypatch):
    monkeypatch.setattr(rk, "TARGET_BUCKET_ROWS", 3)
    n = 20000
    df = spark.range(n).withColumnRenamed("id", "k")
    out = sp.kfold(df, ["k"], 3, 9).toPandas()
    order = _order(range(n), 9)
    size = n // 3
    want = {key: min(i // size, 2) for i, key in enumerate(order)}
    assert all(want[r.k] == r.fold for r in out.itertuples())


def test_cut_inside_a_hot_duplicate_key_raises(spark, monkeypatch):
    # a third of the rows share one key: they are equal in the order, so no cut
    # can fall between them
    monkeypatch.setattr(rk, "TARGET_BUCKET_ROWS", 3)
    keys = list(range(200)) + [7] * 100
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    vals = sorted((hashlib.md5(f"42|{k}".encode()).hexdigest(), k) for k in keys)
    first = [v[1] for v in vals].index(7)
    n, n_train = len(keys), first + 50
    with pytest.raises(ValueError):
        sp.train_test_split(df, ["k"], (n - n_train + 0.5) / n, 42)
