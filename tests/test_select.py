import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.plans import select as sel

from houses import to_spark


def _folds(ids, k, seed):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))
    size = len(ids) // k
    return {key: min(i // size, k - 1) for i, key in enumerate(order)}


def _design(z, degree):
    cols = [np.ones(len(z))]
    for i in range(1, degree + 1):
        for c in range(z.shape[1]):
            cols.append(z[:, c] ** i)
    return np.column_stack(cols)


def _brute_cv(pdf, feats, target, grid, variable, k, seed, degree=1, log=False):
    fold = pdf["id"].map(_folds(list(pdf["id"]), k, seed)).values
    x = pdf[feats].values.astype(float)
    y = pdf[target].values.astype(float)
    yt = np.log(y) if log else y
    out = []
    for v in grid:
        mses, r2s = [], []
        for f in range(k):
            tr, va = fold != f, fold == f
            m = x[tr].mean(axis=0)
            s = x[tr].std(axis=0, ddof=1)
            s[s == 0] = 1e-8
            deg = int(v) if variable == "degree" else degree
            a_tr = _design((x[tr] - m) / s, deg)
            a_va = _design((x[va] - m) / s, deg)
            if variable == "penalty" and v > 0:
                eye = np.eye(a_tr.shape[1])
                eye[0, 0] = 0
                b = np.linalg.solve(a_tr.T @ a_tr + v * eye, a_tr.T @ yt[tr])
            else:
                b = np.linalg.lstsq(a_tr, yt[tr], rcond=None)[0]
            p = a_va @ b
            yy = yt[va]
            if log:
                p, yy = np.exp(p), np.exp(yy)
            mses.append(np.mean((p - yy) ** 2))
            r2s.append(1 - ((yy - p) ** 2).sum() / ((yy - yy.mean()) ** 2).sum())
        out.append((np.mean(mses), np.mean(r2s)))
    return out


@pytest.fixture
def data(spark):
    rng = np.random.default_rng(11)
    n = 240
    a, b = rng.uniform(1, 5, n), rng.normal(3, 2, n)
    y = np.exp(0.3 * a - 0.1 * b + 0.05 * a**2 + rng.normal(0, 0.05, n)) * 100
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "y": y})
    return pdf, to_spark(spark, pdf, "id long, a double, b double, y double", partitions=4)


def test_cv_lambda_matches_brute_force(data):
    pdf, df = data
    grid = [0.0, 0.5, 5.0, 50.0]
    res = sel.cv_lambda(df, ["a", "b"], "y", ["id"], grid, n_splits=5, seed=12, degree=3)
    got = res.curve.orderBy("position").toPandas()
    want = _brute_cv(pdf, ["a", "b"], "y", grid, "penalty", 5, 12, degree=3)
    assert np.allclose(got["mse"], [w[0] for w in want], rtol=1e-8)
    assert np.allclose(got["r2"], [w[1] for w in want], rtol=1e-8)


def test_cv_degree_with_inverse_transform(data):
    pdf, df = data
    res = sel.cv_degree(df, ["a", "b"], "y", ["id"], [1, 2, 3, 4], n_splits=4, seed=3, transform_target="log", inverse="exp")
    got = res.curve.orderBy("position").toPandas()
    want = _brute_cv(pdf, ["a", "b"], "y", [1, 2, 3, 4], "degree", 4, 3, log=True)
    assert np.allclose(got["mse"], [w[0] for w in want], rtol=1e-7)
    assert np.allclose(got["r2"], [w[1] for w in want], rtol=1e-7)
    assert res.best["mse"][0] == float(got.loc[got["mse"].idxmin(), "degree"])


def test_lambda_sweep_matches_brute_force(data):
    pdf, df = data
    grid = [0.0, 1.0, 10.0]
    res = sel.lambda_sweep(df, ["a", "b"], "y", ["id"], grid, test_size=0.25, seed=5)
    order = sorted(pdf["id"], key=lambda i: (hashlib.md5(f"5|{i}".encode()).hexdigest(), i))
    n_test = int(len(order) * 0.25)
    test_ids = set(order[len(order) - n_test :])
    is_test = pdf["id"].isin(test_ids).values
    x, y = pdf[["a", "b"]].values, pdf["y"].values
    m, s = x[~is_test].mean(axis=0), x[~is_test].std(axis=0, ddof=1)
    a_tr = _design((x[~is_test] - m) / s, 1)
    a_te = _design((x[is_test] - m) / s, 1)
    curve = res.curve.orderBy("position").toPandas()
    weights = res.weights.toPandas()
    for pos, lam in enumerate(grid):
        eye = np.eye(3)
        eye[0, 0] = 0
        b = np.linalg.solve(a_tr.T @ a_tr + lam * eye, a_tr.T @ y[~is_test])
        p = a_te @ b
        assert np.isclose(curve.loc[pos, "mse"], np.mean((p - y[is_test]) ** 2), rtol=1e-9)
        w = weights[weights.position == pos].set_index("feature")["weight"]
        assert np.allclose([w["a"], w["b"]], b[1:], rtol=1e-9)


def test_best_param_first_on_ties(spark):
    curve = spark.createDataFrame([(0, 0.1, 5.0), (1, 0.2, 3.0), (2, 0.3, 3.0), (3, 0.4, 9.0)], "position int, lambda double, mse double")
    b = sel.best_param(curve, "lambda", "mse", True).first()
    assert b["position"] == 1
    b = sel.best_param(curve, "lambda", "mse", False).first()
    assert b["position"] == 3
    v = spark.createDataFrame([(100.0, 80.0)], "a double, b double").select(sel.improvement_pct(F.col("a"), F.col("b")).alias("p")).first()["p"]
    assert np.isclose(v, 20.0)


def test_affine_design_map():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 2))
    a, b = np.array([1.5, 0.5]), np.array([-0.3, 2.0])
    A = sel.affine_design_map(a, b, 3)
    assert np.allclose(_design(x, 3) @ A, _design(a * x + b, 3))


def test_segment_fit_and_feature_impact(spark):
    rng = np.random.default_rng(1)
    seg = rng.integers(0, 3, 300)
    x = rng.normal(size=300)
    y = 1 + (seg + 1) * x + 50 + rng.normal(0, 0.1, 300)
    pdf = pd.DataFrame({"seg": seg.astype(str), "x": x, "y": y})
    df = to_spark(spark, pdf, "seg string, x double, y double")
    coefs = sel.segment_fit(df, ["x"], "y", "seg").toPandas()
    for s, sub in pdf.groupby("seg"):
        slope = np.polyfit(sub["x"], sub["y"], 1)[0]
        got = coefs[(coefs.segment == s) & (coefs.term == "x")]["coefficient"].iloc[0]
        assert np.isclose(got, slope)
    total = coefs[(coefs.segment == "all") & (coefs.term == "x")]["coefficient"].iloc[0]
    assert np.isclose(total, np.polyfit(pdf["x"], pdf["y"], 1)[0])
    imp = sel.feature_impact(sel.segment_fit(df, ["x"], "y", "seg"), df, "seg", "y", "x").toPandas().set_index("segment")
    assert set(imp.index) == {"0", "1", "2", "all"}
    assert np.isclose(imp.loc["all", "average_target"], pdf["y"].mean())
    assert imp.loc["all", "display_name"] == "X"


def test_lambda_sweep_with_inverse_transform(data):
    pdf, df = data
    df = df.withColumn("ly", F.log("y"))
    grid = [0.0, 2.0]
    res = sel.lambda_sweep(df, ["a", "b"], "ly", ["id"], grid, test_size=0.3, seed=8, degree=2, inverse="exp")
    order = sorted(pdf["id"], key=lambda i: (hashlib.md5(f"8|{i}".encode()).hexdigest(), i))
    n_test = int(len(order) * 0.3)
    is_test = pdf["id"].isin(set(order[len(order) - n_test :])).values
    x, ly = pdf[["a", "b"]].values, np.log(pdf["y"].values)
    m, s = x[~is_test].mean(axis=0), x[~is_test].std(axis=0, ddof=1)
    a_tr, a_te = _design((x[~is_test] - m) / s, 2), _design((x[is_test] - m) / s, 2)
    curve = res.curve.orderBy("position").toPandas()
    for pos, lam in enumerate(grid):
        eye = np.eye(a_tr.shape[1])
        eye[0, 0] = 0
        b = np.linalg.solve(a_tr.T @ a_tr + lam * eye, a_tr.T @ ly[~is_test]) if lam else np.linalg.lstsq(a_tr, ly[~is_test], rcond=None)[0]
        p, yy = np.exp(a_te @ b), np.exp(ly[is_test])
        assert np.isclose(curve.loc[pos, "mse"], np.mean((p - yy) ** 2), rtol=1e-8)
        assert np.isclose(curve.loc[pos, "r2"], 1 - ((yy - p) ** 2).sum() / ((yy - yy.mean()) ** 2).sum(), rtol=1e-8)


def test_degrees_one_to_nine_against_lstsq(spark):
    """Nine degrees x five folds of three features, each fold normalised with its
    own training rows, against lstsq on the rows."""
    rng = np.random.default_rng(21)
    n = 400
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.uniform(20, 160, n), "b": rng.normal(5, 2, n), "c": rng.integers(0, 30, n).astype(float)})
    pdf["y"] = np.exp(1 + np.sin(pdf.a / 30) + pdf.b / 10 + rng.normal(size=n) / 20)
    df = to_spark(spark, pdf, "id long, a double, b double, c double, y double", partitions=4)
    feats = ["a", "b", "c"]
    res = sel.cv_degree(df, feats, "y", ["id"], list(range(1, 10)), n_splits=5, seed=3, transform_target="log", inverse="exp")
    got = res.folds.toPandas().set_index(["fold", "degree"])
    fold = pdf["id"].map(_folds(list(pdf["id"]), 5, 3)).to_numpy()
    x, y = pdf[feats].to_numpy(), pdf["y"].to_numpy()
    for k in range(5):
        tr = fold != k
        z = (x - x[tr].mean(axis=0)) / x[tr].std(axis=0, ddof=1)
        for d in range(1, 10):
            design = np.column_stack([np.ones(n), *[z**i for i in range(1, d + 1)]])
            beta = np.linalg.lstsq(design[tr], np.log(y[tr]), rcond=None)[0]
            e = np.exp(design[~tr] @ beta) - y[~tr]
            assert np.isclose(got.loc[(k, float(d)), "mse"], np.mean(e**2), rtol=1e-6)
