"""Odd inputs, both sides of every size threshold, and the full choice of
losses, penalties and metrics in sweeps and cross-validation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions.metrics import Metric
from tessera.operators import diagnostics, kmeans, moments, prep, profile, regress as rg
from tessera.operators.features import power_feature_names
from tessera.operators.split import kfold, train_test_split
from tessera.plans import select as sel

from houses import to_spark


@pytest.fixture(scope="module")
def xy(spark):
    rng = np.random.default_rng(3)
    n = 160
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(2, 3, n)})
    pdf["y"] = 1 + 2 * pdf.a - 0.5 * pdf.b + rng.normal(0, 0.3, n)
    return pdf, to_spark(spark, pdf, "id long, a double, b double, y double", partitions=3).cache()


def loop(x, y, loss, alpha, kind, ratio, lr, epochs):
    """Subgradient descent, row by row, for one model."""
    a = np.column_stack([np.ones(len(x)), x])
    b, best, low = np.zeros(a.shape[1]), None, np.inf
    share = {None: 0.0, "l1": 1.0, "l2": 0.0, "elasticnet": ratio}[kind]
    w1, w2 = alpha * share * (kind is not None), alpha * (1 - share) * (kind is not None)
    for _ in range(epochs):
        e = a @ b - y
        base = {"mse": np.mean(e**2), "l2": np.sqrt(e @ e), "mae": np.abs(e).mean(), "l1": np.abs(e).sum()}[loss]
        grad = {"mse": 2 / len(y) * a.T @ e, "l2": a.T @ e / np.sqrt(e @ e), "mae": a.T @ np.sign(e) / len(y), "l1": a.T @ np.sign(e)}[loss]
        value = base + w1 * np.abs(b[1:]).sum() + w2 * (b[1:] ** 2).sum() / 2
        pen = w1 * np.sign(b) + w2 * b
        pen[0] = 0
        new = b - lr * (grad + pen)
        if value < low:
            low, best = value, new
        b = new
    return best


@pytest.mark.parametrize("loss, lr", [("mse", 0.02), ("l2", 0.05), ("mae", 0.2), ("l1", 0.001)])
@pytest.mark.parametrize("kind", [None, "l1", "l2", "elasticnet"])
def test_sweep_fits_every_loss_and_penalty(xy, loss, lr, kind):
    pdf, df = xy
    grid = [0.0, 0.3]
    res = sel.lambda_sweep(df, ["a", "b"], "y", ["id"], grid, normalize=False, metrics=("mae", "l1", "mse", "r2", "l2"),
                           fit_params={"method": "gradient_descent", "loss": loss, "regularization": kind, "l1_ratio": 0.3,
                                       "learning_rate": lr, "epochs": 25, "tolerance": 1e-300})
    split = train_test_split(df, ["id"]).toPandas().sort_values("id")
    tr, te = split[~split.is_test], split[split.is_test]
    weights, curve = res.weights.toPandas(), res.curve.orderBy("position").toPandas()
    for l, v in enumerate(grid):
        b = loop(tr[["a", "b"]].values, tr.y.values, loss, v, kind, 0.3, lr, 25)
        got = weights[weights.position == l].set_index("feature").weight
        assert np.allclose([got["a"], got["b"]], b[1:], rtol=1e-8)
        e = np.column_stack([np.ones(len(te)), te[["a", "b"]].values]) @ b - te.y.values
        want = [np.abs(e).mean(), np.abs(e).sum(), (e**2).mean(), 1 - (e @ e) / ((te.y - te.y.mean()) ** 2).sum(), np.sqrt(e @ e)]
        assert np.allclose(curve.loc[l, ["mae", "l1", "mse", "r2", "l2"]].astype(float), want, rtol=1e-8)


def test_cv_absolute_loss_own_metric_and_callables(xy):
    pdf, df = xy
    worst = Metric("worst", True, lambda y, p: F.max(F.abs(p - y)))
    res = sel.cv_lambda(df.withColumn("y", F.exp(F.col("y") / 4)), ["a", "b"], "y", ["id"], [0.0, 0.2], n_splits=3, degree=2,
                        transform_target=F.log, inverse=F.exp, metrics=("mae", worst),
                        fit_params={"method": "gradient_descent", "loss": "mae", "regularization": "l2", "learning_rate": 0.1,
                                    "epochs": 12, "tolerance": 1e-300})
    folds = kfold(df, ["id"], 3).toPandas().sort_values("id")
    got = res.folds.toPandas().set_index(["fold", "position"])
    for k in range(3):
        tr, va = folds[folds.fold != k], folds[folds.fold == k]
        m, s = tr[["a", "b"]].mean().values, tr[["a", "b"]].std().values
        poly = lambda f: np.hstack([(f[["a", "b"]].values - m) / s, ((f[["a", "b"]].values - m) / s) ** 2])
        for l, v in enumerate((0.0, 0.2)):
            b = loop(poly(tr), tr.y.values / 4, "mae", v, "l2", 0.5, 0.1, 12)
            e = np.exp(np.column_stack([np.ones(len(va)), poly(va)]) @ b) - np.exp(va.y.values / 4)
            assert np.allclose(got.loc[(k, l), ["mae", "worst"]].astype(float), [np.abs(e).mean(), np.abs(e).max()], rtol=1e-7)


def test_cv_degrees_with_absolute_loss(xy):
    _, df = xy
    fit = {"method": "gradient_descent", "loss": "l1", "learning_rate": 1e-4, "epochs": 8}
    both = sel.cv_degree(df, ["a", "b"], "y", ["id"], [1, 2], n_splits=3, fit_params=fit).curve.toPandas()
    one = sel.cv_degree(df, ["a", "b"], "y", ["id"], [1], n_splits=3, fit_params=fit).curve.toPandas()
    assert np.isclose(both.mse[0], one.mse[0]) and not np.isclose(both.mse[0], both.mse[1])


def test_invalid_grid_values_raise(xy):
    _, df = xy
    for kw in ({"fit_params": {"regularization": "l1"}}, {"fit_params": {"regularization": "elasticnet"}}):
        with pytest.raises(ValueError):
            sel.lambda_sweep(df, ["a"], "y", ["id"], [0.0, 1.0], **kw)
        with pytest.raises(ValueError):
            sel.cv_lambda(df, ["a"], "y", ["id"], [0.0, 1.0], **kw)
    for call in (sel.lambda_sweep, sel.cv_lambda):
        with pytest.raises(ValueError):
            call(df, ["a"], "y", ["id"], [-5.0])
    with pytest.raises(ValueError):
        rg.r_step(np.eye(3), 3, "mae")


def test_r2_survives_a_large_mean_and_an_empty_test_side(xy):
    _, df = xy
    big = df.withColumn("y", F.col("y") + 1e8)
    plain = sel.lambda_sweep(big, ["a", "b"], "y", ["id"], [0.0], metrics=("r2",)).curve.first()["r2"]
    same = sel.lambda_sweep(big, ["a", "b"], "y", ["id"], [0.0], metrics=("r2", "mae")).curve.first()["r2"]
    assert plain > 0.9 and np.isclose(plain, same, rtol=1e-6)
    none = sel.lambda_sweep(df, ["a"], "y", ["id"], [0.0, 1.0], test_size=0.001)
    assert [r["mse"] for r in none.curve.collect()] == [None, None] and none.weights.count() == 2 and none.best == {}


def test_duplicate_keys_raise(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"))
    with pytest.raises(ValueError):
        train_test_split(df, ["k"])
    with pytest.raises(ValueError):
        kfold(df, ["k"], 4)


def test_null_group_keeps_null_on_both_sides_of_the_inline_limit(spark):
    for n in (prep.MAX_INLINE_GROUPS - 1, prep.MAX_INLINE_GROUPS + 1):
        rows = [(i, float(i)) for i in range(n)] + [(None, 9.0), (None, None), (3, None)]
        got = prep.impute_group_mean(spark.createDataFrame(rows, "g int, v double"), ["v"], "g")
        assert [r["v"] for r in got.filter("g is null").orderBy(F.col("v").asc_nulls_first()).collect()] == [None, 9.0]
        assert [r["v"] for r in got.filter("g = 3").collect()] == [3.0, 3.0]


@pytest.mark.parametrize("width", [3, 13])
def test_constant_columns_have_no_correlation(spark, width):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({f"c{i}": rng.normal(size=50) for i in range(width)})
    pdf["k"] = 0.1
    got = profile.corr_matrix(spark.createDataFrame(pdf)).toPandas().set_index(["a", "b"]).r
    assert got.xs("k", level=0).isna().all() and got.xs("k", level=1).isna().all()
    assert np.allclose(got[("c0", "c1")], pdf.c0.corr(pdf.c1)) and np.isclose(got[("c2", "c2")], 1)


def test_nan_points_belong_to_no_cluster(spark):
    for d in (2, 40):
        rows = [([float(i % 2) * 10 + j for j in range(d)],) for i in range(20)] + [([float("nan")] * d,), (None,)]
        df = spark.createDataFrame(rows, "p array<double>")
        pts = [F.col("p").getItem(j) for j in range(d)]
        m = kmeans.kmeans_fit(df, pts, k=2, init=[[float(j) for j in range(d)], [9.0 + j for j in range(d)]])
        assert np.isfinite(m.centers).all() and m.converged
        assert sorted(str(r["zone"]) for r in m.predict(df, pts).collect()) == ["0"] * 10 + ["1"] * 10 + ["None"] * 2


def test_no_values_and_equal_values_give_rows_not_errors(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "x double, y double")
    assert profile.histogram(df, "x").collect() == [] and profile.kde_grid(df, "x").collect() == []
    assert profile.binned_scatter(df, "x", "y").collect() == [] and profile.pair_bins(df, ["x", "y"]).collect() == []
    assert diagnostics.normal_pdf_overlay(df, "y").collect() == [] == diagnostics.normal_pdf_overlay(df, "x").collect()
    assert profile.histogram(df, "y").first()["count"] == 2


def test_power_features_have_no_default_cap(spark):
    df = spark.createDataFrame([tuple(range(10))], ", ".join(f"c{i} int" for i in range(10)))
    assert len(power_feature_names(df)) == 390 and len(power_feature_names(df, cap=7)) == 7


def test_wide_models_predict_alike_on_both_sides(spark, xy, monkeypatch):
    _, df = xy
    m = rg.fit(df, ["a", "b"], "y", degree=4)
    rows = df.withColumn("a", F.when(F.col("id") != 5, F.col("a")))
    want = [r["prediction"] for r in m.predict(rows).orderBy("id").collect()]
    monkeypatch.setattr(rg, "WIDE_TERMS", 3)
    got = [r["prediction"] for r in m.predict(rows).orderBy("id").collect()]
    assert got[5] is want[5] is None
    assert np.allclose([g for g in got if g is not None], [w for w in want if w is not None])


def test_1500_terms_compile(spark):
    feats = tuple(f"f{i}" for i in range(1500))
    df = spark.createDataFrame([tuple([1.0] * 1500)], ", ".join(f"{f} double" for f in feats))
    m = rg.LinearModel(feats, 1, feats, 0.5, tuple([2.0] * 1500))
    assert m.predict(df).first()["prediction"] == 3000.5


def test_factors_agree_across_tree_and_memory_limits(xy, monkeypatch):
    _, df = xy
    cols = [F.lit(1.0), F.col("a"), F.col("y")]
    group = F.col("id") % 7
    want = moments.tsqr(df, cols, group, tree=False)
    monkeypatch.setattr(moments, "HELD_BYTES", 0)
    got = moments.tsqr(df.repartition(9), cols, group, fan_in=2, tree=True)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][1] == want[g][1]
        assert np.allclose(got[g][0].T @ got[g][0], want[g][0].T @ want[g][0])


def test_nan_rows_are_incomplete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (float("nan"), 1.0), (3.0, 6.0)], "x double, y double")
    m = rg.fit_ols(df, ["x"], "y")
    assert np.allclose([m.intercept, *m.coef], [0, 2], atol=1e-12) and m.info["n"] == 3


def test_spread_and_staging_run_no_job(spark):
    df = spark.range(1000).repartition(5).groupBy((F.col("id") % 10).alias("k")).count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quiet", "quiet")
    session.spread(df)
    with session.staged(df):
        pass
    assert len(tracker.getJobIdsForGroup("quiet")) == 0
    spark.sparkContext.setJobGroup("idle", "idle")


def test_null_segment_and_segment_named_like_the_total(spark):
    rng = np.random.default_rng(4)
    rows = [(s, float(x), float(3.0 * x + b)) for s, b in (("all", 1.0), (None, 2.0), ("z", 5.0)) for x in rng.normal(size=20)]
    df = spark.createDataFrame(rows, "seg string, x double, y double")
    coefs = sel.segment_fit(df, ["x"], "y", "seg")
    got = {(r["segment"], r["is_total"]): r["coefficient"] for r in coefs.filter("term = 'intercept'").collect()}
    assert np.isclose(got[("all", False)], 1) and np.isclose(got[(None, False)], 2) and ("all", True) in got and len(got) == 4
    impact = sel.feature_impact(coefs, df, "seg", "y", "x").collect()
    assert len(impact) == 4 and all(r["average_target"] is not None for r in impact)
    with pytest.raises(ValueError):
        sel.feature_impact(coefs, df.filter("seg = 'z'"), "seg", "y", "x")


def test_wide_fit_folds_stacks_of_bounded_size(spark, monkeypatch):
    """A batch far above the stack is folded in pieces that stay in the cache."""
    seen, qr = [], moments._qr_r
    monkeypatch.setattr(moments, "_qr_r", lambda m, k: (seen.append(len(m)), qr(m, k))[1])
    x = np.random.default_rng(22).normal(size=(10_000, 40))
    factors = moments._Factors(40)
    factors.add(None, x)
    factors.handed_on(0)
    assert max(seen) <= 8 * 40 + 40 and len(seen) == 32
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(limit)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:60]], ", ".join(f"c{i} double" for i in range(40)))
    ((r, n),) = moments.tsqr(df, [F.col(c) for c in df.columns]).values()
    assert n == 60 and np.allclose(r.T @ r, x[:60].T @ x[:60])
    assert spark.conf.get(limit) == "8000"
    spark.conf.unset(limit)
