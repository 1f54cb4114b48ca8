import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import regress as rg
from tessera.operators.evaluate import evaluate_dict, loss_gradient, regularized_loss
from tessera.operators.kmeans import WIDE, kmeans_fit
from tessera.operators.moments import tsqr

from houses import to_spark


@pytest.fixture
def linear_exact(spark):
    rng = np.random.default_rng(5)
    x1, x2 = rng.normal(size=300), rng.normal(size=300)
    pdf = pd.DataFrame({"id": np.arange(300), "x1": x1, "x2": x2, "y": 3 + 2 * x1 - x2})
    return pdf, to_spark(spark, pdf, "id long, x1 double, x2 double, y double", partitions=5)


def test_ols_exact(linear_exact):
    _, df = linear_exact
    m = rg.fit_ols(df, ["x1", "x2"], "y")
    assert np.allclose([m.intercept, *m.coef], [3, 2, -1], atol=1e-10)
    assert m.term_names == ("x1", "x2")


def test_minimum_norm_on_collinear(spark):
    # x = x_zone_0 + x_zone_1: rank-deficient design, as in the engineered fixture
    rng = np.random.default_rng(8)
    x = rng.uniform(1, 10, 120)
    z = rng.integers(0, 2, 120)
    pdf = pd.DataFrame({"x": x, "x_zone_0": x * (z == 0), "x_zone_1": x * (z == 1), "y": 1 + 2 * x + rng.normal(0, 0.1, 120)})
    df = to_spark(spark, pdf, "x double, x_zone_0 double, x_zone_1 double, y double", partitions=3)
    m = rg.fit_ols(df, ["x", "x_zone_0", "x_zone_1"], "y")
    a = np.column_stack([np.ones(120), pdf[["x", "x_zone_0", "x_zone_1"]].values])
    want = np.linalg.lstsq(a, pdf["y"].values, rcond=None)[0]
    assert np.allclose([m.intercept, *m.coef], want, rtol=1e-9, atol=1e-9)


def test_ridge_zero_is_ols_and_shrinks(linear_exact):
    pdf, df = linear_exact
    ols = rg.fit_ols(df, ["x1", "x2"], "y")
    r0 = rg.fit(df, ["x1", "x2"], "y", regularization="l2", alpha=0.0)
    assert np.allclose(ols.coef, r0.coef)
    r = rg.fit_ridge(df, ["x1", "x2"], "y", alpha=50.0)
    a = np.column_stack([np.ones(300), pdf[["x1", "x2"]].values])
    eye = np.eye(3)
    eye[0, 0] = 0
    want = np.linalg.solve(a.T @ a + 50 * eye, a.T @ pdf["y"].values)
    assert np.allclose([r.intercept, *r.coef], want, atol=1e-10)


def test_poly_degree_one_equals_linear(linear_exact):
    _, df = linear_exact
    assert np.allclose(rg.fit_poly(df, ["x1", "x2"], "y", degree=1).coef, rg.fit_linear(df, ["x1", "x2"], "y").coef)
    p2 = rg.fit_poly(df, ["x1"], "y", degree=2)
    assert p2.term_names == ("x1", "x1^2")


def test_partition_invariance(spark, linear_exact):
    pdf, _ = linear_exact
    a = rg.fit_ols(to_spark(spark, pdf, partitions=1), ["x1", "x2"], "y")
    b = rg.fit_ols(to_spark(spark, pdf, partitions=11), ["x1", "x2"], "y")
    assert np.allclose(a.coef, b.coef, atol=1e-12)


def test_wide_design_of_full_rank(spark, monkeypatch):
    """300 independent regressors against lstsq, and their wide prediction."""
    from tessera.operators import moments

    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 300)) * 10.0 ** rng.integers(-2, 3, 300)
    y = x @ rng.normal(size=300) + 4 + rng.normal(size=900)
    names = [f"x{i}" for i in range(300)]
    pdf = pd.DataFrame(x, columns=names).assign(y=y)
    pdf.loc[5, "x7"] = np.nan
    df = to_spark(spark, pdf, ", ".join(f"{c} double" for c in pdf.columns), partitions=3)
    known = pdf.dropna()
    a = np.column_stack([np.ones(len(known)), known[names].to_numpy()])
    want = np.linalg.lstsq(a, known["y"].to_numpy(), rcond=None)[0]
    for stack in (moments.STACK_WIDTHS, 1):
        monkeypatch.setattr(moments, "STACK_WIDTHS", stack)
        m = rg.fit_ols(df, names, "y")
        assert np.allclose([m.intercept, *m.coef], want, rtol=1e-8, atol=1e-9)
    got = m.predict(df).select("y", "prediction").toPandas().sort_values("y")
    expected = pd.Series(want[0] + pdf[names].to_numpy() @ want[1:], index=pdf.y).sort_index()
    assert got["prediction"].isna().sum() == 1
    assert np.allclose(got["prediction"].to_numpy(float), expected.to_numpy(), equal_nan=True)


def test_wide_powers_of_several_columns(spark):
    """Powers 1..39 of eight columns: 312 terms, checked against lstsq."""
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(rng.uniform(-1, 1, size=(1500, 8)), columns=[f"x{i}" for i in range(8)])
    pdf["y"] = np.sin(3 * pdf.x0) + pdf.x1**3 + rng.normal(size=1500) / 10
    df = to_spark(spark, pdf, ", ".join(f"{c} double" for c in pdf.columns), partitions=2)
    m = rg.fit(df, list(pdf.columns[:8]), "y", degree=39)
    design = np.column_stack([np.ones(1500), *[pdf.iloc[:, :8].to_numpy() ** i for i in range(1, 40)]])
    want = design @ np.linalg.lstsq(design, pdf.y.to_numpy(), rcond=np.finfo(float).eps * 1500)[0]
    got = m.predict(df).select("x0", "prediction").toPandas().sort_values("x0")["prediction"].to_numpy()
    assert np.allclose(got, pd.Series(want, index=pdf.x0).sort_index().to_numpy(), atol=1e-4)


def test_tsqr_tree_merge(spark, linear_exact):
    pdf, _ = linear_exact
    df = to_spark(spark, pdf, partitions=9)
    cols = [F.lit(1.0), F.col("x1"), F.col("x2"), F.col("y")]
    ((r, n),) = tsqr(df, cols, fan_in=2).values()
    a = np.column_stack([np.ones(300), pdf[["x1", "x2", "y"]].values])
    assert n == 300 and np.allclose(r.T @ r, a.T @ a, rtol=1e-12, atol=1e-9)


def test_gradient_descent_matches_numpy_loop(linear_exact):
    pdf, df = linear_exact
    m = rg.fit_gd(df, ["x1", "x2"], "y", learning_rate=0.05, epochs=200, tolerance=1e-300)
    a = np.column_stack([np.ones(300), pdf[["x1", "x2"]].values])
    y = pdf["y"].values
    b = np.zeros(3)
    for _ in range(200):
        b = b - 0.05 * (2 / 300) * a.T @ (a @ b - y)
    assert np.allclose([m.intercept, *m.coef], b, atol=1e-9)
    assert len(m.history) == 200 and not m.info["rested"]


def test_gd_converges_and_absolute_loss(linear_exact):
    _, df = linear_exact
    m = rg.fit_gd(df, ["x1", "x2"], "y", learning_rate=0.1, epochs=2000, tolerance=1e-10)
    assert m.info["rested"] and np.allclose([m.intercept, *m.coef], [3, 2, -1], atol=1e-3)
    mae = rg.fit_gd(df, ["x1"], "y", loss="mae", learning_rate=0.5, epochs=15, tolerance=1e-12)
    assert len(mae.history) == 15 and mae.history[-1] < mae.history[0]


def test_penalised_gd_and_elasticnet(linear_exact):
    _, df = linear_exact
    lasso = rg.fit_gd(df, ["x1", "x2"], "y", regularization="l1", alpha=0.5, learning_rate=0.05, epochs=500)
    ridge = rg.fit_gd(df, ["x1", "x2"], "y", regularization="l2", alpha=0.5, learning_rate=0.05, epochs=500)
    enet = rg.fit_gd(df, ["x1", "x2"], "y", regularization="elasticnet", alpha=0.5, l1_ratio=0.3, learning_rate=0.05, epochs=500)
    for m in (lasso, ridge, enet):
        assert abs(m.coef[0]) < 2


def test_argument_rules(linear_exact):
    _, df = linear_exact
    for kwargs in (
        {"method": "newton"},
        {"loss": "huber"},
        {"regularization": "l3"},
        {"regularization": "l2", "alpha": -1},
        {"regularization": "l1", "alpha": 1.0},
        {"regularization": "elasticnet", "alpha": 1.0},
        {"method": "gradient_descent", "learning_rate": 0},
    ):
        with pytest.raises(ValueError):
            rg.fit(df, ["x1"], "y", **kwargs)
    with pytest.raises(ValueError):
        rg.fit_linear(df, ["x1"], "y", degree=2)


def test_predict_binds_by_name_and_residuals_orthogonal(linear_exact):
    pdf, df = linear_exact
    noisy = df.withColumn("y", F.col("y") + F.sin(F.col("id")))
    m = rg.fit_ols(noisy, ["x1", "x2"], "y")
    scored = m.predict(noisy.select("x2", "y", "x1"))
    row = scored.agg(*[F.sum((F.col("y") - F.col("prediction")) * F.col(c)).alias(c) for c in ("x1", "x2")]).first()
    assert abs(row["x1"]) < 1e-8 and abs(row["x2"]) < 1e-8
    with pytest.raises(ValueError):
        m.predict(noisy.select("x1", "y"))
    metrics = evaluate_dict(scored, "y", "prediction", ["mse", "r2", "mae", "l1", "l2"])
    e = scored.toPandas()
    err = e["prediction"] - e["y"]
    assert np.isclose(metrics["mse"], np.mean(err**2)) and np.isclose(metrics["l1"], np.abs(err).sum())
    assert np.isclose(metrics["r2"], 1 - (err**2).sum() / ((e["y"] - e["y"].mean()) ** 2).sum())


def test_loss_and_gradient_aggregates(linear_exact):
    pdf, df = linear_exact
    beta = [1.0, 0.5, 0.25]
    terms = [F.lit(1.0), F.col("x1"), F.col("x2")]
    a = np.column_stack([np.ones(300), pdf[["x1", "x2"]].values])
    e = a @ beta - pdf["y"].values
    assert np.isclose(regularized_loss(df, "y", terms, beta, "mse", "l2", 2.0), np.mean(e**2) + 0.5 * 2 * (0.25 + 0.0625))
    g = loss_gradient(df, "y", terms, beta, "mae")
    assert np.allclose(g, a.T @ np.sign(e) / 300)


def test_constant_target_r2_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert evaluate_dict(df, "y", "p", ["r2"])["r2"] is None


# ------------------------------------------------------------------ k-means

def _lloyd(x, centers, iters):
    for _ in range(iters):
        d = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        lab = d.argmin(axis=1)
        new = centers.copy()
        for j in range(len(centers)):
            if (lab == j).any():
                new[j] = x[lab == j].mean(axis=0)
        centers = new
    return centers


@pytest.mark.parametrize("held", [True, False])
def test_kmeans_matches_numpy_lloyd(spark, monkeypatch, held):
    import tessera.operators.kmeans as km

    monkeypatch.setattr(km, "can_hold", lambda df: held)  # False: codegen'd groupBy path
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (100, 2)), rng.normal(6, 1, (100, 2))])
    pdf = pd.DataFrame({"id": np.arange(200), "a": x[:, 0], "b": x[:, 1]})
    df = to_spark(spark, pdf, "id long, a double, b double", partitions=4)
    init = [[0.0, 0.0], [1.0, 1.0], [6.0, 6.0]]
    df = spark.createDataFrame(pdf) if held else df
    m = kmeans_fit(df, ["a", "b"], k=3, max_iter=5, tol=-1.0, init=init)
    assert np.allclose(np.array(m.centers), _lloyd(x, np.array(init), 5), atol=1e-10)


def test_kmeans_paths_agree(spark, monkeypatch):
    """All rounds in one job, a codegen'd expression per round, and vectorised
    partial sums per round give the same centres and labels."""
    import tessera.operators.kmeans as km

    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 3))
    pdf = pd.DataFrame({"id": np.arange(150), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    df = to_spark(spark, pdf, "id long, a double, b double, c double", partitions=3)
    results = []
    for wide, held in ((10_000, False), (1, False), (1, True)):
        monkeypatch.setattr(km, "WIDE", wide)
        monkeypatch.setattr(km, "can_hold", lambda df, held=held: held)
        m = kmeans_fit(df, ["a", "b", "c"], k=3, max_iter=6, key_cols=["id"])
        labels = m.predict(df, ["a", "b", "c"]).orderBy("id").select("zone").toPandas()["zone"].values
        results.append((np.array(m.centers), labels))
    for centers, labels in results[1:]:
        assert np.allclose(results[0][0], centers, atol=1e-10)
        assert (results[0][1] == labels).all()
    assert WIDE >= 1


def test_bounded_rows_skip_centres_and_keep_labels():
    """Labels under carried bounds equal full assignment in every round, ties
    and empty clusters included, and later rounds look at fewer rows."""
    from tessera.operators.kmeans import BoundedRows, _nearest, _sums, lloyd

    rng = np.random.default_rng(13)
    centres = rng.normal(size=(10, 64)) * 4
    x = centres[rng.integers(0, 10, 3000)] + rng.normal(size=(3000, 64))
    bounded, looked = BoundedRows(x), []

    def sums_of(c, shifts):
        before = bounded.looked
        labels = bounded.assign(c, shifts)
        looked.append(bounded.looked - before)
        assert (labels == _nearest(x, c)).all()
        return _sums(x, labels, len(c))

    start = np.vstack([x[:9], np.full(64, 1e6)])  # the last one stays empty
    found, rounds, _, stopped = lloyd(start, sums_of, 1e-4, 100)
    assert stopped and (found[9] == 1e6).all() and looked[0] == 3000 and looked[-1] < 300
    grid = np.array([[i, j] for i in range(6) for j in range(6)], float)  # many ties
    bounded = BoundedRows(grid)
    lloyd(grid[[0, 35, 14]], lambda c, s: _sums(grid, _check(bounded, c, s, grid, _nearest), 3), -1.0, 8)


def _check(bounded, c, shifts, x, nearest):
    labels = bounded.assign(c, shifts)
    assert (labels == nearest(x, c)).all()
    return labels


def test_kmeans_and_absolute_descent_run_a_fixed_number_of_jobs(spark):
    rng = np.random.default_rng(14)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["a", "b", "y"])
    df = spark.createDataFrame(pdf.assign(id=np.arange(400)))  # of known size
    sc = spark.sparkContext
    jobs = {}
    for name, run in {
        "k3": lambda: kmeans_fit(df, ["a", "b"], k=4, max_iter=3, tol=-1, key_cols=["id"]),
        "k40": lambda: kmeans_fit(df, ["a", "b"], k=4, max_iter=40, tol=-1, key_cols=["id"]),
        "e3": lambda: rg.fit_gd(df, ["a", "b"], "y", loss="mae", epochs=3, tolerance=1e-300),
        "e1000": lambda: rg.fit_gd(df, ["a", "b"], "y", loss="mae", epochs=1000, tolerance=1e-300),
    }.items():
        sc.setJobGroup(f"fixed-{name}", name)
        run()
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"fixed-{name}"))
    sc.setJobGroup("idle", "idle")
    assert jobs["k3"] == jobs["k40"] and jobs["e3"] == jobs["e1000"]


@pytest.mark.parametrize("loss", ["mae", "l1"])
def test_absolute_descent_ways_agree(spark, monkeypatch, loss):
    """One job for all epochs, rows beyond its memory, and one job per epoch."""
    from tessera.operators import rounds

    rng = np.random.default_rng(15)
    pdf = pd.DataFrame(rng.normal(size=(300, 2)), columns=["a", "y"])
    pdf.loc[4, "a"] = np.nan
    df = spark.createDataFrame(pdf)  # of known size
    assert rounds.can_hold(df)

    def fitted():
        m = rg.fit_gd(df, ["a"], "y", degree=2, loss=loss, learning_rate=0.01 if loss == "mae" else 1e-4, epochs=5, tolerance=1e-300)
        return np.array([m.intercept, *m.coef, *m.history])

    want = fitted()
    monkeypatch.setattr(rounds, "TASK_BYTES", 1)  # as many tasks as run at once
    assert np.allclose(fitted(), want, rtol=1e-9)
    monkeypatch.setattr(rounds, "HELD_BYTES", 100)
    assert np.allclose(fitted(), want, rtol=1e-9)
    monkeypatch.setattr(rg, "can_hold", lambda df: False)
    assert np.allclose(fitted(), want, rtol=1e-9)
    with pytest.raises(ValueError, match="no complete rows"):
        rg.fit_gd(df.filter("a is null"), ["a"], "y", loss=loss)


@pytest.mark.parametrize("exclude", [True, False])
def test_ridge_grid_equals_single_solutions(exclude):
    rng = np.random.default_rng(16)
    for x in (rng.normal(size=(50, 4)), np.repeat(rng.normal(size=(50, 2)), 2, axis=1)):
        a = np.column_stack([np.ones(50), x * 100, rng.normal(size=50)])
        r = np.linalg.qr(a, mode="r")
        alphas = [0.0, 1e-3, 1.0, 1e5]
        for alpha, got in zip(alphas, rg.solve_ridge_grid(r, 50, alphas, exclude)):
            want = rg.solve_ridge(r, alpha, exclude_intercept=exclude) if alpha else rg.solve_ols(r, 50)
            assert np.allclose(got, want, rtol=1e-7, atol=1e-9)


def test_kmeans_ties_empty_cluster_and_nulls(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0), (1, 3.0, 0.0), (2, None, 1.0)], "id long, a double, b double")
    # the point (1,0) is half-way between centres 0 and 2 -> lowest index; centre 2 at (100,100) gets no point
    m = kmeans_fit(df, ["a", "b"], k=3, max_iter=1, tol=-1, init=[[0.0, 0.0], [2.0, 0.0], [100.0, 100.0]])
    assert m.centers[2] == (100.0, 100.0)
    labels = {r["id"]: r["zone"] for r in m.predict(df, ["a", "b"]).collect()}
    assert labels[2] is None
    tie = kmeans_fit(df.filter("id = 0"), ["a", "b"], k=2, max_iter=1, tol=-1, init=[[0.0, 0.0], [2.0, 0.0]])
    lab = tie.predict(spark.createDataFrame([(1.0, 0.0)], "a double, b double"), ["a", "b"]).first()["zone"]
    assert lab == 0


def test_kmeans_sse_never_increases(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    pdf = pd.DataFrame({"id": np.arange(300), "a": x[:, 0], "b": x[:, 1]})
    df = to_spark(spark, pdf, "id long, a double, b double")
    sse = []
    for it in range(1, 5):
        m = kmeans_fit(df, ["a", "b"], k=4, max_iter=it, tol=-1, key_cols=["id"])
        c = np.array(m.centers)
        sse.append(((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum())
    assert all(b <= a + 1e-9 for a, b in zip(sse, sse[1:]))


def test_grid_gradient_descent_equals_single_runs(linear_exact):
    pdf, df = linear_exact
    noisy = df.withColumn("y", F.col("y") + F.sin(F.col("id")))
    ((r, n),) = tsqr(noisy, [F.lit(1.0), F.col("x1"), F.col("x2"), F.col("y")]).values()
    for reg, loss, solver in (("l1", "mse", "subgradient"), ("l2", "l2", "subgradient"), ("elasticnet", "mse", "subgradient"),
                              ("l1", "mse", "proximal"), ("elasticnet", "l2", "proximal")):
        spec = rg.FitSpec(method="gradient_descent", loss=loss, regularization=reg, learning_rate=0.05, epochs=300,
                          tolerance=1e-9, solver=solver)
        alphas = [0.0, 0.1, 1.0, 5.0]
        grid = rg.gradient_descent_grid(r, n, spec, alphas)
        for j, a in enumerate(alphas):
            one = rg.fit_from_r(r, n, ("x1", "x2"), 1, ("x1", "x2"), rg.FitSpec(**{**spec.__dict__, "alpha": a}))
            assert np.allclose(grid[:, j], [one.intercept, *one.coef], atol=1e-12)


def test_proximal_lasso_exact_zeros_and_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(21)
    n = 400
    x = rng.normal(size=(n, 3))
    y = 1.0 + 2.0 * x[:, 0] + 0.01 * x[:, 2] + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})
    df = to_spark(spark, pdf, "a double, b double, c double, y double", partitions=3)
    alpha = 0.2
    m = rg.fit_gd(df, ["a", "b", "c"], "y", regularization="l1", alpha=alpha, solver="proximal",
                  learning_rate=0.1, epochs=5000, tolerance=1e-14)
    assert m.coef[1] == 0.0 and m.coef[2] == 0.0 and m.coef[0] > 1.5
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="f").transform(df)
    ml = LinearRegression(featuresCol="f", labelCol="y", regParam=alpha / 2, elasticNetParam=1.0,
                          standardization=False, tol=1e-12, maxIter=1000).fit(vec)
    assert np.allclose([m.intercept, *m.coef], [ml.intercept, *ml.coefficients.toArray()], atol=1e-4)
    with pytest.raises(ValueError):
        rg.fit_gd(df, ["a"], "y", solver="newton")


def test_mllib_backend_agrees_on_separated_clusters(spark):
    from tessera.operators.kmeans import kmeans_fit_mllib

    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(0, 0.3, (150, 2)), rng.normal(5, 0.3, (150, 2)), rng.normal((0, 5), 0.3, (150, 2))])
    pdf = pd.DataFrame({"id": np.arange(450), "a": x[:, 0], "b": x[:, 1]})
    df = to_spark(spark, pdf, "id long, a double, b double", partitions=3)
    ours = sorted(kmeans_fit(df, ["a", "b"], k=3, key_cols=["id"]).centers)
    ml = sorted(kmeans_fit_mllib(df, ["a", "b"], k=3).centers)
    assert np.allclose(ours, ml, atol=1e-6)


def test_ridge_matches_mllib_mapping(spark):
    """Closed-form ridge with penalty alpha equals MLlib's ridge with
    regParam = alpha * sample_std(y) / n (no standardisation, L-BFGS)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(31)
    n = 500
    x = rng.normal(size=(n, 2))
    y = 4.0 + 1.5 * x[:, 0] - 2.0 * x[:, 1] + rng.normal(0, 0.5, n)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y})
    df = to_spark(spark, pdf, "a double, b double, y double", partitions=2)
    alpha = 40.0
    ours = rg.fit_ridge(df, ["a", "b"], "y", alpha=alpha)
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    ml = LinearRegression(featuresCol="f", labelCol="y", regParam=alpha * pdf["y"].std() / n, elasticNetParam=0.0,
                          standardization=False, solver="l-bfgs", tol=1e-12, maxIter=500).fit(vec)
    assert np.allclose([ours.intercept, *ours.coef], [ml.intercept, *ml.coefficients.toArray()], rtol=1e-4, atol=1e-4)


def test_bounded_rows_hold_little_beside_the_rows():
    """Rounds work in parts: beside the rows, a label and two bounds of each."""
    import tracemalloc

    from tessera.operators.kmeans import BOUND_BYTES, PART_BYTES, BoundedRows
    from tessera.operators.rounds import Rows

    x = np.random.default_rng(23).normal(size=(600_000, 2))
    tracemalloc.start()
    held = Rows(2)
    for at in range(0, len(x), 10_000):
        held.add(x[at : at + 10_000])
    assert tracemalloc.get_traced_memory()[1] < 2.3 * x.nbytes and (held.rows() == x).all()
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    bounded, centers = BoundedRows(held.rows()), np.array([[0.0, 0.0], [1.0, 1.0]])
    bounded.assign(centers, None)
    bounded.assign(centers + 0.1, np.full(2, np.sqrt(0.02)))
    sums = bounded.sums(2)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert sums[:, 2].sum() == len(x) and peak < BOUND_BYTES * len(x) + 8 * PART_BYTES


@pytest.mark.parametrize("loss", ["mae", "l1"])
def test_absolute_descent_needs_few_jobs_beyond_memory(spark, monkeypatch, loss):
    """Rows that no task holds: far fewer passes than epochs, the same epochs."""
    from tessera.operators import signed

    rng = np.random.default_rng(24)
    x, y = rng.normal(size=3000), rng.normal(size=3000) * 3 + 5
    x[:40], y[:40] = 0.0, 2.0  # equal rows
    pdf = pd.DataFrame({"x": x, "y": y})
    df = to_spark(spark, pdf, "x double, y double", partitions=3)
    monkeypatch.setattr(rg, "can_hold", lambda df: False)
    monkeypatch.setattr(signed, "NEAR_BYTES", 24 * 400)
    rate, epochs = (0.5 if loss == "mae" else 0.5 / 3000), 150
    spark.sparkContext.setJobGroup(f"signed-{loss}", loss)
    m = rg.fit_gd(df, ["x"], "y", loss=loss, learning_rate=rate, epochs=epochs, tolerance=1e-300)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"signed-{loss}"))
    spark.sparkContext.setJobGroup("idle", "idle")
    a, b, history = np.column_stack([np.ones(3000), x]), np.zeros(2), []
    for _ in range(epochs):
        e = a @ b - y
        scale = 3000 if loss == "mae" else 1
        history.append(np.abs(e).sum() / scale)
        b = b - rate * (a.T @ np.sign(e)) / scale
    assert np.allclose(m.history, history, rtol=1e-10) and jobs < epochs / 2
