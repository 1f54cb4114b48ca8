import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.expr import display_name, erfinv
from tessera.operators import diagnostics as dg
from tessera.operators import features as fe
from tessera.operators import profile as pf

from houses import make_houses, to_spark, HOUSE_SCHEMA


def test_describe_matches_pandas(spark, houses):
    pdf = make_houses()
    d = pf.describe_all(houses.drop("id")).toPandas().set_index("column")
    want = pdf.drop(columns="id").describe(include="all")
    for c in ["area", "age", "price", "rooms"]:
        for stat, col in (("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "p25"), ("50%", "p50"), ("75%", "p75"), ("max", "max")):
            assert np.isclose(d.loc[c, col], want.loc[stat, c]), (c, stat)
        assert d.loc[c, "count"] == want.loc["count", c]
    assert d.loc["area_units", "unique"] == 2
    vc = pdf["area_units"].value_counts()
    assert d.loc["area_units", "freq"] == vc.max()


def test_nulls_and_corr(spark, houses):
    pdf = make_houses()
    nulls = {r["column"]: r["nulls"] for r in pf.null_counts(houses).collect()}
    assert nulls == {c: int(v) for c, v in pdf.isna().sum().items() if v > 0}
    assert pf.null_cells_total(houses).first()[0] == int(pdf.isna().sum().sum())
    assert pf.rows_with_null(houses).first()[0] == int(pdf.isna().any(axis=1).sum())
    cols = ["area", "age", "price", "rooms"]
    got = pf.corr_matrix(houses, cols).toPandas().set_index(["a", "b"])["r"]
    want = pdf[cols].corr()
    for a in cols:
        for b in cols:
            assert np.isclose(got[(a, b)], want.loc[a, b])


def test_histogram_and_kde(spark):
    v = np.array([0.0, 1.0, 1.5, 2.0, 3.9, 4.0])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    h = pf.histogram(df, "v", 4).orderBy("bin").toPandas()
    counts, edges = np.histogram(v, bins=4)
    assert list(h["count"]) == list(counts)
    assert np.isclose((h["density"] * (edges[1] - edges[0])).sum(), 1.0)
    k = pf.kde_grid(df, "v", 5, bandwidth=0.5).orderBy("i").toPandas()
    x = k["x"].values
    want = np.exp(-0.5 * ((x[:, None] - v[None, :]) / 0.5) ** 2).sum(axis=1) / (len(v) * 0.5 * math.sqrt(2 * math.pi))
    assert np.allclose(k["density"], want)
    bs = pf.binned_scatter(df.withColumn("w", F.col("v") * 2), "v", "w", 2)
    assert bs.agg(F.sum("count")).first()[0] == len(v)


def test_qq_table_and_line(spark):
    rng = np.random.default_rng(0)
    r = np.round(rng.normal(size=500), 1)  # many ties
    pdf = pd.DataFrame({"id": np.arange(500), "res": r})
    df = to_spark(spark, pdf, "id long, res double", partitions=5)
    qq = dg.qq_table(df, "res", ["id"]).orderBy("i").toPandas()
    assert list(qq["observed"]) == sorted(r)
    p = (np.arange(1, 501) - 0.5) / 500
    y = 2 * p - 1
    a = 0.147
    ln = np.log(1 - y**2)
    t = 2 / (np.pi * a) + ln / 2
    want = np.sqrt(2) * np.sign(y) * np.sqrt(np.sqrt(t**2 - ln / a) - t)
    assert np.allclose(qq["theoretical"], want)
    line = dg.qq_line(dg.qq_table(df, "res", ["id"])).first()
    slope, icpt = np.polyfit(want, np.sort(r), 1)
    assert np.isclose(line["slope"], slope) and np.isclose(line["intercept"], icpt, atol=1e-9)


def test_erfinv_and_display_name(spark):
    df = spark.createDataFrame([(0.5,), (-0.2,), (0.0,)], "y double")
    got = [r[0] for r in df.select(erfinv("y")).collect()]
    assert np.allclose(got, [0.4769, -0.1791, 0.0], atol=2e-3)
    names = [r[0] for r in spark.createDataFrame([("has_pool",), ("house_area",)], "f string").select(display_name("f")).collect()]
    assert names == ["Pool", "House Area"]


def test_overlay_polyfit_residuals(spark):
    rng = np.random.default_rng(2)
    y = rng.uniform(0, 10, 200)
    p = 2 * y + 1 + rng.normal(0, 0.1, 200)
    df = to_spark(spark, pd.DataFrame({"y": y, "p": p}), "y double, p double")
    curve = dg.polyfit_curve(df, "y", "p", 2, 11).orderBy("i").toPandas()
    coef = np.polyfit(y, p, 2)
    assert np.allclose(curve["fitted"], np.polyval(coef, curve["x"]), atol=1e-8)
    res = dg.residuals(df, "y", "p").toPandas()
    assert np.allclose(res["residual"], y - p)
    o = dg.normal_pdf_overlay(dg.residuals(df, "y", "p"), "residual", 3).orderBy("i").toPandas()
    r = y - p
    want = np.exp(-((o["x"] - r.mean()) ** 2) / (2 * r.std() ** 2)) / (r.std() * np.sqrt(2 * np.pi))
    assert np.allclose(o["pdf"], want)
    line = dg.perfect_line(df, "y", "p").first()
    assert line["lo"] == min(y.min(), p.min()) and line["hi"] == max(y.max(), p.max())


def test_weight_paths_and_curve(spark):
    wide = spark.createDataFrame([(0.0, 1.0, 2.0), (1.0, 0.5, 1.0)], "lambda double, a double, b double")
    long = dg.weight_paths(wide, "lambda", ["a", "b"]).collect()
    assert len(long) == 4
    curve = spark.createDataFrame([(0, 0.0, 2.0), (1, 1.0, 1.0)], "position int, lambda double, mse double")
    marked = {r["position"]: r["is_best"] for r in dg.metric_curve(curve, "lambda", "mse", True).collect()}
    assert marked == {0: False, 1: True}


def test_features(spark, houses):
    out = fe.engineer_features(houses, [{"name": "a2", "operation": "area * 2"}, {"name": "b", "operation": lambda d: F.col("age") + 1}])
    assert {"a2", "b"} <= set(out.columns)
    try:
        fe.engineer_features(houses, [{"name": "area", "operation": "1"}])
        raise AssertionError("duplicate name accepted")
    except ValueError:
        pass
    p = fe.power_features(houses.select("id", "area", "age", "price"), range(1, 40), cap=45, exclude=["id", "price"])
    names = [c for c in p.columns if "_power_" in c]
    assert len(names) == 45 and names[38] == "area_power_39" and names[39] == "age_power_1"
    d = fe.poly_design(houses, ["area", "age"], 2)
    assert d.columns == ["intercept", "area", "age", "area^2", "age^2"]
    zi = fe.zone_interactions(houses.withColumn("zone", F.lit(1)), ["age", "nope"], "zone", 2)
    row = zi.filter(F.col("age").isNull()).select("age_zone_0", "age_zone_1").first()
    assert row["age_zone_0"] is None and row["age_zone_1"] is None  # NULL * 0 stays NULL
    stats = fe.feature_stats(out, ["a2"]).first()
    assert np.isclose(stats["mean"], 2 * make_houses()["area"].mean())


def test_pair_bins_matches_numpy(spark, houses):
    pdf = make_houses()
    got = pf.pair_bins(houses, ["area", "age"], 4).toPandas()
    sub = pdf[["area", "age"]].dropna()
    h, _, _ = np.histogram2d(sub["area"], sub["age"], bins=4,
                             range=[[pdf["area"].min(), pdf["area"].max()], [pdf["age"].min(), pdf["age"].max()]])
    g = got[(got.x == "area") & (got.y == "age")]
    mat = np.zeros((4, 4))
    for r in g.itertuples():
        mat[r.bx, r.by] = r.count
    assert np.array_equal(mat, h)
    assert set(zip(got.x, got.y)) == {("area", "age"), ("age", "area")}


def test_corr_merged_over_a_tree(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6)) + 1000.0  # large means: no cancellation allowed
    cols = [f"c{i}" for i in range(6)]
    pdf = pd.DataFrame(x, columns=cols)
    df = to_spark(spark, pdf, ", ".join(f"{c} double" for c in cols), partitions=3)
    fast = pf.corr_matrix(df, cols).toPandas().set_index(["a", "b"])["r"]
    monkeypatch.setattr(pf, "split_estimate", lambda df: 2000)  # a tree of three levels
    slow = pf.corr_matrix(df, cols).toPandas().set_index(["a", "b"])["r"]
    want = pdf.corr()
    for a in cols:
        for b in cols:
            assert np.isclose(fast[(a, b)], want.loc[a, b], atol=1e-12)
            assert np.isclose(slow[(a, b)], want.loc[a, b], atol=1e-12)


def test_corr_of_many_columns_runs_the_same_jobs(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(rng.normal(size=(500, 300)) + rng.normal(size=(500, 1)) * 2, columns=[f"c{i}" for i in range(300)])
    pdf.iloc[rng.random(500) < 0.3, 3] = np.nan
    pdf.iloc[rng.random(500) < 0.5, 7] = np.nan
    pdf["c9"] = np.nan
    pdf["c10"] = 0.1
    pdf.loc[pdf["c3"].notna(), "c11"] = 5.5  # constant wherever c3 is known
    jobs = {}
    for n in (3, 300):
        df = spark.createDataFrame(pdf.iloc[:, :n])
        spark.sparkContext.setJobGroup(f"corr{n}", f"corr{n}")
        got = pf.corr_matrix(df).toPandas().set_index(["a", "b"])["r"].unstack()
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"corr{n}"))
    spark.sparkContext.setJobGroup("idle", "idle")
    assert jobs[3] == jobs[300]
    cols = list(pdf.columns)
    want = pdf.corr()
    want.loc["c10"] = want.loc[:, "c10"] = np.nan  # pandas: rounding noise of a constant
    want.loc["c3", "c11"] = want.loc["c11", "c3"] = np.nan
    assert np.allclose(got.loc[cols, cols].to_numpy(float), want.to_numpy(float), atol=1e-12, equal_nan=True)


def test_kde_many_points_chunked(spark):
    v = np.linspace(-2, 3, 50) ** 3
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    k = pf.kde_grid(df, "v", 250, bandwidth=1.3).orderBy("i").toPandas()
    x = k["x"].values
    want = np.exp(-0.5 * ((x[:, None] - v[None, :]) / 1.3) ** 2).sum(axis=1) / (len(v) * 1.3 * math.sqrt(2 * math.pi))
    assert len(k) == 250 and np.allclose(k["density"], want)


def test_describe_top_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    row = pf.describe_all(df).first()
    assert row["top"] == "a" and row["freq"] == 2 and row["unique"] == 3 and row["count"] == 5


def test_zone_stats_of_many_zones(spark):
    """20,000 zones, one of which holds half of the rows."""
    from tessera.operators.features import zone_stats

    rng = np.random.default_rng(12)
    n = 120_000
    zone = np.where(rng.random(n) < 0.5, 5, rng.integers(0, 20_000, n))
    pdf = pd.DataFrame({"zone": zone.astype(np.int32), "a": rng.normal(size=n), "b": rng.integers(0, 9, n).astype(float)})
    pdf.loc[rng.random(n) < 0.1, "a"] = np.nan
    df = spark.createDataFrame(pdf).select("zone", F.nanvl("a", F.lit(None)).alias("a"), "b").repartition(6)
    centers = [[float(z), -float(z)] for z in range(20_000)]
    got = zone_stats(df, "zone", ["a", "b"], centers).toPandas().sort_values(["feature", "zone"]).reset_index(drop=True)
    parts = []
    for f in ("a", "b"):
        g = pdf.groupby("zone")[f]
        parts.append(pd.DataFrame({"feature": f, "size": g.size(), "mean": g.mean(), "median": g.median(), "std": g.std(),
                                   "missing": g.size() - g.count()}).reset_index())
    want = pd.concat(parts).sort_values(["feature", "zone"]).reset_index(drop=True)
    for c in ("zone", "size", "missing"):
        assert (got[c] == want[c]).all()
    for c in ("mean", "median", "std"):
        assert np.allclose(got[c].to_numpy(float), want[c].to_numpy(float), atol=1e-9, equal_nan=True)
    assert np.allclose(got["percentage"], want["size"] / n * 100)
    assert all(list(c) == centers[z] for z, c in zip(got["zone"], got["center"]))


def test_round_half_up_equals_round(spark):
    """The quick rounding gives the values of ``round``, near ties included."""
    from tessera.functions.expr import round_half_up

    rng = np.random.default_rng(21)
    near = np.arange(-400, 400) / 1e12 + 5e-13
    values = [*rng.normal(size=500), *rng.random(500) ** 30, *near, 0.0, -0.0, -1e-14, 4.5, 1e9, -1e300, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    for digits in (0, 9, 12):
        rows = df.select(F.round("x", digits).alias("want"), round_half_up("x", digits).alias("got")).collect()
        assert [repr(r["got"]) for r in rows] == [repr(r["want"]) for r in rows]


def test_power_features_run_compiled(spark):
    """A stage beyond HotSpot's method size is not run by the interpreter, and
    a limit of the session's owner stays."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    df = spark.createDataFrame([(0.5, 2.0)], "a double, b double")
    for owners, want in ((None, "8000"), ("30000", "30000")):
        spark.conf.set(limit, owners) if owners else spark.conf.unset(limit)
        row = fe.power_features(df, range(1, 40)).first()
        assert spark.conf.get(limit) == want
        assert row["a_power_39"] == 0.5**39 and row["b_power_39"] == 2.0**39
    spark.conf.unset(limit)
