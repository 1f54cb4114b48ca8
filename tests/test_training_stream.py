import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.operators.prep import convert_units
from tessera.plans.training import evaluate_new_data, predict_new_rows, train_and_evaluate
from tessera.plans.prepare import ZONE, process_dataset
from tessera.streaming import prepare_stream, run_available_now, score_stream

from houses import HOUSE_SCHEMA, SF_SMALL, make_houses, to_spark


def test_train_and_evaluate_numpy(spark, houses):
    df = convert_units(houses)
    res = train_and_evaluate(df, "price", ["id"], ["area", "is_house", "has_pool"], fit_params={"method": "pseudo_inverse"})
    m = {r["metric"]: r["value"] for r in res.metrics.collect()}
    pdf = df.toPandas()
    tagged = res.data.toPandas()
    tr, te = pdf[~tagged["is_test"].values], pdf[tagged["is_test"].values]
    x = tr[["area", "is_house", "has_pool"]].values
    a = np.column_stack([np.ones(len(x)), x])
    b = np.linalg.lstsq(a, tr["price"].values, rcond=None)[0]
    p = np.column_stack([np.ones(len(te)), te[["area", "is_house", "has_pool"]].values]) @ b
    assert len(te) == int(len(pdf) * 0.2)
    assert np.isclose(m["mse"], np.mean((p - te["price"].values) ** 2))
    # GD default parameters of the workflow also run
    gd = train_and_evaluate(df, "price", ["id"], ["area", "is_house"], transform_target="log", inverse="exp")
    assert gd.pipeline.model.info["method"] == "gradient_descent"
    new = evaluate_new_data(df, gd.pipeline).collect()
    assert {r["metric"] for r in new} == {"mse", "r2"}
    pred = predict_new_rows(df.drop("price"), gd.pipeline).select("prediction").first()[0]
    assert pred > 0


def test_process_dataset_zones(spark):
    pdf = make_houses(300, seed=4, null_zone=True)
    df = convert_units(to_spark(spark, pdf, HOUSE_SCHEMA))
    res = process_dataset(df, k=2, impute_by_zone=True, create_zone_interactions=True, key_cols=["id"],
                          zone_interaction_features=["area", "age", "house_area", "dist_to_cluster_center", "absent"])
    out = res.df.toPandas()
    assert "lat" not in out.columns and ZONE in out.columns
    assert {"area_zone_0", "area_zone_1", "house_area_zone_1", "dist_to_cluster_center_zone_0"} <= set(out.columns)
    # the zone whose ages are all NULL keeps NULL (no global fallback)
    by_zone = out.groupby(ZONE)["age"].apply(lambda s: s.isna().all())
    assert by_zone.sum() == 1
    assert (out["area"] == out["area_zone_0"] + out["area_zone_1"]).all()
    zs = res.zone_stats.toPandas()
    assert set(zs["feature"]) == {"age", "rooms"} and np.isclose(zs.groupby(ZONE)["percentage"].first().sum(), 100)
    # the fitted preparation applies unchanged to new data
    again, pos = res.prep.transform(df)
    assert again.columns == res.df.columns and pos.columns == ["lat", "lon", ZONE]
    fs = res.feature_stats.toPandas().set_index("feature")
    assert np.isclose(fs.loc["house_area", "mean"], out["house_area"].mean())


def test_stream_scoring_equals_batch(spark, houses):
    df = convert_units(houses)
    res = train_and_evaluate(df, "price", ["id"], ["area", "is_house"], fit_params={"method": "pseudo_inverse"})
    prep = process_dataset(df, k=2, key_cols=["id"]).prep
    root = tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp")
    src = os.path.join(root, "in")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    scored = prepare_stream(score_stream(stream, res.pipeline), prep)
    run_available_now(scored, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    got = spark.read.parquet(os.path.join(root, "out")).orderBy("id").select("id", "prediction", ZONE).toPandas()
    want = prep.transform_all(predict_new_rows(df, res.pipeline)).orderBy("id").select("id", "prediction", ZONE).toPandas()
    assert np.allclose(got["prediction"], want["prediction"]) and (got[ZONE] == want[ZONE]).all()


def test_entry_contract(spark):
    out = entry.entry(spark)
    rows = out.collect()
    assert [c for c in out.columns] == ["metric", "value"] and len(rows) == 2
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70
    # a few registered queries run on the smoke tables
    for name in ["describe_all", "kmeans_fit", "cv_lambda", "qq_table"]:
        assert q[name](spark, SF_SMALL).count() > 0


def test_process_dataset_global_impute_without_locations(spark, houses):
    df = convert_units(houses)
    res = process_dataset(df, location_cols=None, features_to_impute=["age", "rooms"], impute_by_zone=False)
    out = res.df.toPandas()
    assert res.zone_stats is None and res.df_pos is None
    assert "dist_to_cluster_center" not in out.columns and {"pool_house", "house_area"} <= set(out.columns)
    assert out["age"].notna().all() and np.isclose(out["age"].mean(), df.toPandas()["age"].mean())
    import pytest

    with pytest.raises(ValueError):
        process_dataset(df, location_cols=None, impute_by_zone=True)


def test_default_features_are_numeric(spark, houses):
    res = train_and_evaluate(houses, "price", ["id"], fit_params={"method": "pseudo_inverse"})
    assert "area_units" not in res.pipeline.features and "id" not in res.pipeline.features
    assert set(res.pipeline.features) == {"area", "is_house", "has_pool", "age", "lat", "lon", "rooms"}


def test_stream_wide_kmeans_labels(spark):
    import pandas as pd

    from tessera.operators.kmeans import kmeans_fit
    from tessera.streaming import zone_stream

    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 12))
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(12)]).assign(id=np.arange(120))
    df = to_spark(spark, pdf, ", ".join(f"f{i} double" for i in range(12)) + ", id long")
    cols = [f"f{i}" for i in range(12)]
    model = kmeans_fit(df, cols, k=8, max_iter=5, key_cols=["id"])  # k*d = 96: vectorised label UDF
    root = tempfile.mkdtemp(prefix="tessera-stream-", dir="/tmp")
    df.write.parquet(os.path.join(root, "in"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(root, "in"))
    run_available_now(zone_stream(stream, model, cols), os.path.join(root, "out"), os.path.join(root, "ckpt"))
    got = spark.read.parquet(os.path.join(root, "out")).orderBy("id").select("zone").toPandas()["zone"].values
    want = model.predict(df, cols).orderBy("id").select("zone").toPandas()["zone"].values
    assert (got == want).all()


def test_training_from_a_path_equals_training_from_rows(spark, tmp_path):
    pdf = make_houses(120).drop(columns=["area_units", "age", "rooms"])
    for path, write in ((f"{tmp_path}/h.csv", pdf.to_csv), (f"{tmp_path}/h.parquet", pdf.to_parquet)):
        write(path, index=False)
        kw = {"features": ["area", "is_house", "has_pool"], "fit_params": {"method": "pseudo_inverse"}}
        a = train_and_evaluate(path, "price", ["id"], **kw)
        b = train_and_evaluate(spark.createDataFrame(pdf), "price", ["id"], **kw)
        assert np.allclose([a.pipeline.model.intercept, *a.pipeline.model.coef], [b.pipeline.model.intercept, *b.pipeline.model.coef])
        again = [evaluate_new_data(d, b.pipeline).collect() for d in (path, spark.createDataFrame(pdf))]
        assert [r["metric"] for r in again[0]] == [r["metric"] for r in again[1]]
        assert np.allclose([r["value"] for r in again[0]], [r["value"] for r in again[1]])
