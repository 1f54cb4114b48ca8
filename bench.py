"""Headline workloads at one scale factor; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs twice, timed end to end (planning + all its Spark jobs):
"queries" holds the second (warm) run, "cold" the first.  The number of Spark
jobs per query is reported too, because a sweep's job count must not depend
on the size of its grid.
"""

from __future__ import annotations

import json
import os
import sys
import time

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera import local_session  # noqa: E402
from tessera.operators import profile as pf  # noqa: E402
from tessera.operators.diagnostics import qq_table  # noqa: E402
from tessera.operators.kmeans import kmeans_fit  # noqa: E402
from tessera.operators.prep import convert_units  # noqa: E402
from tessera.operators.regress import fit  # noqa: E402
from tessera.plans import catalog  # noqa: E402
from tessera.plans import select as sel  # noqa: E402
from tessera.plans.training import train_and_evaluate  # noqa: E402
from tessera.plans.prepare import process_dataset  # noqa: E402
from tessera.sources.io import read_table  # noqa: E402
from tessera.sources.tables import LINEITEM_KEY, customer_locations, embedding_points, lineitem_houses  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def houses(spark):
    return convert_units(lineitem_houses(spark, SF_DIR))


def q_fit_ols(spark):
    m = fit(houses(spark), ["area", "lat", "lon", "is_house"], "price")
    return m.coef


def q_train_and_evaluate(spark):
    res = train_and_evaluate(houses(spark), "price", LINEITEM_KEY, ["area", "lat", "lon", "is_house"],
                             fit_params={"method": "pseudo_inverse"})
    return res.metrics.collect()


def q_lambda_sweep(spark):
    res = sel.lambda_sweep(houses(spark), ["area", "lat", "lon", "is_house", "has_pool"], "price", LINEITEM_KEY,
                           list(np.linspace(0, 10, 200)))
    return res.curve.collect()


def q_lasso_sweep(spark):
    res = sel.lambda_sweep(houses(spark), ["area", "lat", "lon", "is_house", "has_pool"], "price", LINEITEM_KEY,
                           list(np.linspace(0, 10, 200)),
                           fit_params={"method": "gradient_descent", "regularization": "l1", "learning_rate": 0.01,
                                       "epochs": 1000})
    return res.curve.collect()


def q_cv_lambda(spark):
    res = sel.cv_lambda(houses(spark), ["area", "lat", "lon", "is_house"], "price", LINEITEM_KEY,
                        list(np.linspace(0, 1, 100)), n_splits=10, seed=12, degree=5, metrics=("mse",))
    return res.curve.collect()


def q_cv_degree(spark):
    res = sel.cv_degree(houses(spark), ["area", "lat", "lon"], "price", LINEITEM_KEY, list(range(1, 10)),
                        n_splits=5, seed=12, transform_target="log", inverse="exp")
    return res.curve.collect()


def q_kmeans_wide(spark):
    df = embedding_points(spark, SF_DIR)
    pts = [F.col("embedding").getItem(j) for j in range(64)]
    return kmeans_fit(df, pts, k=10, key_cols=["vec_id"]).centers


def q_kmeans_2d(spark):
    return kmeans_fit(customer_locations(spark, SF_DIR), ["lat", "lon"], k=2, key_cols=["c_custkey"]).centers


def q_process_dataset(spark):
    res = process_dataset(
        houses(spark), k=2, impute_by_zone=True, create_zone_interactions=True, key_cols=LINEITEM_KEY,
        zone_interaction_features=["area", "rooms", "age", "has_pool", "is_house", "house_area", "pool_house",
                                   "dist_to_cluster_center"],
    )
    res.df.write.format("noop").mode("overwrite").save()
    return res.feature_stats.collect(), res.zone_stats.collect()


def q_describe_all(spark):
    return pf.describe_all(read_table(spark, SF_DIR, "lineitem")).collect()


def q_corr_matrix(spark):
    return pf.corr_matrix(read_table(spark, SF_DIR, "lineitem")).collect()


def q_qq_table(spark):
    orders = read_table(spark, SF_DIR, "orders")
    qq_table(orders, "o_totalprice", ["o_orderkey"]).write.format("noop").mode("overwrite").save()


def q_fit_predict_wide(spark):
    catalog.QUERIES["fit_predict_wide"](spark, SF_DIR).write.format("noop").mode("overwrite").save()


QUERIES = {
    "fit_predict_wide": q_fit_predict_wide,
    "fit_ols": q_fit_ols,
    "train_and_evaluate": q_train_and_evaluate,
    "lambda_sweep": q_lambda_sweep,
    "lasso_sweep": q_lasso_sweep,
    "cv_lambda": q_cv_lambda,
    "cv_degree": q_cv_degree,
    "kmeans_wide": q_kmeans_wide,
    "kmeans_2d": q_kmeans_2d,
    "process_dataset": q_process_dataset,
    "describe_all": q_describe_all,
    "corr_matrix": q_corr_matrix,
    "qq_table": q_qq_table,
}


def main():
    spark = local_session(CPUS, app="tessera-bench", shuffle_partitions=max(8, 2 * CPUS), driver_memory="16g")
    sc = spark.sparkContext
    # warm-up: JVM, code generation and the Python workers used by mapInPandas
    spark.range(1000).selectExpr("sum(id)").collect()
    spark.range(1000).repartition(CPUS).mapInPandas(lambda it: (b for b in it), "id long").count()
    times, cold, jobs = {}, {}, {}
    for name, fn in QUERIES.items():
        # first run: cold (JIT, code generation); second run: warm, reported.
        # Nothing is cached between runs: every operator unpersists its data.
        for attempt, store in ((0, cold), (1, times)):
            group = f"{name}-{attempt}"
            sc.setJobGroup(group, group)
            t0 = time.perf_counter()
            fn(spark)
            store[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"{name}-1"))
    sc.setJobGroup("idle", "idle")
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "jobs": jobs,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
