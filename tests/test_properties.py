from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import split as sp


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=5, max_value=400), test_size=st.floats(min_value=0.0, max_value=1.0), seed=st.integers(0, 10**6))
def test_split_sizes_exact_and_disjoint(spark, n, test_size, seed):
    df = spark.range(n).withColumnRenamed("id", "k")
    out = sp.train_test_split(df, ["k"], test_size, seed).toPandas()
    assert len(out) == n and out["k"].is_unique
    assert int(out["is_test"].sum()) == int(n * test_size)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=10, max_value=300), k=st.integers(min_value=2, max_value=10), seed=st.integers(0, 10**6))
def test_fold_sizes(spark, n, k, seed):
    if n < k:
        return
    out = sp.kfold(spark.range(n).withColumnRenamed("id", "key"), ["key"], k, seed).toPandas()
    sizes = out.groupby("fold").size()
    size = n // k
    assert list(sizes.index) == list(range(k))
    assert all(sizes[f] == size for f in range(k - 1)) and sizes[k - 1] == n - (k - 1) * size
