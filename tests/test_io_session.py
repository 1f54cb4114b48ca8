import os
import tempfile

import pytest
from tessera import session
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, materialize, spread
from tessera.sources.io import HOUSE_SCHEMA, read_csv, read_parquet, write_table


def test_csv_roundtrip_header_and_nulls(spark):
    root = tempfile.mkdtemp(prefix="tessera-io-", dir="/tmp")
    src = os.path.join(root, "in.csv")
    with open(src, "w") as fh:
        fh.write("area,area_units,is_house,has_pool,age,price,lat,lon,rooms\n")
        fh.write("1119,sqft,1,0,,350.5,40.7,-74.0,3\n")
        fh.write("80,m2,0,1,12,210,-34.6,-58.4,\n")
    inferred = read_csv(spark, src)
    assert dict(inferred.dtypes)["area_units"] == "string" and dict(inferred.dtypes)["is_house"] == "int"
    typed = read_csv(spark, src, HOUSE_SCHEMA)
    assert typed.filter(F.col("age").isNull()).count() == 1 and typed.filter(F.col("rooms").isNull()).count() == 1
    out = os.path.join(root, "out_csv")
    write_table(typed, out, fmt="csv")
    back = read_csv(spark, out, HOUSE_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, typed.collect()))
    pq = os.path.join(root, "out_pq")
    write_table(typed, pq, partition_by=["area_units"])
    assert read_parquet(spark, pq).count() == 2
    with pytest.raises(ValueError):
        write_table(typed, os.path.join(root, "x"), fmt="orc")


def test_checkpoint_dir_and_materialize(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and ensure_checkpoint_dir(spark) == folder
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90


def test_spread_only_small_inputs(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    small = spark.range(10).repartition(2)
    assert session.is_small(small) and session.spread(small).rdd.getNumPartitions() == cores
    # a size estimate of one input split per core or more is left alone
    monkeypatch.setattr(session, "is_small", lambda df: False)
    large = spark.range(10).repartition(cores + 2)
    assert session.spread(large) is large
    with session.staged(large) as same:
        assert same is large and not same.is_cached
