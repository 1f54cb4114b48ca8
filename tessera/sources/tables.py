"""House-like views over the driver tables.

Each view exists twice: as a DataFrame builder (what the library runs) and as
the equivalent DuckDB SQL text (what the oracle runs).  Keep the two in step.

Roles (no driver table has NULLs, so NULLs come from ``nullif``):

* ``lineitem_houses``: key (l_orderkey, l_partkey, l_suppkey, l_linenumber);
  area = l_quantity, unit 'sqft' when l_linestatus = 'F' else 'm2';
  is_house = l_returnflag = 'R'; has_pool = l_discount >= 0.05;
  age = nullif(l_linenumber, 7); rooms = nullif(l_partkey % 5, 0);
  price = l_extendedprice; location (lat, lon) = (100 l_discount, 100 l_tax).
* ``customer_locations``: key c_custkey; (lat, lon) = (c_acctbal / 1000, c_nationkey).
* ``embedding_points``: key vec_id; 64-wide float vector ``embedding``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.io import read_table

LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
HOUSE_FEATURES = ["area", "is_house", "has_pool", "age", "rooms"]


def lineitem_houses(spark: SparkSession, sf_dir: str, converted: bool = False) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select(
        *LINEITEM_KEY,
        F.col("l_quantity").alias("area"),
        F.when(F.col("l_linestatus") == "F", F.lit("sqft")).otherwise(F.lit("m2")).alias("area_units"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_house"),
        (F.col("l_discount") >= 0.05).cast("int").alias("has_pool"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("age"),
        F.nullif(F.col("l_partkey") % 5, F.lit(0)).cast("double").alias("rooms"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_discount") * 100).alias("lat"),
        (F.col("l_tax") * 100).alias("lon"),
    )
    if converted:
        from tessera.operators.prep import convert_units

        df = convert_units(df)
    return df


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        (F.col("c_acctbal") / 1000).alias("lat"),
        F.col("c_nationkey").cast("double").alias("lon"),
        "c_mktsegment",
    )


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


# ---------------------------------------------------------------- oracle twins

LINEITEM_HOUSES_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       l_quantity AS area,
       CASE WHEN l_linestatus = 'F' THEN 'sqft' ELSE 'm2' END AS area_units,
       CAST(l_returnflag = 'R' AS INTEGER) AS is_house,
       CAST(l_discount >= 0.05 AS INTEGER) AS has_pool,
       CAST(NULLIF(l_linenumber, 7) AS DOUBLE) AS age,
       CAST(NULLIF(l_partkey % 5, 0) AS DOUBLE) AS rooms,
       l_extendedprice AS price,
       l_discount * 100 AS lat,
       l_tax * 100 AS lon
FROM lineitem
"""

HOUSES_CONVERTED_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN area_units = 'sqft' THEN area * 0.092903::DOUBLE ELSE area END AS area,
       is_house, has_pool, age, rooms, price, lat, lon
FROM houses
"""

CUSTOMER_LOCATIONS_SQL = """
SELECT c_custkey, c_acctbal / 1000 AS lat, CAST(c_nationkey AS DOUBLE) AS lon, c_mktsegment
FROM customer
"""
