"""House-like frames and table folders shared by the tests."""

import numpy as np
import pandas as pd

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def make_houses(n: int = 200, seed: int = 0, null_zone: bool = False) -> pd.DataFrame:
    """House-like rows with the reference's input schema plus a unique id.

    Two separate location groups, NULL ages and rooms, mixed area units.
    """
    rng = np.random.default_rng(seed)
    zone = rng.integers(0, 2, n)
    lat = np.where(zone == 0, 40.7 + rng.normal(0, 0.02, n), -34.6 + rng.normal(0, 0.02, n))
    lon = np.where(zone == 0, -74.0 + rng.normal(0, 0.02, n), -58.4 + rng.normal(0, 0.02, n))
    units = rng.choice(["m2", "sqft"], n)
    area_m2 = rng.uniform(40, 160, n)
    area = np.where(units == "sqft", area_m2 / 0.092903, area_m2)
    is_house = rng.integers(0, 2, n)
    has_pool = rng.integers(0, 2, n)
    age = rng.integers(1, 21, n).astype(float)
    rooms = rng.integers(1, 6, n).astype(float)
    price = 3.5 * area_m2 + 50 * has_pool + 30 * is_house + rng.normal(0, 10, n) + 100
    age[rng.random(n) < 0.15] = np.nan
    rooms[rng.random(n) < 0.05] = np.nan
    if null_zone:
        age[zone == 1] = np.nan
    df = pd.DataFrame(
        {
            "id": np.arange(n, dtype=np.int64),
            "area": area,
            "area_units": units,
            "is_house": is_house.astype(np.int32),
            "has_pool": has_pool.astype(np.int32),
            "age": age,
            "price": price,
            "lat": lat,
            "lon": lon,
            "rooms": rooms,
        }
    )
    return df


HOUSE_SCHEMA = (
    "id long, area double, area_units string, is_house int, has_pool int, age double, price double, "
    "lat double, lon double, rooms double"
)


def to_spark(spark, pdf: pd.DataFrame, schema: str | None = None, partitions: int | None = None):
    pdf = pdf.astype(object).where(pd.notnull(pdf), None)
    df = spark.createDataFrame([tuple(r) for r in pdf.itertuples(index=False)], schema or list(pdf.columns))
    return df.repartition(partitions) if partitions else df
