from tessera.sources.io import (
    load_xy,
    nan_to_null,
    read_csv,
    read_parquet,
    read_table,
    write_table,
)
from tessera.sources.tables import lineitem_houses, customer_locations, embedding_points

__all__ = [
    "read_csv",
    "read_parquet",
    "read_table",
    "write_table",
    "nan_to_null",
    "load_xy",
    "lineitem_houses",
    "customer_locations",
    "embedding_points",
]
