"""Serving copy of the warehouse: tables bucketed and sorted by VIN.

Every table has the same number of buckets and one file a bucket, so the joins of the wide listing
read bucket against bucket and none of them shuffles, at any size and without broadcasts. ``car_info``
and ``evaluate`` carry what searches filter by in a form that Parquet can test while it reads: the
price in whole cents, make and fuel in lower case. A new copy becomes visible by one snapshot, so readers
never see tables of two copies.
"""
from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.price import price_numeric
from .snapshots import CODEC, latest, update
from .warehouse import listing_wide

def search_columns() -> dict[str, dict]:
    """Search columns by table: stored name -> expression over the table."""
    cents = (price_numeric("Car_Price_USD", as_double=False) * 100).cast("bigint")
    return {"car_info": {"Price_Cents": cents, "Make_Lower": F.lower(F.col("Car_Make"))},
            "evaluate": {"Fuel_Lower": F.lower(F.col("Fuel_Type"))}}


def _name(path: str) -> str:
    return f"served_{hashlib.md5(path.encode()).hexdigest()}"


def _attach(spark: SparkSession, path: str, ddl: str, buckets: int) -> DataFrame:
    """A folder of bucketed files as a table of this session's catalogue (nothing is copied)."""
    name = _name(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet OPTIONS (compression '{CODEC}') CLUSTERED BY (VIN) SORTED BY (VIN) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def _ddl(df: DataFrame | StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (df if isinstance(df, StructType) else df.schema).fields)


@contextmanager
def _buckets_kept(spark: SparkSession):
    """Scans of bucketed tables deliver their buckets one by one, also where no join or aggregate asks for
    them; the write below does, since its files are the same buckets."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_bucketed(spark: SparkSession, df: DataFrame, path: str, buckets: int) -> None:
    """Write ``df`` to ``path`` in ``buckets`` files by VIN. Rows that come as these buckets already (from an
    aggregate by VIN with as many shuffle partitions, or from another such table) are not shuffled again."""
    table = _attach(spark, path, _ddl(df), buckets)
    # The shuffle's hash is the buckets' hash, so each task writes one sorted file.
    with _buckets_kept(spark):
        df.select(table.columns).repartition(buckets, "VIN").sortWithinPartitions("VIN") \
            .write.insertInto(_name(path))


def read_bucketed(spark: SparkSession, schema: StructType, path: str, buckets: int) -> DataFrame:
    """What ``write_bucketed`` wrote, as the buckets."""
    return _attach(spark, path, _ddl(schema), buckets)


def write_serving(spark: SparkSession, tables: dict[str, DataFrame], root: str, buckets: int | None = None) -> None:
    """Write the six tables (rows with a VIN) as the new serving copy below ``root``. ``buckets`` is the
    number of tasks that later joins run as; the default is the number of shuffle partitions."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    extra, copy = search_columns(), uuid.uuid4().hex
    folders = {}
    for name, df in tables.items():
        df = df.where(F.col("VIN").isNotNull()).withColumns(extra.get(name, {}))
        path = f"{name}/{copy}"
        write_bucketed(spark, df, f"{root}/{path}", buckets)
        folders[name] = [path, _ddl(df), str(buckets)]
    update(spark, root, lambda _old: folders)


def read_serving(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six tables of the last copy, with their search columns."""
    return {name: _attach(spark, f"{root}/{path}", ddl, int(n)) for name, (path, ddl, n) in latest(spark, root)[1].items()}


def serving_wide(tables: dict[str, DataFrame]) -> DataFrame:
    """The wide listing with the search columns."""
    return listing_wide(tables, extra=[c for cols in search_columns().values() for c in cols])
