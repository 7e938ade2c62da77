"""Bucketed Parquet tables in loads.

Rows are hashed on the table's keys into a fixed number of buckets, in a
partition (``load``) for each load. A join or grouping on the keys reads the
buckets as they lie: only the other side of a join is exchanged, however many
loads the table has. Writing a load again replaces that load alone.

The files lie under a path; a session names them by a table of its catalogue
over that path, made again by whatever session opens the path next."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOAD = "load"
#: Rows that one bucket may have: a task sorts or groups one, whatever the table's size.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, least: int) -> int:
    """Buckets of a table of up to ``rows`` rows."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self.name = "bucketed_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {LOAD} INT) USING parquet "
                  f"OPTIONS (compression 'zstd') PARTITIONED BY ({LOAD}) CLUSTERED BY ({by}) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")
        try:
            spark.catalog.recoverPartitions(self.name)  # loads that other sessions wrote
        except Exception as e:  # noqa: BLE001 - nothing written yet
            if "FileNotFoundException" not in str(e):
                raise

    def write(self, rows: DataFrame, load: int) -> None:
        """Write a load, or write it again."""
        view = f"{self.name}_rows"
        # Dealt as the buckets are: a file for each bucket.
        rows.select(*self.schema.names).repartition(self.buckets, *self.keys).createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({LOAD} = {int(load)}) SELECT * FROM {view}")
        self.spark.catalog.dropTempView(view)

    def read(self, up_to: int) -> DataFrame:
        """The rows of loads 1 to ``up_to``, with their load."""
        return self.spark.table(self.name).where(F.col(LOAD) <= up_to)
