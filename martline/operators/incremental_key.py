"""Dense surrogate keys that persist over loads.

The first load's keys are 1, 2, … in the order of the natural key. Each later
load gives keys to natural keys that no load before had, in their order, from
the highest key on; keys once given stay.

State under a path:

* ``keys/``: the natural key, its surrogate key and its load, bucketed by a
  digest of the natural key (``sources.bucketed``), which nulls have too. A
  load's distinct keys are exchanged to those buckets and anti-joined; the old
  keys are read where they lie.
* ``state/load=n``: the highest key and the range boundaries, written last: a
  load without it never happened, and its files are overwritten by the next.

New rows are ranked by the persisted boundaries, without counting or sampling,
as long as none of their buckets holds more than ``rows_per_bucket``; then new
boundaries are taken from them and persisted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from martline.operators import dense_key as dk
from martline.session import written
from martline.sources.bucketed import BucketedTable


DIGEST = "_digest"


def digest(columns: list[str]) -> Column:
    """The first 128 bits of the SHA-256 of some columns, nulls included."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 32))


class KeyStore:
    """Natural key columns ``keys`` (a schema) to the dense key ``name``."""

    def __init__(self, spark: SparkSession, path: str, keys: StructType, name: str, *,
                 buckets: int = 64, rows_per_bucket: int = 1_000_000, min_rows_per_bucket: int = 10_000):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self.natural = keys.names
        self.sizes = {"rows_per_bucket": rows_per_bucket, "min_rows_per_bucket": min_rows_per_bucket}
        nullable = StructType([StructField(f.name, f.dataType, True) for f in keys.fields])
        columns = [StructField(DIGEST, BinaryType()), *nullable.fields, StructField(name, LongType())]
        self.table = BucketedTable(spark, f"{self.path}/keys", StructType(columns), [DIGEST], buckets)
        kind = spark.createDataFrame([], nullable).select(
            dk._key_struct(self.natural).alias("k")).schema["k"].dataType
        self.state_schema = StructType([StructField("load", LongType()), StructField("max_key", LongType()),
                                        StructField("bounds", ArrayType(kind))])

    def state(self) -> tuple[int, int, list[tuple] | None]:
        """(last load, highest key, boundaries) committed; boundaries are None
        before the first load."""
        try:
            rows = self.spark.read.schema(self.state_schema).parquet(f"{self.path}/state/*")
            last = rows.orderBy(F.desc("load")).first()
        except Exception as e:  # noqa: BLE001 - no load yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            last = None
        return (0, 0, None) if last is None else (last.load, last.max_key, [tuple(b) for b in last.bounds])

    def keys(self) -> DataFrame:
        """Natural key, surrogate key and load of every committed load."""
        return self.table.read(self.state()[0]).drop(DIGEST)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Natural keys of ``rows`` that no committed load has. Null is a value
        like any other; the rows are aggregated before they are exchanged."""
        # Dealt as the buckets are, so that the old side isn't dealt anew.
        new = rows.select(*self.natural).distinct().withColumn(DIGEST, digest(self.natural))
        new = new.repartition(self.table.buckets, DIGEST)
        return new.join(self.table.read(self.state()[0]).select(DIGEST), DIGEST, "left_anti")

    def load(self, rows: DataFrame) -> DataFrame:
        """Give keys to the natural keys of ``rows`` that have none, commit the
        load, and return ``keys()``. The natural keys of ``rows`` may repeat."""
        last, highest, bounds = self.state()
        new = written(self.unseen(rows), "unseen-keys")
        if bounds is not None and bounds:
            assign, _ = dk.range_buckets(new, self.natural, bounds=bounds)
            fullest = assign(new).groupBy("_bucket").count().agg(F.max("count")).first()[0] or 0
            count = None
        else:
            fullest = count = new.count()
        if bounds is None or fullest > self.sizes["rows_per_bucket"]:
            bounds = dk.boundaries(new, self.natural, size_hint=count, **self.sizes)
        ranked = dk.dense_key(new, self.natural, self.name, bounds=bounds).withColumn(
            self.name, F.col(self.name) + highest)
        self.table.write(ranked, last + 1)
        top = self.table.read(last + 1).where(F.col("load") == last + 1).agg(F.max(self.name)).first()[0]
        state = self.spark.createDataFrame([(last + 1, top or highest, bounds)], self.state_schema)
        state.write.mode("overwrite").parquet(f"{self.path}/state/load-{last + 1:09d}")
        return self.keys()
