"""Quality checks kept up over loads: each load is read once, ever.

The state of a load is what ``quality.grouped`` gives: the rows of every key of
every key set, by digest, and the predicates' counts. It is stored as a load of
a table bucketed by digest, so merging the loads adds up each key's rows in the
buckets as they lie, without an exchange and without the tables themselves. A
load that is delivered again replaces its own state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from martline.plans import quality
from martline.sources.bucketed import BucketedTable

STATE = StructType([StructField("set", IntegerType()), StructField("digest", BinaryType()),
                    StructField("n", LongType()), StructField("counts", ArrayType(LongType()))])


class QualityState:
    """The state of one table's ``checks`` under ``path``; a change of the
    checks needs a new path."""

    def __init__(self, spark: SparkSession, path: str, checks: list[quality.Check], buckets: int = 64):
        self.checks = checks
        self.table = BucketedTable(spark, path, STATE, ["digest"], buckets)

    def add(self, rows: DataFrame, load: int) -> None:
        """Check the rows of a load (numbered from 1), or check it again."""
        self.table.write(quality.grouped(rows, self.checks), load)

    def results(self, up_to: int | None = None) -> DataFrame:
        """The checks over all loads so far, or over the first ``up_to``, as
        ``quality.run`` would give them over the loads' rows together."""
        groups = self.table.read(2**31 - 1 if up_to is None else up_to)
        return quality.merged(groups, self.checks)

    def by_load(self) -> DataFrame:
        """The predicates' results of each load on its own: (load, check, result)."""
        names = [n for n, kind, _ in self.checks if kind == "count_if"]
        return (self.table.read(2**31 - 1).where("set = -1")
                .select("load", F.posexplode("counts").alias("i", "result"))
                .select(F.col("load").cast("long").alias("load"),
                        F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("check"), "result"))
