"""Keyed upsert table for ``foreachBatch`` (the staging tables).

Each micro-batch appends its rows, reduced to one per key, as one folder
``run=<stream id>/merge_batch=<batch id>`` of Parquet. The stream id is the one
in the checkpoint: a retried batch overwrites its own folder with the same
rows, and a stream that starts again from a new checkpoint writes beside the
old folders, never over them.

A batch counts once it is committed: a record of its own, written after the
batch's rows and, where the consumer keeps them, its rejected messages. Readers
of both take committed batches only, so a stop between the writes leaves
nothing half done; the retry writes all of it again.

Reading resolves every key by the conflict policy:

* ``first`` — the earliest version wins;
* ``last`` — the latest version wins (``INSERT … ON CONFLICT DO UPDATE``).

Versions are ordered by the message's time, partition and offset (one struct
that starts with them, so the order is exchanged once with the row), so the order
holds over a lost checkpoint (the same messages again are the same versions)
and a recreated topic (offsets start anew, time goes on). The insert time
``kafka_ingested_at`` is the message time of the key's first version and is
kept on update and on retries.

Resolution is a grouped aggregate with map-side combining, so a key with many
versions is pre-reduced per task. The log keeps every version; folding it is
the work of a table format or a database, which a deployment puts in its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType, TimestampNTZType

BATCH_COL = "merge_batch"
RUN_COL = "run"
META = ["_time", "_partition", "_offset"]


def _pick(policy: str):
    if policy not in ("first", "last"):
        raise ValueError(f"unknown policy {policy!r}")
    return F.min if policy == "first" else F.max


def reduce_batch(batch: DataFrame, keys: list[str], columns: list[str], policy: str) -> DataFrame:
    """One row per key of a micro-batch, the first or last version, with the
    time of the key's first one as ``_first``."""
    rest = [c for c in columns if c not in keys]
    picked = batch.groupBy(*keys).agg(
        _pick(policy)(F.struct(*META, *rest)).alias("_row"), F.min("_time").alias("_first"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in [*columns, *META]],
                         "_first")


def write_batch(batch: DataFrame, batch_id: int, target: str, keys: list[str],
                columns: list[str], policy: str, run: str = "0", commit_now: bool = True) -> None:
    """foreachBatch body: reduce, write the batch's folder (overwrite, so a
    retry is idempotent), commit. An empty batch is an empty folder."""
    reduce_batch(batch, keys, columns, policy).write.mode("overwrite").parquet(
        f"{target.rstrip('/')}/{RUN_COL}={run}/{BATCH_COL}={batch_id}")
    if commit_now:
        commit(batch.sparkSession, target, run, batch_id)


COMMIT = f"{RUN_COL} string, {BATCH_COL} long"


def commit(spark: SparkSession, target: str, run: str, batch_id: int) -> None:
    """Record that everything of a batch is written."""
    (spark.createDataFrame([(run, batch_id)], COMMIT).coalesce(1).write.mode("overwrite")
     .parquet(f"{target.rstrip('/')}/_commits/{run}-{batch_id}"))


def committed(rows: DataFrame, target: str) -> DataFrame:
    """The rows (with run and batch) of committed batches."""
    try:
        commits = rows.sparkSession.read.schema(COMMIT).parquet(f"{target.rstrip('/')}/_commits/*")
    except Exception as e:  # noqa: BLE001 - no batch yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return rows.limit(0)
    return rows.join(commits, [RUN_COL, BATCH_COL], "left_semi")


def batches_of(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Everything under a folder of batches, with run and batch."""
    whole = StructType(list(schema.fields)).add(RUN_COL, "string").add(BATCH_COL, "long")
    folder = folder.rstrip("/")
    return spark.read.schema(whole).option("basePath", folder).parquet(f"{folder}/{RUN_COL}=*/*")


def log_schema(schema: StructType) -> StructType:
    return (StructType(list(schema.fields)).add("_time", TimestampNTZType())
            .add("_partition", IntegerType()).add("_offset", LongType())
            .add("_first", TimestampNTZType()))


def create(spark: SparkSession, target: str, schema: StructType) -> None:
    """An empty table, so that reading never depends on the first batch."""
    (spark.createDataFrame([], log_schema(schema)).write.mode("ignore")
     .parquet(f"{target.rstrip('/')}/{RUN_COL}=0/{BATCH_COL}=-1"))


def read(spark: SparkSession, target: str, keys: list[str], schema: StructType,
         policy: str) -> DataFrame:
    """Current table: one row per key, ``schema`` columns +
    ``kafka_ingested_at``."""
    columns = schema.names
    create(spark, target, schema)
    versions = committed(batches_of(spark, target, log_schema(schema)), target)
    rest = [c for c in columns if c not in keys]
    resolved = versions.groupBy(*keys).agg(
        _pick(policy)(F.struct(*META, *rest)).alias("_row"), F.min("_first").alias("_first"))
    return resolved.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                             for c in columns], F.col("_first").alias("kafka_ingested_at"))
