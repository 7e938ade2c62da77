"""Streaming consumers: messages -> typed rows -> consumer rules ->
foreachBatch keyed upsert, and a reject stream beside it.

``run`` starts one query. ``available_now=True`` drains what is there and
stops (the replacement of the deprecated trigger-once); otherwise it polls
with a processing-time trigger. Progress is kept under
``checkpoint``, so a restart continues after the last committed batch.

The upsert orders versions itself, so nothing is deduplicated before it and no
state grows with the keys; ``consumer_stream`` with policy ``first`` is the
stateful variant for append-only sinks."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from martline import schemas
from martline.functions.time import ntz_to_instant
from martline.plans import stage
from martline.streaming import upsert

CARRY = ["_time", "_partition", "_offset"]  # of the message
REJECT = StructType([StructField("_value", StringType()), StructField("_time", TimestampNTZType()),
                     StructField("_partition", IntegerType()), StructField("_offset", LongType()),
                     StructField("reject_reasons", ArrayType(StringType()))])


def parsed_stream(entity: str, messages: DataFrame) -> DataFrame:
    """Typed rows with the message's time, partition and offset and its text
    as ``_value``; malformed messages have null columns."""
    return stage.parse(entity, messages.select(
        "value", F.col("value").alias("_value"), F.col("timestamp").alias("_time"),
        F.col("partition").alias("_partition"), F.col("offset").alias("_offset")),
        carry=[*CARRY, "_value"])


def consumer_stream(entity: str, messages: DataFrame, policy: str = "first",
                    dedup_watermark: tuple[str, str] | None = None) -> DataFrame:
    """Parsed, validated stream. For ``first`` the stream keeps every seen
    key in its state store (RocksDB) and drops later messages of a key; with
    ``dedup_watermark=(time_col, delay)`` the state is bounded instead
    (``dropDuplicatesWithinWatermark``)."""
    valid = stage.validate(entity, parsed_stream(entity, messages)).drop("_value")
    if policy != "first":
        return valid
    keys = schemas.KEYS[entity]
    if dedup_watermark:
        col, delay = dedup_watermark
        # The watermark needs a zoned timestamp: use the zone-free instant
        # of the (zone-less) event time.
        timed = valid.withColumn("_event_time", ntz_to_instant(col))
        return (timed.withWatermark("_event_time", delay)
                .dropDuplicatesWithinWatermark(keys).drop("_event_time"))
    return valid.dropDuplicates(keys)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint's metadata file."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def run(entity: str, messages: DataFrame, target: str, checkpoint: str, policy: str = "first",
        available_now: bool = True, interval: str = "10 seconds",
        rejects: str | None = None) -> StreamingQuery:
    """Start the consumer. ``rejects``: a folder for the messages that break a
    rule or can't be parsed, with their text and the rules they break."""
    upsert.create(messages.sparkSession, target, stage.TABLE_SCHEMA[entity])
    w = (parsed_stream(entity, messages).writeStream
         .foreachBatch(partial(_batch, entity=entity, target=target, policy=policy,
                               checkpoint=checkpoint, rejects=rejects))
         .option("checkpointLocation", checkpoint)
         .queryName(f"consumer_{entity}_{policy}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def _batch(df: DataFrame, batch_id: int, *, entity: str, target: str, policy: str,
           checkpoint: str, rejects: str | None) -> None:
    if df.isEmpty():
        return
    spark, run_id = df.sparkSession, _stream_id(df.sparkSession, checkpoint)
    upsert.write_batch(stage.validate(entity, df), batch_id, target, schemas.KEYS[entity],
                       stage.TABLE_SCHEMA[entity].names, policy, run_id, commit_now=False)
    if rejects:  # parsed again: a batch held in memory is many times its files
        (stage.reject_rows(entity, df).select(*REJECT.names)
         .write.mode("overwrite").parquet(
             f"{rejects.rstrip('/')}/{upsert.RUN_COL}={run_id}/{upsert.BATCH_COL}={batch_id}"))
    upsert.commit(spark, target, run_id, batch_id)


def _finish(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def drain(entity: str, messages: DataFrame, target: str, checkpoint: str,
          policy: str = "first", rejects: str | None = None) -> None:
    """Run to the end of the available input and wait for it."""
    _finish(run(entity, messages, target, checkpoint, policy, available_now=True, rejects=rejects))


def staged_table(spark: SparkSession, entity: str, target: str, policy: str = "first") -> DataFrame:
    return upsert.read(spark, target, schemas.KEYS[entity], stage.TABLE_SCHEMA[entity], policy)


def rejected(spark: SparkSession, target: str, rejects: str) -> DataFrame:
    """The messages that broke a rule, of the batches that ``target`` counts:
    a batch's accepted and rejected messages are seen together or not at all."""
    rows = upsert.committed(upsert.batches_of(spark, rejects, REJECT), target)
    return rows.drop(upsert.RUN_COL, upsert.BATCH_COL)
