"""Message files over the stand-in data, as a producer would write them, and
end-to-end consumer runs over them.

Batches (every row of the entity flows through each full batch):
0. orders with an even order id,  1. odd order ids,  2. a full replay,
3. a full replay with updates (orders: ``shipped`` became ``delivered``;
   items and payments: one more on the price or value),
4. malformed messages only: truncated JSON and wrongly typed fields.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.functions.json import encode_value
from martline.plans import stage
from martline.plans import warehouse as wh
from martline.session import scratch_path, written
from martline.streaming import consumer
from martline.streaming.sources import message_file_stream, write_messages

# The updates that batch 3 carries.
ORDER_STATUS_UPDATE = ("shipped", "delivered")
PRICE_UPDATE = 1.0


def _updated(entity: str, clean_df: DataFrame) -> DataFrame:
    if entity == "orders":
        old, new = ORDER_STATUS_UPDATE
        return clean_df.withColumn("order_status", F.when(
            F.col("order_status") == old, F.lit(new)).otherwise(F.col("order_status")))
    column = "price" if entity == "items" else "payment_value"
    return clean_df.withColumn(column, F.col(column) + PRICE_UPDATE)


def _malformed(entity: str, msgs: DataFrame) -> DataFrame:
    truncated = F.expr("substring(value, 1, length(value) div 2)")
    second = {"orders": ("customer_id", "null"), "items": ("order_item_id", '"x"'),
              "payments": ("payment_sequential", '"x"')}[entity]
    field, bad = second
    wrong = F.regexp_replace("value", f'"{field}":("[^"]*"|-?[0-9]+)', f'"{field}":{bad}')
    return msgs.select("key", F.explode(F.array(truncated, wrong)).alias("value"))


def cleaned_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The rows that all batches are made of, cleaned once: a row a key."""
    return written(wh.cleaned(spark, sf_dir, entity), f"cleaned-{entity}", compression="zstd")


def batches(entity: str, clean_df: DataFrame) -> list[DataFrame]:
    parity = F.col("order_id").cast("long") % 2

    def sendable(df: DataFrame) -> DataFrame:
        return df.select(stage.message_key(entity).alias("key"),
                         encode_value(df, stage.TABLE_SCHEMA[entity].names).alias("value"))

    return [
        sendable(clean_df.filter(parity == 0)),
        sendable(clean_df.filter(parity == 1)),
        sendable(clean_df),
        sendable(_updated(entity, clean_df)),
        _malformed(entity, sendable(clean_df)),
    ]


def write_batches(entity: str, clean_df: DataFrame, root: str, which: list[int]) -> None:
    """Write some of the batches of a ``cleaned_table``, one after another, each
    as a folder of message files under ``root`` (a batch may come again). Both
    messages of a key are made of its one row, so nothing is exchanged."""
    all_batches = batches(entity, clean_df)
    for i in which:
        write_messages(all_batches[i], f"{root}/{i}-{uuid.uuid4().hex[:8]}", together=True)


def run_scenario(spark: SparkSession, sf_dir: str, entity: str, policy: str,
                 steps: list[list[int]], lose_checkpoint: bool = False,
                 recreate_topic: bool = False) -> DataFrame:
    """Write the batch groups in ``steps`` one after another, draining the
    consumer after each group, and return the staged table without its insert
    time. The consumer restarts from its checkpoint each time, or from a new
    one; the messages go to one folder, or to a new one at each step, where
    places start anew, and with it a new checkpoint."""
    root = scratch_path(spark, f"topic-{entity}")
    target = scratch_path(spark, f"staging-{entity}")
    ckpt = scratch_path(spark, f"ckpt-{entity}")
    clean_df = cleaned_table(spark, sf_dir, entity)
    for group in steps:
        if recreate_topic:
            root = scratch_path(spark, f"topic-{entity}")
        if lose_checkpoint or recreate_topic:
            ckpt = scratch_path(spark, f"ckpt-{entity}")
        write_batches(entity, clean_df, root, group)
        consumer.drain(entity, message_file_stream(spark, root), target, ckpt, policy)
    return consumer.staged_table(spark, entity, target, policy).drop("kafka_ingested_at")
