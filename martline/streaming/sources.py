"""Stream sources and the message sink.

Messages are ``key``, ``value`` (text) and ``timestamp``, the producer's time,
with a position for those of equal time: from Kafka its partition and offset;
from a folder of message files, which any producer can append to, the file and
the row's place in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

MESSAGE_FILE_SCHEMA = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("timestamp", TimestampNTZType()),
])


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Kafka topic as a stream of text messages. ``failOnDataLoss=false``
    tolerates a recreated topic (offsets going back). ``min_partitions``
    splits large topic partitions over several tasks, so one partition
    holding most of a batch does not become one task."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return r.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def _positioned(files: DataFrame) -> DataFrame:
    return files.select(
        "key", "value", F.hash("_metadata.file_name").alias("partition"),
        F.col("_metadata.row_index").alias("offset"), "timestamp")


def message_file_stream(spark: SparkSession, root: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the message files in the sub-folders of ``root``: each file
    is picked up once."""
    r = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _positioned(r.parquet(f"{root.rstrip('/')}/*"))


def message_files(spark: SparkSession, path: str) -> DataFrame:
    """The messages of the files in a folder, as the stream gives them."""
    return _positioned(spark.read.schema(MESSAGE_FILE_SCHEMA).parquet(path))


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                **options) -> DataFrame:
    """Stream over a folder of CSV / JSON / Parquet files with a declared
    schema (no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def write_messages(messages: DataFrame, path: str, together: bool = False) -> None:
    """Write ``(key, value)`` messages as files of a new folder, in parallel: a
    key's messages lie in one file, the time is that of the write. With
    ``together`` they lie in one partition already and are written as they lie."""
    timed = messages.select("key", "value", F.localtimestamp().alias("timestamp"))
    (timed if together else timed.repartition("key")).write.mode("overwrite").option(
        "compression", "zstd").parquet(path)


def kafka_publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Keyed JSON messages to a Kafka topic (one message per row)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
