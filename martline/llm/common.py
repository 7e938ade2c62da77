"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.session import scratch_path, table_path

#: The white space of the query contracts: space, and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def narrow_batches(spark: SparkSession, most: int) -> None:
    """From now on at most so many rows pass at a time to Python and back:
    batches of wide rows are held by the executor and the worker."""
    now = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(most, now) if now > 0 else most))


@contextmanager
def batch_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """``narrow_batches`` for what runs within."""
    before = spark.conf.get(_BATCH)
    narrow_batches(spark, most)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What a worker process keeps between the tasks of an operator (caches,
    models). Spark reuses its workers: what another operator kept goes."""
    if operator not in _kept:
        _kept.clear()
        give_back()
        _kept[operator] = {}
    return _kept[operator]


def give_back() -> None:
    """Return the memory that this process has freed to the system: Arrow and
    the C library hold it for their next use, in each of the workers, while
    other tasks and the executor need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: what
    follows neither recomputes it nor depends on executors that are gone."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialise`` wrote and nothing reads any more."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans now: its cleaner
    does so when the driver collects what refers to them, which a job of many
    rounds can't wait for. Call it once the round's results are written."""
    gc.collect()
    spark._jvm.System.gc()


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPLIT), lambda w: w != "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def keep_rows(df: DataFrame, text: str, verdicts) -> DataFrame:
    """The rows of ``df`` that ``verdicts()(texts)``, a list of booleans for a
    list of texts (null as empty), keeps; all columns pass unchanged."""
    def run(batches):
        kept("rows")
        keep = verdicts()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):  # texts held as Python strings
                batch = whole.slice(at, 1000)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                yield batch.filter(pa.array(keep(texts), pa.bool_()))
        keep = whole = batch = texts = None
        give_back()

    return df.mapInArrow(run, df.schema)
