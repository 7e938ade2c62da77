"""The warehouse build as plain jobs in dependency order:

staging (orders, items, payments) -> dimensions (customer, product, seller)
-> fact_sales -> fact_sales_enriched -> quality gates.

Each step writes a Parquet table under ``out`` and later steps read the
written tables back (lineage ends at each table, counts come from cheap
scans). Every step appends ``(run_id, task_id, start_date, end_date,
state)`` to the ``runlog`` table, which ``plans.runlog.summary`` reads."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martline import schemas
from martline.plans import dims, facts, quality
from martline.plans import warehouse as wh


# Above this many dimension rows a dimension is not broadcast (about 64 MB of
# key pairs), and the fact looks its keys up on a narrow projection.
NARROW_LOOKUP_MIN_DIM_ROWS = 2_000_000


class Run:
    def __init__(self, spark: SparkSession, out: str, run_id: str | None = None):
        self.spark, self.out = spark, out.rstrip("/")
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.rows_written: dict[str, int] = {}
        self._pending: list[tuple] = []
        self._lock = threading.Lock()

    def path(self, table: str) -> str:
        return f"{self.out}/{table}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def _log(self, task: str, start: dt.datetime, end: dt.datetime, state: str) -> None:
        with self._lock:
            self._pending.append((self.run_id, task, start, end, state))

    def flush_log(self) -> None:
        """Append the buffered task rows to the run log in one write."""
        with self._lock:
            rows, self._pending = self._pending, []
        if rows:
            (self.spark.createDataFrame(rows, schemas.RUNLOG).write.mode("append")
             .parquet(self.path("runlog")))

    def _run_task(self, task_id: str, fn) -> None:
        start = dt.datetime.now()
        try:
            fn()
        except Exception:
            self._log(task_id, start, dt.datetime.now(), "failed")
            raise
        self._log(task_id, start, dt.datetime.now(), "success")

    def task(self, task_id: str, fn) -> None:
        try:
            self._run_task(task_id, fn)
        finally:
            self.flush_log()

    def layer(self, tasks: dict, parallel: bool = True) -> None:
        """Independent tasks of one dependency layer, run concurrently (the
        Spark scheduler is thread-safe; their jobs share the cluster). The
        layer's run-log rows are appended together afterwards — concurrent
        appends to one folder could collide in the commit protocol."""
        if not parallel or len(tasks) < 2:
            for task_id, fn in tasks.items():
                self.task(task_id, fn)
            return
        with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
            futures = [pool.submit(self._run_task, t, fn) for t, fn in tasks.items()]
        self.flush_log()
        for f in futures:
            f.result()                      # re-raise the first failure

    def write(self, table: str, df: DataFrame) -> None:
        """Overwrite ``table``; its row count is observed during the write
        (no second pass over the data) and kept in ``rows_written``."""
        obs = Observation(f"rows_{table}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
            .parquet(self.path(table))
        self.rows_written[table] = obs.get["rows"]


def _stream_stage(spark: SparkSession, sf_dir: str, run: Run, entity: str, messages: str | None) -> None:
    """Message files -> streaming consumer -> keyed upsert table, then the
    resolved staging table written for the downstream jobs. ``messages``: the
    folder that has the entity's message files; without one they are written
    from the inputs first."""
    from martline.streaming import consumer, replay
    from martline.streaming.sources import message_file_stream
    target = run.path(f"upsert_{entity}")
    root = f"{messages.rstrip('/')}/{entity}" if messages else run.path(f"messages_{entity}")
    if not messages:
        replay.write_batches(entity, replay.cleaned_table(spark, sf_dir, entity), root, [2])      # one full load
    consumer.drain(entity, message_file_stream(spark, root), target,
                   run.path(f"_checkpoint_{entity}"))
    run.write(f"staged_{entity}",
              consumer.staged_table(spark, entity, target).drop("kafka_ingested_at"))


def build_warehouse(spark: SparkSession, sf_dir: str, out: str, run_id: str | None = None,
                    enforce: bool = False, via_stream: bool = False,
                    parallel: bool = True, messages: str | None = None) -> Run:
    """Staging (batch path, or ``via_stream``: message files, of the folder
    ``messages`` if given, consumed by the streaming consumers), dimensions, facts, quality. Within a layer
    (the three staging tables; the three dimensions) tasks run concurrently
    unless ``parallel`` is False."""
    run = Run(spark, out, run_id)
    entities = ["orders", "items", "payments"]
    if via_stream:
        run.layer({f"stage_{e}": (lambda e=e: _stream_stage(spark, sf_dir, run, e, messages))
                   for e in entities}, parallel)
    else:
        run.layer({f"stage_{e}": (lambda e=e: run.write(f"staged_{e}", wh.staged(spark, sf_dir, e)))
                   for e in entities}, parallel)

    def bound(table: str) -> dict:
        return {"size_hint": run.read(table).count()}

    bounds = wh.input_bounds(spark, sf_dir)
    run.layer({
        "dim_customer": lambda: run.write("dim_customer", dims.customer(
            wh.raw(spark, sf_dir, "customers"), size_hint=bounds["customers"])),
        "dim_product": lambda: run.write("dim_product", dims.product(
            wh.raw(spark, sf_dir, "products"), wh.raw(spark, sf_dir, "translation"),
            size_hint=bounds["products"])),
        "dim_seller": lambda: run.write("dim_seller", dims.seller(
            wh.raw(spark, sf_dir, "sellers"), size_hint=bounds["sellers"])),
    }, parallel)
    def fact() -> None:
        # Dimensions too big to broadcast: look keys up on a narrow
        # projection instead of shuffling the wide fact once per dimension.
        big = max(run.read(d).count() for d in ["dim_customer", "dim_product", "dim_seller"])
        run.write("fact_sales", facts.sales(
            run.read("staged_orders"), run.read("staged_items"), run.read("dim_customer"),
            run.read("dim_product"), run.read("dim_seller"),
            narrow_lookup=big > NARROW_LOOKUP_MIN_DIM_ROWS,
            sample_src=run.read("staged_items").select("order_id", "order_item_id"),
            **bound("staged_items")))

    run.task("fact_sales", fact)
    run.task("fact_sales_enriched", lambda: run.write("fact_sales_enriched", facts.enrich(
        run.read("fact_sales"), run.read("staged_payments"))))

    def checks() -> None:
        res = quality.run(run.read("fact_sales"), quality.fact_sales_checks()) \
            .select(F.lit("fact_sales").alias("table_name"), "*")
        res_e = quality.run(run.read("fact_sales_enriched"), quality.fact_sales_enriched_checks()) \
            .select(F.lit("fact_sales_enriched").alias("table_name"), "*")
        run.write("quality_results", res.unionByName(res_e))
        if enforce:
            quality.enforce(run.read("quality_results"))

    run.task("quality", checks)
    return run
