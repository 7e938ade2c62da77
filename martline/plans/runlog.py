"""Run log analytics: per-run task statistics and pass/fail gates.

Input: one row per task execution ``(run_id, task_id, start_date,
end_date, state)``. Everything is one grouped aggregation per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions.time import duration_text, elapsed_seconds

# The default gates of the benchmark (rows of the final table,
# wall time in seconds).
MIN_ROWS = 100_000
MAX_SECONDS = 900


def summary(runlog: DataFrame) -> DataFrame:
    """Per run: task count, failed tasks, slowest task (the earliest-started
    among the longest; empty when every task took 0 s), total span and its
    ``MMm SSs`` text."""
    secs = F.coalesce(elapsed_seconds("end_date", "start_date"), F.lit(0))
    df = runlog.withColumn("duration_seconds", secs)
    # Longest first, then earliest start (NULL start last), then task id.
    rank = F.struct(-F.col("duration_seconds"), F.col("start_date").isNull(),
                    F.col("start_date"), F.col("task_id"))
    agg = df.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("task_count"),
        F.count_if(F.col("state") == "failed").alias("failed_tasks"),
        F.max("duration_seconds").alias("slowest_seconds"),
        F.min_by("task_id", rank).alias("_slowest"),
        elapsed_seconds(F.max("end_date"), F.min("start_date")).alias("total_seconds"),
    )
    return agg.select(
        "run_id", "task_count", "failed_tasks",
        F.when(F.col("slowest_seconds") > 0, F.col("_slowest")).otherwise(F.lit(""))
         .alias("slowest_task"),
        F.greatest(F.col("slowest_seconds"), F.lit(0)).alias("slowest_seconds"),
        "total_seconds",
        duration_text("total_seconds").alias("duration_text"),
    )


def one_run(runlog: DataFrame, run_id: str | None = None) -> DataFrame:
    """The tasks of one run: the one named, or the one that started last (ties:
    the greater id)."""
    if run_id is not None:
        return runlog.filter(F.col("run_id") == run_id)
    started = runlog.groupBy("run_id").agg(F.min("start_date").alias("_start"))
    last = started.orderBy(F.col("_start").desc_nulls_last(), F.col("run_id").desc()).limit(1)
    return runlog.join(last.select("run_id"), "run_id", "left_semi")


def gates(run_summary: DataFrame, final_rows: int, min_rows: int = MIN_ROWS,
          max_seconds: int = MAX_SECONDS) -> DataFrame:
    """PASS/FAIL per run for rows (``final_rows >= min_rows``), runtime
    (``total_seconds <= max_seconds``), state (no failed task) and overall.
    ``final_rows`` is one number (a count of the final table)."""
    verdict = lambda c: F.when(c, F.lit("PASS")).otherwise(F.lit("FAIL"))
    rows_ok = F.lit(final_rows >= min_rows)
    time_ok = F.col("total_seconds") <= max_seconds
    state_ok = F.col("failed_tasks") == 0
    return run_summary.select(
        "run_id", F.lit(final_rows).cast("long").alias("final_rows"), "total_seconds",
        verdict(rows_ok).alias("pass_rows"),
        verdict(time_ok).alias("pass_runtime"),
        verdict(state_ok).alias("pass_state"),
        verdict(rows_ok & time_ok & state_ok).alias("overall"),
    )
