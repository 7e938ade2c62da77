"""Event-time handling for streams: a plausibility guard in front of the
watermark, and windowed counts under a watermark.

One implausible event time (a year read from a stray number, say 3992)
would push the watermark past every real event and make all later data
"late". The guard drops (and can return) rows whose event time lies outside
a configured range *before* ``withWatermark`` sees them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.functions.time import instant_to_ntz, ntz_to_instant

# The default range of plausible event times.
EARLIEST = "1970-01-01 00:00:00"
LATEST = "2100-01-01 00:00:00"


def plausible(col: str, earliest: str = EARLIEST, latest: str = LATEST):
    c = F.col(col)
    return (c >= F.lit(earliest).cast("timestamp_ntz")) & (c < F.lit(latest).cast("timestamp_ntz"))


def guard(df: DataFrame, col: str, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    return df.filter(plausible(col, earliest, latest))


def implausible(df: DataFrame, col: str, earliest: str = EARLIEST, latest: str = LATEST) -> DataFrame:
    return df.filter(~F.coalesce(plausible(col, earliest, latest), F.lit(False)))


def windowed_counts(df: DataFrame, time_col: str, delay: str, width: str,
                    by: list[str]) -> DataFrame:
    """Tumbling-window counts per ``by`` under a watermark of ``delay``:
    ``(window_start, *by, row_count)``. The watermark needs a zoned
    timestamp: a zone-less event time is mapped to the instant with the same
    UTC wall clock and the window start mapped back, so the session time
    zone never shifts an event."""
    ntz = df.schema[time_col].dataType.typeName() == "timestamp_ntz"
    if ntz:
        df = df.withColumn(time_col, ntz_to_instant(time_col))
    start = instant_to_ntz(F.col("w.start")) if ntz else F.col("w.start")
    return (df.withWatermark(time_col, delay)
            .groupBy(F.window(time_col, width).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(start.alias("window_start"), *by, "row_count"))
