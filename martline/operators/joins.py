"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int, bound_src: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` only when it provably has at most ``max_rows`` rows.

    The check is a ``limit(max_rows + 1).count()`` of ``df`` — or of
    ``bound_src``, a cheaper input that ``df`` can only shrink (e.g. the rows
    before a dedup) — which stops reading once the bound is passed; beyond it
    the side is left to the planner (shuffle join, or AQE's runtime broadcast
    if the shuffled side turns out small)."""
    n = (bound_src if bound_src is not None else df).limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
