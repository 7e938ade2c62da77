"""Sorted head: the first N rows after a sort (a top-k, so the limit is the
feature). Spark plans ``orderBy().limit(n)`` as TakeOrderedAndProject: each
task keeps its own top n and only those reach the final merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_head(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """First ``n`` rows ordered ascending by ``order`` with NULLs last;
    remaining columns break ties so the result is deterministic."""
    cols = order + [c for c in df.columns if c not in order]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(n)
