"""String cleaning and key building; all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Trim spaces on both sides."""
    return F.trim(_c(c))


def title_text(c: str | Column) -> Column:
    """Trim, then upper-case the first letter of every space-separated word
    and lower-case the rest (city names)."""
    return F.initcap(F.trim(_c(c)))


def code_text(c: str | Column) -> Column:
    """Trim and upper-case (state codes)."""
    return F.upper(F.trim(_c(c)))


def composite_key(*parts: str | Column, sep: str = "_") -> Column:
    """Message key ``a_b``. A NULL part gives a NULL key (``concat_ws`` would
    silently drop it and let two different rows share a key)."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_c(p).cast("string"))
    return F.concat(*pieces)
