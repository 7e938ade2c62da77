"""Dense surrogate key: ``row_number() over (order by k1, k2, …)`` without a
window over one partition.

1. Count the rows (or take a given upper bound) and pick a bucket count B:
   at most ``rows_per_bucket`` rows each, at any size, and at least one bucket
   per core while buckets keep ``min_rows_per_bucket`` rows.
2. Sample the full order key (~``samples_per_bucket`` x B keys, a few per
   million rows) and take B-1 range boundaries from it. The sample may come from a
   cheaper superset of the rows (e.g. the raw input): boundaries only decide
   the balance, while the per-bucket counts below are exact. Boundaries come from the
   whole key, not the leading column, so a leading value that holds a third
   of all rows still spreads over many buckets.
3. ``bucket`` = number of boundaries <= key: a binary-search CASE tree over
   literal boundaries for up to 64 buckets, else a small coarse CASE tree
   plus a broadcast range lookup (B rows). A pure function of
   the row, so a recomputed task gets the same bucket.
4. Per-bucket counts (<= B rows) -> exclusive running sum -> broadcast join
   (the broadcast side is bounded by B).
5. ``row_number() over (partition by bucket order by key) + offset``, a
   BIGINT. A row whose bucket was not counted (``keys_src`` lacks its key)
   fails the job instead of vanishing.

Order expressions are named first, so a key may be an expression, and the
rows, the key-only source and the sample all use the same columns.

Contract: equal to ``row_number()`` when the order key is unique. NULLs sort
last, as in the warehouse's ``ORDER BY``.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampNTZType

from martline.session import default_parallelism


def _cols(order: list[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _key_struct(order: list[str | Column]) -> Column:
    fields = []
    for i, c in enumerate(_cols(order)):
        fields += [c.isNull().alias(f"_n{i}"), c.alias(f"_v{i}")]
    return F.struct(*fields)


def _literal_struct(row, types) -> Column:
    fields = []
    for i, t in enumerate(types):
        flag, val = row[2 * i], row[2 * i + 1]
        if val is not None and isinstance(t, TimestampNTZType):
            # Wall-clock text, so no zone conversion touches the literal.
            lit = F.lit(val.isoformat(sep=" ")).cast(t)
        else:
            lit = F.lit(val).cast(t)
        fields += [F.lit(bool(flag)).alias(f"_n{i}"), lit.alias(f"_v{i}")]
    return F.struct(*fields)


def _bucket_expr(key: Column, bounds: list[Column]) -> Column:
    """Count of boundaries <= key, by binary search over sorted ``bounds``."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(bounds))


def _sort_key(row):
    """Python sort key matching Spark's ascending order of the key struct:
    NULL after every value, NaN above every other double."""
    def one(x):
        if x is None:
            return (1, 0, 0)
        if isinstance(x, float) and math.isnan(x):
            return (0, 1, 0)
        return (0, 0, x)
    return tuple(one(x) for x in row)


def _key_names(df: DataFrame, order: list[str | Column]) -> list[str]:
    """The columns that hold the order: those of ``df``, and ``_k0``, ``_k1``, …
    for expressions. A row is not exchanged with its key twice."""
    return [o if isinstance(o, str) and o in df.columns else f"_k{i}" for i, o in enumerate(order)]


def _named(df: DataFrame, order: list[str | Column], keys: list[str]) -> DataFrame:
    """``df`` with the order expressions as columns, named by ``keys``."""
    made = {k: c for k, o, c in zip(keys, order, _cols(order)) if not (isinstance(o, str) and k == o)}
    return df.withColumns(made) if made else df


def bucket_count(n: int, parallelism: int, rows_per_bucket: int, min_rows_per_bucket: int) -> int:
    by_size = math.ceil(n / max(1, rows_per_bucket))
    by_cores = min(parallelism, n // max(1, min_rows_per_bucket))
    return max(1, by_size, by_cores)


# Up to this many buckets the lookup is one binary-search CASE tree; beyond
# it a two-level lookup keeps the per-row expression small (see _assigner).
TREE_MAX_BUCKETS = 64


def _assigner(key: Column, bounds: list[tuple], key_type, spark):
    """Function adding ``_bucket`` (= number of boundaries <= key) to a
    DataFrame.

    Small B: a binary-search CASE tree. Large B: a CASE tree over every
    ~sqrt(B)-th boundary gives a coarse id, then a broadcast hash join on the
    coarse id with the table of fine ranges ``[lo, hi)`` (B rows: one per
    ``rows_per_bucket`` rows of the table) picks the one fine bucket; each row probes
    about sqrt(B) candidate ranges, all in generated code."""
    types = [f.dataType for f in key_type.fields][1::2]
    nb = len(bounds) + 1
    if nb <= TREE_MAX_BUCKETS:
        expr = _bucket_expr(key, [_literal_struct(r, types) for r in bounds])
        return lambda df: df.withColumn("_bucket", expr)
    step = math.ceil(math.sqrt(nb))
    coarse = bounds[step - 1::step]
    coarse_expr = _bucket_expr(key, [_literal_struct(r, types) for r in coarse])
    coarse_keys = [_sort_key(r) for r in coarse]
    rows = []
    for j in range(nb):
        lo = bounds[j - 1] if j > 0 else None
        hi = bounds[j] if j < nb - 1 else None
        rows.append((bisect.bisect_right(coarse_keys, _sort_key(lo)) if lo else 0, j, lo, hi))
    schema = StructType([StructField("_rc", IntegerType(), False),
                         StructField("_bucket", IntegerType(), False),
                         StructField("_lo", key_type, True), StructField("_hi", key_type, True)])
    ranges = F.broadcast(spark.createDataFrame(rows, schema))
    cond = ((F.col("_c") == F.col("_rc"))
            & (F.col("_lo").isNull() | (F.col("_k") >= F.col("_lo")))
            & (F.col("_hi").isNull() | (F.col("_k") < F.col("_hi"))))
    return lambda df: (df.withColumns({"_c": coarse_expr, "_k": key})
                       .join(ranges, cond).drop("_c", "_k", "_rc", "_lo", "_hi"))


def range_buckets(keys_src: DataFrame, order: list[str | Column], *,
                  rows_per_bucket: int = 1_000_000, min_rows_per_bucket: int = 10_000,
                  samples_per_bucket: int = 32, seed: int = 7,
                  size_hint: int | None = None, sample_src: DataFrame | None = None,
                  bounds: list[tuple] | None = None):
    """Plan the bucketing for ``order`` from a key-only DataFrame. Returns
    ``(assign, bucket_count)`` where ``assign(df)`` adds ``_bucket``. Runs a
    count unless ``size_hint`` (any upper bound of the row count, e.g. the
    input table's count) is given, and one bounded sampling job when more
    than one bucket is needed; neither if ``bounds`` (of ``boundaries``) are
    given."""
    if bounds is None:
        bounds = boundaries(keys_src, order, rows_per_bucket=rows_per_bucket,
                            min_rows_per_bucket=min_rows_per_bucket, samples_per_bucket=samples_per_bucket,
                            seed=seed, size_hint=size_hint, sample_src=sample_src)
    if not bounds:
        return (lambda df: df.withColumn("_bucket", F.lit(0))), 1
    key = _key_struct(order)
    kind = keys_src.select(key.alias("k")).schema["k"].dataType
    return _assigner(key, bounds, kind, keys_src.sparkSession), len(bounds) + 1


def boundaries(keys_src: DataFrame, order: list[str | Column], *,
               rows_per_bucket: int = 1_000_000, min_rows_per_bucket: int = 10_000,
               samples_per_bucket: int = 32, seed: int = 7,
               size_hint: int | None = None, sample_src: DataFrame | None = None) -> list[tuple]:
    """Range boundaries of the buckets for ``order`` (see ``range_buckets``),
    each a key with a null flag before each column; none for one bucket."""
    n = size_hint if size_hint is not None else keys_src.count()
    spark = keys_src.sparkSession
    b = bucket_count(n, default_parallelism(spark), rows_per_bucket, min_rows_per_bucket)
    if b == 1:
        return []
    key = _key_struct(order)
    frac = min(1.0, 1.2 * b * samples_per_bucket / n)
    keyed = (sample_src if sample_src is not None else keys_src).select(key.alias("k"))
    sample = [tuple(r.k) for r in keyed.sample(False, frac, seed).collect()]
    sample.sort(key=_sort_key)
    bounds, last = [], None
    for j in range(1, b):
        cand = sample[min(len(sample) - 1, j * len(sample) // b)] if sample else None
        if cand is not None and cand != last:
            bounds.append(cand)
            last = cand
    return bounds


def dense_key(df: DataFrame, order: list[str | Column], name: str, *,
              keys_src: DataFrame | None = None, sample_src: DataFrame | None = None,
              rows_per_bucket: int = 1_000_000, min_rows_per_bucket: int = 10_000,
              samples_per_bucket: int = 32,
              size_hint: int | None = None, bounds: list[tuple] | None = None) -> DataFrame:
    """Add ``name`` = dense 1-based BIGINT rank of each row by ``order``.

    ``keys_src`` may give a cheaper DataFrame with the same rows' order
    columns (e.g. the join keys only); by default the order columns of
    ``df`` are used, which Catalyst prunes to a key-only scan.
    ``size_hint``: an upper bound of the row count that saves the count job.
    ``sample_src``: a cheaper superset of the rows to sample boundaries from.
    ``bounds``: boundaries known from an earlier load, instead of both."""
    keys = _key_names(df, order)
    made = [k for k, o in zip(keys, order) if not (isinstance(o, str) and k == o)]
    src = _named(keys_src if keys_src is not None else df, order, keys).select(*keys)
    assign, nb = range_buckets(
        src, keys, rows_per_bucket=rows_per_bucket, min_rows_per_bucket=min_rows_per_bucket,
        samples_per_bucket=samples_per_bucket, size_hint=size_hint, bounds=bounds,
        sample_src=None if sample_src is None else _named(sample_src, order, keys).select(*keys))
    rows = assign(_named(df, order, keys))
    w = Window.partitionBy("_bucket").orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    rank = F.row_number().over(w).cast("long")
    if nb == 1:
        # At most ``rows_per_bucket`` rows: one bucket, offset 0.
        return rows.withColumn(name, rank).drop("_bucket", *made)
    counts = assign(src).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    # Window over the per-bucket counts only (B rows).
    offsets = counts.select(
        "_bucket",
        (F.sum("_cnt").over(Window.orderBy("_bucket")) - F.col("_cnt")).alias("_off"))
    known = F.coalesce("_off", F.raise_error(F.lit("a key is missing from keys_src")).cast("long"))
    return (rows.join(F.broadcast(offsets), "_bucket", "left")
            .withColumn(name, rank + known).drop("_bucket", "_off", *made))
