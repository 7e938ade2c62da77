"""Dense key == row_number(), without a window over all rows in one task."""

import datetime as dt
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from martline.operators.dense_key import bucket_count, dense_key


def _check(df, order, join_on=None, **opts):
    got = dense_key(df, order, "k", **opts)
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    want = df.withColumn("want", F.row_number().over(w))
    joined = got.join(want, join_on or order)
    assert joined.count() == df.count()
    assert joined.filter("k <> want").count() == 0


def test_single_bucket(spark):
    df = spark.createDataFrame([(f"id{i}", i) for i in range(200)], "a string, b int")
    _check(df, ["a"])


def test_many_buckets_composite_and_skewed_leading_key(spark):
    # A third of the rows share the leading key: buckets must split it.
    rows = [("hot" if i % 3 == 0 else f"k{i:05d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "a string, b int")
    _check(df, ["a", "b"], rows_per_bucket=500)
    counts = (dense_key(df, ["a", "b"], "k", rows_per_bucket=500)
              .withColumn("bucket", F.floor((F.col("k") - 1) / 500)))
    assert counts.filter("a = 'hot'").select("bucket").distinct().count() > 1


def test_nulls_sort_last_and_timestamps(spark):
    base = dt.datetime(2020, 1, 1)
    rows = [(None if i % 7 == 0 else base + dt.timedelta(minutes=i), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, i int")
    _check(df, ["t", "i"], join_on=["i"], rows_per_bucket=300)


def test_sample_source_superset(spark):
    full = spark.createDataFrame([(i, f"v{i}") for i in range(5000)], "a int, v string")
    subset = full.filter("a % 2 = 0")
    got = dense_key(subset, ["a"], "k", sample_src=full.select("a"), rows_per_bucket=400)
    assert got.filter("k <> a / 2 + 1").count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.text(alphabet="abcxyz", max_size=3)),
                min_size=1, max_size=300, unique=True),
       st.integers(2, 50))
def test_property_equals_row_number(spark, rows, per_bucket):
    df = spark.createDataFrame(rows, "a int, b string")
    _check(df, ["a", "b"], rows_per_bucket=per_bucket, min_rows_per_bucket=1)


def test_bucket_count_rules():
    assert bucket_count(10, 8, 1_000_000, 10_000) == 1
    assert bucket_count(80_000, 8, 1_000_000, 10_000) == 8
    assert bucket_count(10**11, 4000, 1_000_000, 10_000) == 100_000  # rows per task stay bounded


def test_expression_keys_in_many_buckets(spark):
    df = spark.createDataFrame([(i % 50, f"c{i:04d}") for i in range(2000)], "days int, c string")
    got = dense_key(df, [-F.col("days"), F.col("c")], "k", rows_per_bucket=100)
    w = Window.orderBy(F.col("days").desc(), "c")
    assert got.withColumn("want", F.row_number().over(w)).filter("k <> want").count() == 0
    assert dict(got.dtypes)["k"] == "bigint" and got.columns == ["days", "c", "k"]


def test_uncounted_key_fails(spark):
    df = spark.createDataFrame([(i,) for i in range(3000)], "a int")
    few = df.filter("a < 100")
    with pytest.raises(Exception, match="missing from keys_src"):
        dense_key(df, ["a"], "k", keys_src=few, sample_src=df, size_hint=3000,
                  rows_per_bucket=300).collect()


def test_plan_has_no_global_window_over_rows(spark):
    df = spark.createDataFrame([(f"id{random.random()}", i) for i in range(3000)], "a string, b int")
    plan = dense_key(df, ["a"], "k", rows_per_bucket=300)._jdf.queryExecution() \
        .executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    partitioned = [w for w in windows if re.search(r"\], \[_bucket#\d+\], \[", w)]
    unpartitioned = [w for w in windows if w not in partitioned]
    # The row numbers are partitioned by bucket; the only window without a
    # PARTITION BY is the running sum over the per-bucket counts.
    assert len(partitioned) == 1 and "row_number()" in partitioned[0]
    assert len(unpartitioned) == 1 and "sum(_cnt" in unpartitioned[0]


def test_two_level_lookup_many_buckets(spark):
    # 120 buckets: coarse CASE tree + broadcast range lookup.
    rows = [("hot" if i % 3 == 0 else f"k{i:05d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "a string, b int")
    _check(df, ["a", "b"], rows_per_bucket=50, min_rows_per_bucket=1)
    plan = dense_key(df, ["a", "b"], "k", rows_per_bucket=50, min_rows_per_bucket=1) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_c" in plan


def test_double_keys_with_nan_and_nulls(spark):
    vals = [float("nan") if i % 11 == 0 else (None if i % 13 == 0 else (i % 97) / 7.0)
            for i in range(4000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "d double, i int")
    _check(df, ["d", "i"], join_on=["i"], rows_per_bucket=100, min_rows_per_bucket=1)
    _check(df, ["d", "i"], join_on=["i"], rows_per_bucket=30, min_rows_per_bucket=1)  # two-level


def test_cluster_conf_sizes():
    from martline.session import cluster_conf
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 4000)
    # 20 GB shuffled / 256 MB = 80, below the floor of two waves of 64 cores.
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000       # capped
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_key_columns_are_not_exchanged_twice(spark):
    from pyspark.sql import functions as F

    from martline.operators.dense_key import dense_key
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("a"), F.col("id").cast("string").alias("b"))
    out = dense_key(df, ["a", F.upper("b")], "k", rows_per_bucket=500)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_k0" not in plan and "_k1" in plan and out.columns == ["a", "b", "k"]
    assert {(r.a, r.k) for r in out.collect()} == {(i, i + 1) for i in range(3000)}
