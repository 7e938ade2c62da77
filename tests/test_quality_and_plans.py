"""Quality runner behaviour and physical-plan properties of the queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martline import schemas
from martline.plans import quality
from tests.conftest import SF_SMALL


def test_enforce_lists_every_failure(spark):
    fact = spark.createDataFrame(
        [(1, "o1", 1, None, 1, 1, -5.0, -1.0), (2, "o1", 1, 1, None, 1, 3.0, 1.0)],
        "fact_sales_key int, order_id string, order_item_id int, customer_key int, "
        "product_key int, seller_key int, gross_sales_value double, freight_value double")
    res = {r.check: r.result for r in quality.run(fact, quality.fact_sales_checks()).collect()}
    assert res == {"null_customer_key_count": 1, "null_product_key_count": 1,
                   "null_seller_key_count": 0, "duplicate_order_item_rows": 1,
                   "negative_gross_sales_rows": 1, "negative_freight_rows": 1}
    with pytest.raises(AssertionError) as e:
        quality.enforce(quality.run(fact, quality.fact_sales_checks()))
    for name in ["null_customer_key_count", "duplicate_order_item_rows", "negative_freight_rows"]:
        assert name in str(e.value)


def test_clean_fact_passes(spark):
    fact = entry.queries()["fact_sales"](spark, SF_SMALL)
    quality.enforce(quality.run(fact, quality.key_checks("fact_sales", ["fact_sales_key"])))


def test_strict_csv_fails_on_bad_value(spark, scratch):
    from martline.sources import files
    path = scratch("strict")
    spark.createDataFrame([("a", "1"), ("b", "x")], "id string, n string").write.option(
        "header", True).csv(path)
    with pytest.raises(Exception):
        files.read_csv(spark, path, schemas._struct(("id", schemas.S), ("n", schemas.I)),
                       strict=True).collect()
    lenient = files.read_csv(spark, path, schemas._struct(("id", schemas.S), ("n", schemas.I)))
    assert sorted((r.id, r.n) for r in lenient.collect()) == [("a", 1), ("b", None)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PY_NODES = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF"]


@pytest.mark.parametrize("name", ["fact_sales_enriched", "payments_agg", "dim_product",
                                  "quality_fact_sales", "rfm_segments", "run_summary"])
def test_no_python_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES)


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(entry.queries()["payments_agg"](spark, SF_SMALL))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "PushedFilters: [IsNotNull(l_" in scan
    # Only the five columns the payment totals need are read from lineitem
    # (payment_type is never NULL, so its rule folds away with its column).
    schema = scan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"])


def test_dedup_reduces_before_the_shuffle(spark):
    plan = _plan(entry.queries()["clean_items"](spark, SF_SMALL))
    body = plan.split("Exchange hashpartitioning(order_id")[1]
    assert "WindowGroupLimit" in body     # partial limit below the exchange


def test_enriched_fact_shares_order_id_partitioning(spark):
    """items ⋈ orders ⟕ payments run on one hashpartitioning of order_id:
    no exchange re-shuffles the joined rows by order_id."""
    plan = _plan(entry.queries()["fact_sales_enriched"](spark, SF_SMALL))
    assert plan.count("hashpartitioning(order_id") <= 4


def test_jdbc_append_and_parallel_read(spark, scratch):
    from martline.sources import jdbc
    url = jdbc.derby_url(scratch("derby-append"))
    df = spark.range(100).selectExpr("CAST(id AS INT) AS k", "CAST(id * 2 AS STRING) AS v")
    jdbc.write_table(df, url, "T", jdbc.DERBY_PROPS, mode="append")
    jdbc.write_table(df, url, "T", jdbc.DERBY_PROPS, mode="append")
    back = jdbc.read_table(spark, url, "T", jdbc.DERBY_PROPS, mod_column='"k"', num_partitions=4)
    assert back.rdd.getNumPartitions() == 5 and back.count() == 200
    ranged = jdbc.read_table(spark, url, "T", jdbc.DERBY_PROPS, partition_column='"k"',
                             lower=0, upper=100, num_partitions=4)
    assert ranged.count() == 200


def test_failed_job_task_is_logged(spark, scratch):
    from martline.jobs import Run
    run = Run(spark, scratch("failing"), run_id="f")
    run.task("ok", lambda: None)
    with pytest.raises(ZeroDivisionError):
        run.task("boom", lambda: 1 / 0)
    states = {r.task_id: r.state for r in run.read("runlog").collect()}
    assert states == {"ok": "success", "boom": "failed"}


def test_csv_pandas_missing_tokens(spark, scratch):
    from martline.sources import files
    path = scratch("na-csv")
    spark.createDataFrame([("o1", "NA", "3"), ("o2", "null", "N/A"), ("o3", "x", "4")],
                          "id string, c string, n string").write.option("header", True).csv(path)
    sch = schemas._struct(("id", schemas.S), ("c", schemas.S), ("n", schemas.I))
    rows = {r.id: (r.c, r.n) for r in
            files.read_csv(spark, path, sch, na_values=files.PANDAS_NA_VALUES).collect()}
    assert rows == {"o1": (None, 3), "o2": (None, None), "o3": ("x", 4)}
    plain = {r.id: r.c for r in files.read_csv(spark, path, sch).collect()}
    assert plain["o1"] == "NA"                      # Spark alone keeps the token


def test_hot_order_is_split_in_both_fact_joins(spark):
    """Final plans of the two ``order_id`` joins over written tables: AQE splits
    an order that holds a third of the items."""
    from pyspark.sql import functions as F

    from martline.plans import facts
    from martline.session import written
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        order = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 9000).cast("string"))
        items = written(spark.range(n).select(order.alias("order_id"), F.col("id").alias("order_item_id"),
                                              F.repeat(F.lit("x"), 50).alias("product_id")), "t-items")
        ids = items.select("order_id").distinct()
        orders = written(ids.withColumn("customer_id", F.lit("c")), "t-orders")
        payments = ids.withColumns({"payment_value": F.lit(1.0), "payment_installments": F.lit(1)})
        first = items.join(orders, "order_id")
        second = written(first, "t-base").join(
            written(facts.payments_per_order(payments), "t-pay"), "order_id", "left")
        for df in (first, second):
            assert len(df.collect()) == n
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rfm_scans_the_measures_only(spark, monkeypatch):
    from martline.operators import multi_quantile
    from martline.plans import rfm
    from martline.plans import warehouse as wh
    sf = "/root/testdata/sf0.001"
    staged = wh.staged(spark, sf, "orders"), wh.staged(spark, sf, "payments")
    one = rfm.segments(*staged)
    monkeypatch.setattr(multi_quantile, "FETCH", 0)
    df = rfm.segments(*staged)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "lineitem.parquet" not in plan
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, one.collect()))


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    from martline.plans import facts
    monkeypatch.setattr(facts, "BROADCAST_DIM", 0)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_wide_fact_rows_move_for_no_dimension(spark, monkeypatch, no_broadcast):
    """Dimensions are looked up before the order join, and what follows from
    other columns is neither written nor exchanged."""
    from martline.plans import facts
    from martline.plans import warehouse as wh
    tables = {}
    keep = facts.written
    monkeypatch.setattr(facts, "written", lambda df, name, **o: tables.setdefault(
        name, (_plan(df), keep(df, name, **o)))[1])
    fact = wh.fact_sales(spark, SF_SMALL, enriched=True, rows_per_bucket=1000)
    plan, base = tables["fact-base"]
    joins = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
    assert "[order_id" in joins[0] and any("[product_id" in j for j in joins[1:])
    assert not any("[customer_id" in j for j in joins) and "customer_key" in tables["fact-orders"][1].columns
    assert not {"gross_sales_value", "delivery_days", "is_delayed", "avg_payment_value"} & set(base.columns)
    got = fact.collect()
    one = wh.fact_sales(spark, SF_SMALL, enriched=True).collect()
    assert len(got) > 1000 and sorted(r.fact_sales_key for r in got) == list(range(1, len(got) + 1))
    cut = lambda r: tuple(round(v, 4) if isinstance(v, float) else v for v in r)
    assert sorted(map(cut, got), key=str) == sorted(map(cut, one), key=str)


def test_unvalidated_fact_looks_up_below_the_order_join(spark, no_broadcast):
    from martline.plans import unvalidated
    plan = _plan(unvalidated.fact(spark, SF_SMALL, unvalidated.deliveries(spark, SF_SMALL)[0]))
    joins = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
    assert "[order_id" in joins[0] and any("[customer_id" in j for j in joins[1:])


def test_quality_keys_reads_the_written_staging(spark):
    """The fact is built from the staging tables that are checked, not from
    the inputs again: only the payments' check scans them."""
    from pyspark.sql import DataFrame, DataFrameReader
    scans = []
    keep = DataFrameReader.parquet

    def parquet(self, *paths, **options):
        scans.extend(p for p in paths if p.endswith(("/lineitem.parquet", "/orders.parquet")))
        return keep(self, *paths, **options)

    DataFrameReader.parquet = parquet
    try:
        df = entry.queries()["quality_keys"](spark, SF_SMALL)
    finally:
        DataFrameReader.parquet = keep
    assert isinstance(df, DataFrame) and df.where("NOT passed").count() == 0
    # A count of each, one read for each staging table.
    assert sorted(p.rsplit("/", 1)[1] for p in scans) == ["lineitem.parquet"] * 3 + ["orders.parquet"] * 2


@pytest.mark.parametrize("name, rows", [("quality_over_loads", 4), ("fact_sales_copartitioned", 1)])
def test_buckets_grow_with_the_input(spark, monkeypatch, name, rows):
    from martline.plans import warehouse as wh
    from martline.sources import bucketed
    made = []
    keep = bucketed.BucketedTable.__init__

    def init(self, spark, path, schema, keys, buckets):
        made.append(buckets)
        keep(self, spark, path, schema, keys, buckets)

    monkeypatch.setattr(bucketed.BucketedTable, "__init__", init)
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 200)
    items = wh.input_bounds(spark, SF_SMALL, "items")["items"]
    entry.queries()[name](spark, SF_SMALL)
    assert set(made) == {-(-rows * items // 200)}
