"""Persistent dense keys, order statistics without a sort, one-scan and
incremental quality checks, bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martline.operators import multi_quantile
from martline.operators.incremental_key import KeyStore
from martline.plans import quality, quality_state, rfm, unvalidated
from martline.session import scratch_path
from martline.sources.bucketed import BucketedTable
from tests.conftest import SF_SMALL

NATURAL = StructType([StructField("a", StringType()), StructField("b", LongType())])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def null_last(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def store_at(spark, path, **opts):
    return KeyStore(spark, path, NATURAL, "k", **{"buckets": 4, "rows_per_bucket": 50, "min_rows_per_bucket": 5, **opts})


def test_keys_of_later_loads(spark):
    path = scratch_path(spark, "keys")
    rnd = random.Random(1)
    loads = [[(rnd.choice(["x", "y", None, "zz"]), rnd.choice([None, *range(200)])) for _ in range(n)] for n in (300, 0, 500, 20)]
    seen, want = [], {}
    for rows in loads:
        got = store_at(spark, path).load(spark.createDataFrame(rows, NATURAL))  # a new object each time, as a new session
        fresh = sorted(set(rows) - set(want), key=null_last)
        want |= {k: len(want) + i + 1 for i, k in enumerate(fresh)}
        assert {(r.a, r.b): r.k for r in got.collect()} == want
        assert all(got.where(F.col("load") <= n).count() == c for n, c in seen)
        seen.append((len(seen) + 1, len(want)))


def test_an_uncommitted_load_never_happened(spark, monkeypatch):
    path = scratch_path(spark, "keys")
    store = store_at(spark, path)
    store.load(spark.createDataFrame([("a", 1), ("b", 2)], NATURAL))
    # The keys of a second load are written, its state isn't.
    monkeypatch.setattr(spark.__class__, "createDataFrame", None)
    with pytest.raises(TypeError):
        store.load(spark.range(3).select(F.lit("c").alias("a"), F.col("id").alias("b")))
    monkeypatch.undo()
    again = store_at(spark, path)
    assert sorted(r.k for r in again.keys().collect()) == [1, 2]
    got = again.load(spark.createDataFrame([("d", 4), ("a", 1)], NATURAL)).collect()
    assert {(r.a, r.b): r.k for r in got} == {("a", 1): 1, ("b", 2): 2, ("d", 4): 3}


def test_old_keys_are_not_exchanged(spark):
    store = store_at(spark, scratch_path(spark, "keys"), buckets=4)
    store.load(spark.range(500).select(F.col("id").cast("string").alias("a"), F.col("id").alias("b")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(store.unseen(spark.range(900).select(F.col("id").cast("string").alias("a"), F.col("id").alias("b"))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    old = text[text.index("FileScan") - 300:]
    assert "Bucketed: true" in old and "Exchange" not in old


def test_a_load_is_written_again_alone(spark):
    table = BucketedTable(spark, scratch_path(spark, "bucketed"), NATURAL, ["a"], 3)
    one = spark.createDataFrame([("x", 1), ("y", 2)], NATURAL)
    table.write(one, 1)
    table.write(one, 2)
    table.write(spark.createDataFrame([("z", 3)], NATURAL), 1)
    assert sorted((r.load, r.a) for r in table.read(2).collect()) == [(1, "z"), (2, "x"), (2, "y")]
    assert "Exchange" not in plan(table.read(2).groupBy("a").count())


@pytest.mark.parametrize("fetch", [0, 40])
def test_keys_at_ranks_equal_a_sort(spark, monkeypatch, fetch):
    monkeypatch.setattr(multi_quantile, "FETCH", fetch)
    rnd = random.Random(fetch)
    rows = [(f"{i * 7919 % 1009}" if i % 3 else f"é{i}", rnd.choice([None, -5, 0, 3, 10**13]), rnd.randrange(-10**6, 10**6), 4)
            for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, few long, many long, one long")
    ranks = [1, 2, 333, 500, 999, 1000, 1001]
    n, got = multi_quantile.keys_at_ranks(df, {c: F.col(c) for c in ("few", "many", "one")}, "id", lambda n: ranks)
    assert n == 1000
    for i, c in enumerate(("few", "many", "one"), 1):
        order = sorted(((r[i] is None, r[i] or 0, r[0].encode()), r[i], r[0]) for r in rows)
        assert got[c] == [(order[k - 1][1], order[k - 1][2]) if k <= 1000 else None for k in ranks], c
        for cut, k in zip(got[c], ranks, strict=True):
            if cut is not None:
                assert df.where(multi_quantile.at_or_after(F.col(c), F.col("id"), cut)).count() == 1001 - k
    assert multi_quantile.keys_at_ranks(df.limit(0), {"few": F.col("few")}, "id", lambda n: [1]) == (0, {"few": [None]})


def test_tiles():
    for n in range(23):
        starts, tiles = rfm.tile_starts(n), [sum(r >= s for s in rfm.tile_starts(n)) + 1 for r in range(1, n + 1)]
        sizes = [tiles.count(t) for t in range(1, 6)]
        assert sizes == sorted(sizes, reverse=True) and (not n or max(sizes) - min(sizes) <= 1) and len(starts) == 4


def test_segments_need_no_sort(spark, monkeypatch):
    from martline.plans import warehouse as wh
    out = rfm.segments(wh.staged(spark, SF_SMALL, "orders"), wh.staged(spark, SF_SMALL, "payments"))
    assert "Sort" not in plan(out) and "Window" not in plan(out) and "Exchange" not in plan(out)


def checks():
    return [quality.count_if("minus", F.col("x") < 0), quality.count_if("null_b", F.col("b").isNull()),
            quality.duplicate_keys("dup_ab", ["a", "b"]), quality.duplicate_keys("dup_b", ["b"]),
            quality.duplicate_keys("dup_a", ["a"])]


def brute(rows):
    from collections import Counter
    dup = lambda key: sum(n > 1 for n in Counter(map(key, rows)).values())
    return {"minus": sum(x is not None and x < 0 for *_, x in rows), "null_b": sum(b is None for _, b, _ in rows),
            "dup_ab": dup(lambda r: r[:2]), "dup_b": dup(lambda r: r[1]), "dup_a": dup(lambda r: r[0])}


def results(df):
    return {r["check"]: r["result"] for r in df.collect()}


@pytest.mark.parametrize("which", [slice(0, 2), slice(2, 3), slice(0, 3), slice(0, 5), slice(2, 5)])
def test_any_key_sets_in_one_scan(spark, which):
    rnd = random.Random(3)
    rows = [(rnd.choice(["p", "q", None]), rnd.choice([None, *range(40)]), rnd.choice([None, -1, 2])) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b int, x int")
    got = quality.run(df, checks()[which])
    want = {n: v for n, v in brute(rows).items() if n in [c[0] for c in checks()[which]]}
    assert results(got) == want
    assert plan(got).count("Scan ") == 1
    assert results(quality.run(df.limit(0), checks()[which])) == dict.fromkeys(want, 0)


def test_states_of_loads_merge(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["p", "q", None]), rnd.choice([None, *range(60)]), rnd.choice([None, -1, 2])) for _ in range(90)]
    df = lambda r: spark.createDataFrame(r, "a string, b int, x int")
    state = quality_state.QualityState(spark, scratch_path(spark, "state"), checks(), buckets=3)
    for load, part in enumerate((rows[:40], [], rows[40:60]), 1):
        state.add(df(part), load)
    assert results(state.results()) == brute(rows[:60])
    assert results(state.results(up_to=1)) == brute(rows[:40])
    state.add(df(rows[60:]), 2)  # the empty load comes again with rows
    assert results(state.results()) == brute(rows)
    assert {(r.load, r.result) for r in state.by_load().where("check = 'null_b'").collect()} == {
        (load, brute(part)["null_b"]) for load, part in ((1, rows[:40]), (2, rows[60:]), (3, rows[40:60]))}
    assert "Exchange hashpartitioning(set" not in plan(state.results())


def test_every_check_fails_on_unvalidated_facts(spark):
    sf = "/root/testdata/sf0.01"
    first, again = unvalidated.deliveries(spark, sf)
    got = quality.run(unvalidated.fact(spark, sf, first.unionByName(again)), unvalidated.checks())
    rows = got.collect()
    assert len(rows) == 11 and all(r["result"] > 0 and not r["passed"] for r in rows), rows
    with pytest.raises(AssertionError, match="mismatched_payment_count"):
        quality.enforce(got)


def test_order_tables_join_without_exchange(spark):
    """Also with an order that has a third of the items: it fills many parts."""
    from martline.plans import copartitioned, facts
    from martline.plans import warehouse as wh
    orders, items, payments = (wh.staged(spark, SF_SMALL, e) for e in ("orders", "items", "payments"))
    hot = orders.first()["order_id"]
    more = items.limit(1).crossJoin(spark.range(2500)).withColumns(
        {"order_id": F.lit(hot), "order_item_id": (F.col("id") + 1000).cast("int")}).drop("id").select(*items.columns)
    items = items.unionByName(more.select(*[F.col(f.name).cast(f.dataType) for f in items.schema.fields]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = copartitioned.OrderTables.stage(spark, scratch_path(spark, "tables"), orders, items, payments,
                                                 buckets=4, hot_rows=300)
        got = tables.joined()
        assert "Exchange" not in plan(got) and "Bucketed: true" in plan(got)
        parts = tables.items.read(1).where(F.col("order_id") == hot).groupBy("_part").count().collect()
        assert len(parts) >= 8 and max(r["count"] for r in parts) < 500
        want = (items.select(*facts.ITEM_COLS).join(orders.select(*facts.ORDER_COLS), "order_id")
                .join(facts.payments_per_order(payments), "order_id", "left").select(*got.columns))
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_totals_follow_changes(spark):
    from martline.plans import facts, maintained
    rnd = random.Random(6)
    schema = "order_id string, payment_sequential int, payment_value double, payment_installments int"
    now: dict = {}
    totals = maintained.PaymentTotals(spark, scratch_path(spark, "totals"), buckets=3)
    for load in range(1, 6):
        changes = []
        for _ in range(60):
            key = (f"o{rnd.randrange(12)}", rnd.randrange(6))
            if key in now and rnd.random() < 0.6:
                changes.append((-1, key[0], *now.pop(key)))
            if key not in now and rnd.random() < 0.7:
                now[key] = (rnd.randrange(1000) / 100, rnd.choice([None, *range(9)]))
                changes.append((1, key[0], *now[key]))
        rows = spark.createDataFrame([(*k, *v) for k, v in now.items()], schema)
        df = spark.createDataFrame(changes, "sign int, order_id string, payment_value double, payment_installments int")
        for _ in range(1 + load % 2):  # some loads are applied twice
            totals.apply(df, rows, load)
        key = lambda r: (r.order_id, round(r.total_payment_value, 2), r.payment_count, r.max_installments)
        assert sorted(map(key, totals.totals().collect()), key=str) == sorted(
            map(key, facts.payments_per_order(rows).collect()), key=str)


def test_lossless_types(spark):
    from martline.sources import infer
    cols = {"zeros": ["01409", "7", None], "whole": ["0", "-12", "2147483647"], "big": ["2147483648", "1", None],
            "huge": ["99999999999999999999", "1", "2"], "real": ["1.50", "-0.25", "3"], "long_real": ["0.1234567890123456", "1", "2"],
            "exp": ["1e5", "2", "3"], "minus": ["-0", "1", "2"], "flag": ["true", "false", None], "day": ["2024-02-29", None, "1999-12-31"],
            "bad_day": ["2023-02-29", None, "1999-12-31"], "time": ["2024-01-01 10:00:00", "2024-01-01", None],
            "words": ["x", "1", ""], "none": [None, None, None], "space": [" 1", "2", "3"]}
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"`{c}` string" for c in cols))
    got = {f.name: f.dataType.simpleString() for f in infer.infer(df).fields}
    assert got == {"zeros": "string", "whole": "int", "big": "bigint", "huge": "string", "real": "double", "long_real": "string",
                   "exp": "string", "minus": "string", "flag": "boolean", "day": "date", "bad_day": "string",
                   "time": "timestamp_ntz", "words": "string", "none": "string", "space": "string"}
    assert {f.dataType.simpleString() for f in infer.infer(df.limit(0)).fields} == {"string"}
