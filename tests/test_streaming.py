"""Keyed upsert sink, conflict policies, retries, watermark guard."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampNTZType

from martline import schemas
from martline.plans import stage
from martline.streaming import upsert, watermark

KEYS = ["order_id"]
COLS = stage.TABLE_SCHEMA["orders"].names


def _batch(spark, rows):
    """rows: (order_id, status, offset)"""
    day = dt.datetime(2024, 1, 1)
    data = [(o, "c", s, None, None, None, None, None, day + dt.timedelta(seconds=off), 0, off)
            for o, s, off in rows]
    schema = StructType(schemas.ORDERS.fields + [
        StructField("_time", TimestampNTZType()), StructField("_partition", IntegerType()),
        StructField("_offset", LongType())])
    return spark.createDataFrame(data, schema)


def _table(spark, target, policy):
    return {r.order_id: r.order_status
            for r in upsert.read(spark, target, KEYS, schemas.ORDERS, policy).collect()}


@pytest.mark.parametrize("policy", ["first", "last"])
def test_policies_and_retry_idempotence(spark, scratch, policy):
    target = scratch("upsert")
    upsert.write_batch(_batch(spark, [("a", "created", 1), ("b", "created", 2),
                                      ("a", "paid", 3)]), 0, target, KEYS, COLS, policy)
    upsert.write_batch(_batch(spark, [("a", "delivered", 4), ("c", "created", 5)]), 1,
                       target, KEYS, COLS, policy)
    before = _table(spark, target, policy)
    # A retry of batch 1 with the same rows changes nothing.
    upsert.write_batch(_batch(spark, [("a", "delivered", 4), ("c", "created", 5)]), 1,
                       target, KEYS, COLS, policy)
    assert _table(spark, target, policy) == before
    if policy == "first":
        assert before == {"a": "created", "b": "created", "c": "created"}
    else:
        assert before == {"a": "delivered", "b": "created", "c": "created"}


def test_insert_time_kept_on_update(spark, scratch):
    target = scratch("upsert-ts")
    upsert.write_batch(_batch(spark, [("a", "created", 1)]), 0, target, KEYS, COLS, "last")
    first = upsert.read(spark, target, KEYS, schemas.ORDERS, "last").first().kafka_ingested_at
    upsert.write_batch(_batch(spark, [("a", "paid", 2)]), 1, target, KEYS, COLS, "last")
    row = upsert.read(spark, target, KEYS, schemas.ORDERS, "last").first()
    assert row.order_status == "paid" and row.kafka_ingested_at == first


def test_empty_batch_and_empty_table(spark, scratch):
    target = scratch("upsert-empty")
    upsert.write_batch(_batch(spark, []), 0, target, KEYS, COLS, "first")
    assert upsert.read(spark, target, KEYS, schemas.ORDERS, "first").count() == 0


def _run_windows(spark, scratch, guarded):
    base = dt.datetime(2024, 1, 1)
    b0 = [(base + dt.timedelta(minutes=i), "x") for i in range(0, 120, 7)]
    b0.append((dt.datetime(3992, 1, 1), "x"))  # a stray year in the first batch
    b1 = [(base + dt.timedelta(hours=5, minutes=i), "x") for i in range(0, 60, 7)]
    root, out, ckpt = scratch("wm-in"), scratch("wm-out"), scratch("wm-ckpt")
    schema = "event_time timestamp_ntz, kind string"
    for i, rows in enumerate([b0, b1]):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/batch-{i}")
        s = spark.readStream.schema(schema).parquet(f"{root}/*")
        if guarded:
            s = watermark.guard(s, "event_time")
        counts = watermark.windowed_counts(s, "event_time", "10 minutes", "1 hour", ["kind"])
        q = counts.writeStream.outputMode("update").foreachBatch(
            lambda df, bid: df.write.mode("append").parquet(out))
        q.option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).filter(F.year("window_start") < 3000) \
        .groupBy("window_start").agg(F.max("row_count").alias("n"))


def test_watermark_guard_keeps_later_batches(spark, scratch):
    guarded = _run_windows(spark, scratch, True)
    assert guarded.filter(F.hour("window_start") == 5).count() == 1
    unguarded = _run_windows(spark, scratch, False)
    # Without the guard the stray year makes the whole second batch late.
    assert unguarded.filter(F.hour("window_start") == 5).count() == 0


def test_new_run_never_overwrites(spark, scratch):
    target = scratch("upsert-runs")
    upsert.write_batch(_batch(spark, [("a", "created", 1)]), 0, target, KEYS, COLS, "last", "one")
    upsert.write_batch(_batch(spark, [("b", "created", 2)]), 0, target, KEYS, COLS, "last", "two")
    # The first message again, read by the new run: the same version.
    upsert.write_batch(_batch(spark, [("a", "created", 1)]), 1, target, KEYS, COLS, "last", "two")
    assert _table(spark, target, "last") == {"a": "created", "b": "created"}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


# ``scratch`` hands out a fresh folder per call, so sharing it is safe.
@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["x", "y", "z"])),
                min_size=1, max_size=12), st.randoms())
def test_last_wins_is_order_independent_within_a_batch(spark, scratch, msgs, rnd):
    rows = [(k, s, off) for off, (k, s) in enumerate(msgs)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    results = []
    for order in (rows, shuffled):
        target = scratch("upsert-prop")
        upsert.write_batch(_batch(spark, order), 0, target, KEYS, COLS, "last")
        results.append(_table(spark, target, "last"))
    expected = {}
    for k, s, _ in rows:
        expected[k] = s                       # highest offset wins
    assert results[0] == results[1] == expected


def test_bounded_state_dedup_within_watermark(spark, scratch):
    from martline.streaming import consumer
    from martline.streaming.sources import message_file_stream, write_messages
    orders = spark.createDataFrame([
        ("o1", "c", "created", dt.datetime(2024, 1, 1, 10), None, None, None, None),
        ("o2", "c", "created", dt.datetime(2024, 1, 1, 11), None, None, None, None)],
        schemas.ORDERS)
    msgs = stage.encode("orders", orders)
    root, out, ckpt = scratch("wm-topic"), scratch("wm-out"), scratch("wm-ckpt")
    write_messages(msgs, f"{root}/0")
    write_messages(msgs, f"{root}/1")              # the same messages again
    s = consumer.consumer_stream("orders", message_file_stream(spark, root, 1), "first",
                                 dedup_watermark=("order_purchase_timestamp", "1 day"))
    q = (s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == ["o1", "o2"]


def test_processing_time_trigger(spark, scratch):
    from martline.streaming import consumer
    from martline.streaming.sources import message_file_stream, write_messages
    orders = spark.createDataFrame([("o1", "c", "created", None, None, None, None, None)],
                                   schemas.ORDERS)
    root, target, ckpt = scratch("pt-topic"), scratch("pt-target"), scratch("pt-ckpt")
    write_messages(stage.encode("orders", orders), f"{root}/0")
    q = consumer.run("orders", message_file_stream(spark, root), target, ckpt, "last",
                     available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert consumer.staged_table(spark, "orders", target, "last").count() == 1


def test_accepted_and_rejected_rows_are_committed_together(spark, scratch, monkeypatch):
    """A stop between the two writes, then one before the commit, then a run to
    the end: readers never see half a batch."""
    from martline.streaming import consumer
    from martline.streaming.sources import message_file_stream, write_messages
    root, target, ckpt, bad = scratch("cm-topic"), scratch("cm-target"), scratch("cm-ckpt"), scratch("cm-bad")
    good = spark.createDataFrame([("o1", "c", "created", None, None, None, None, None)], schemas.ORDERS)
    write_messages(stage.encode("orders", good).unionByName(
        spark.createDataFrame([("k", '{"order_id":')], "key string, value string")), f"{root}/0")
    go = lambda: consumer.drain("orders", message_file_stream(spark, root), target, ckpt, "last", rejects=bad)
    stop = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped"))
    for place, name in ((stage, "reject_rows"), (upsert, "commit")):
        with monkeypatch.context() as m:
            m.setattr(place, name, stop)
            with pytest.raises(Exception, match="stopped"):
                go()
        assert consumer.staged_table(spark, "orders", target, "last").count() == 0
    assert consumer.rejected(spark, target, bad).count() == 0  # written, not committed
    go()
    assert consumer.staged_table(spark, "orders", target, "last").count() == 1
    assert [r["_value"] for r in consumer.rejected(spark, target, bad).collect()] == ['{"order_id":']


def test_rules_decode_each_message_once(spark):
    """No rule is pushed below the decoding, where each would decode again."""
    msgs = spark.createDataFrame([("a", '{"order_id":"o","order_item_id":1}'), ("b", '{"order_'), ("c", None)],
                                 "key string, value string")
    parsed = stage.parse("items", msgs, carry=["key"])
    assert {r.key: r.order_id for r in parsed.collect()} == {"a": "o", "b": None, "c": None}
    plan = stage.validate("items", parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_batches_of_messages_exchange_nothing(spark, scratch):
    """The batches come from one cleaned table, a row a key, so both malformed
    messages of a key lie in one file without an exchange."""
    from martline.streaming import replay
    clean_df = replay.cleaned_table(spark, "/root/testdata/sf0.001", "items")
    for df in replay.batches("items", clean_df):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    root = scratch("lie")
    replay.write_batches("items", clean_df, root, [4])
    files = (spark.read.parquet(f"{root}/*").groupBy("key")
             .agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count(F.lit(1)).alias("n")))
    assert files.where("files > 1 OR n <> 2").count() == 0 and files.count() == clean_df.count()


def test_rejects_hold_no_batch_in_memory(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrame

    from martline.streaming import consumer
    from martline.streaming.sources import message_file_stream, write_messages
    root, target, ckpt, bad = scratch("np-topic"), scratch("np-target"), scratch("np-ckpt"), scratch("np-bad")
    write_messages(spark.createDataFrame([("k", '{"order_id":')], "key string, value string"), f"{root}/0")
    monkeypatch.setattr(DataFrame, "persist", lambda *a, **k: (_ for _ in ()).throw(AssertionError("persisted")))
    consumer.drain("orders", message_file_stream(spark, root), target, ckpt, "last", rejects=bad)
    assert consumer.rejected(spark, target, bad).count() == 1
