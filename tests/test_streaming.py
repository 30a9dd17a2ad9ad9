"""Batch vs stream parity: split the message frames into time-ordered files,
replay them one file per micro-batch, compare with the batch query; plus a
crash-and-restart replay for the order job."""
import os

from pyspark.sql import functions as F

from tideline.functions import schemas as S
from tideline.plans import params as P
from tideline.plans.queries import QUERIES
from tideline.sources import messages as M
from tideline.streaming import jobs
from tideline.streaming.io import message_file_stream, MESSAGE_COLUMNS
from tideline.streaming.table import IncrementTable, current
from conftest import SF_MID, SF_SMALL

AVAILABLE_NOW = {"availableNow": True}


def write_splits(frame, split_col, path):
    """Append one parquet file per split value, oldest first."""
    keys = sorted(r[0] for r in frame.select(split_col).distinct().collect())
    for k in keys:
        (frame.where(F.col(split_col) == k).select(*MESSAGE_COLUMNS)
              .coalesce(1).write.mode("append").parquet(path))
    return len(keys)


def run(q, timeout=300):
    q.awaitTermination(timeout)
    if q.isActive:
        q.stop()
        raise AssertionError("stream did not finish")
    assert q.exception() is None, q.exception()


def start_log_files(spark, sf, scratch, n_days=5):
    msgs = M.start_log_messages(spark, sf, with_batch=True)
    first_day = msgs.agg(F.min("batch_id")).first()[0]
    frame = msgs.withColumn("split", F.floor((F.col("batch_id") - first_day) / n_days))
    path = os.path.join(scratch, "start_msgs")
    n = write_splits(frame, "split", path)
    return path, n


def test_dau_streams_match_batch(spark, scratch):
    path, n = start_log_files(spark, SF_MID, scratch)
    assert n >= 5
    batch = QUERIES["dau_info"](spark, SF_MID)
    expected_rows = sorted(tuple(r) for r in batch.collect())
    expected_keys = sorted((r.dt, r.mid) for r in batch.collect())

    out_w = os.path.join(scratch, "dau_wm")
    q = jobs.start_dau_watermark(message_file_stream(spark, path), out_w,
                                 os.path.join(scratch, "ck_wm"), AVAILABLE_NOW)
    run(q)
    got_keys = sorted((str(r.dt), r.mid) for r in spark.read.parquet(out_w).collect())
    assert got_keys == expected_keys

    out_x = os.path.join(scratch, "dau_exact")
    q = jobs.start_dau_exact(spark, message_file_stream(spark, path), out_x,
                             os.path.join(scratch, "ck_x"), AVAILABLE_NOW, compact_every=2)
    run(q)
    tbl = IncrementTable(spark, out_x, S.DAU_INFO, partition_by=["dt"])
    got = tbl.read().select(*[f.name for f in S.DAU_INFO.fields])
    assert sorted(tuple(r) for r in got.collect()) == expected_rows


def _order_setup(spark, scratch, sf):
    rows = M.order_info_rows(spark, sf)
    msgs = M.order_messages(spark, sf, rows=rows).join(
        rows.select(F.col("id").cast("string").alias("key"), F.substring("create_time", 1, 4).alias("yr")), "key")
    path = os.path.join(scratch, "order_msgs")
    n = write_splits(msgs, "yr", path)
    prov = os.path.join(scratch, "prov")
    users = os.path.join(scratch, "users")
    M.province_rows(spark, sf, missing_region=P.MISSING_REGION).write.parquet(prov)
    M.user_rows(spark, sf, missing_segment=P.MISSING_SEGMENT).write.parquet(users)
    return path, n, prov, users


def _wide_rows(df):
    return sorted(tuple(r[c] for c in S.ORDER_INFO_COLUMNS) for r in df.collect())


def test_order_stream_matches_full_history(spark, scratch):
    path, n, prov, users = _order_setup(spark, scratch, SF_SMALL)
    assert n >= 4
    root = os.path.join(scratch, "orders_out")
    ledger = jobs.ledger_table(spark, os.path.join(scratch, "ledger"))
    q = jobs.start_orders(spark, message_file_stream(spark, path), root, os.path.join(scratch, "ck_o"),
                          prov, users, AVAILABLE_NOW, ledger=ledger, as_of=P.AS_OF, compact_every=2)
    run(q)
    out = IncrementTable(spark, f"{root}/order_wide", S.ORDER_INFO).read()
    expected = QUERIES["order_wide"](spark, SF_SMALL)
    assert _wide_rows(out) == _wide_rows(expected)
    # State: one consumed row per user, pointing at the flagged order.
    st = IncrementTable(spark, f"{root}/user_state", S.USER_STATE).latest(["user_id"])
    firsts = expected.where("if_first_order = '1'").select(F.col("user_id").cast("string").alias("user_id"),
                                                           F.col("id").alias("first_order_id"))
    assert sorted(st.select("user_id", "first_order_id").collect()) == sorted(firsts.collect())
    # Ledger: every partition at its last offset + 1.
    led = {r.partition: r.until_offset for r in ledger.read().collect()}
    msgs = spark.read.parquet(path)
    assert led == {r.partition: r.m + 1 for r in msgs.groupBy("partition").agg(F.max("offset").alias("m")).collect()}


def test_order_stream_crash_after_state_write_replays_cleanly(spark, scratch):
    path, n, prov, users = _order_setup(spark, scratch, SF_SMALL)
    root = os.path.join(scratch, "orders_out")
    state = IncrementTable(spark, f"{root}/user_state", S.USER_STATE)
    output = IncrementTable(spark, f"{root}/order_wide", S.ORDER_INFO)
    body = jobs.order_batch(spark, state, output, lambda: spark.read.parquet(prov),
                            lambda: spark.read.parquet(users), as_of=P.AS_OF)
    crashed = []

    def crash_once(df, batch_id):
        body(df, batch_id)  # outputs and state are written ...
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("simulated failure before the checkpoint commit")

    ck = os.path.join(scratch, "ck_crash")

    def start():
        return (message_file_stream(spark, path).writeStream.foreachBatch(crash_once)
                .option("checkpointLocation", ck).trigger(availableNow=True).start())

    q = start()
    try:
        q.awaitTermination(300)
    except Exception:  # the simulated failure surfaces here
        pass
    assert crashed and q.exception() is not None
    run(start())  # restart from the checkpoint: batch 1 is replayed
    expected = QUERIES["order_wide"](spark, SF_SMALL)
    assert _wide_rows(output.read()) == _wide_rows(expected)


def test_dimension_stream_upserts(spark, scratch):
    v1 = M.province_messages(M.province_rows(spark, SF_SMALL, missing_region=P.MISSING_REGION))
    late = M.province_rows(spark, SF_SMALL).where(F.col("region_id") == str(P.MISSING_REGION))
    v2 = M.province_messages(M.province_rows_v2(spark, SF_SMALL).unionByName(late))
    path = os.path.join(scratch, "prov_msgs")
    write_splits(v1.withColumn("s", F.lit(0)).unionByName(v2.withColumn("s", F.lit(1))), "s", path)
    root = os.path.join(scratch, "dim")
    run(jobs.start_dim(spark, message_file_stream(spark, path), root, os.path.join(scratch, "ck_d"),
                       AVAILABLE_NOW))
    got = current(spark, root, S.BASE_PROVINCE)
    expected = QUERIES["dim_upsert"](spark, SF_SMALL)
    assert sorted(got.collect()) == sorted(expected.collect())


def test_cdc_stream_routes_like_batch(spark, scratch):
    msgs = M.cdc_object_messages(spark, SF_SMALL).withColumn("s", F.col("partition"))
    path = os.path.join(scratch, "cdc_msgs")
    write_splits(msgs, "s", path)
    root = os.path.join(scratch, "cdc_out")
    run(jobs.start_cdc_route(message_file_stream(spark, path), root, os.path.join(scratch, "ck_c"),
                             "object", AVAILABLE_NOW))
    got = spark.read.parquet(root).groupBy("topic").count()
    expected = QUERIES["cdc_route_object"](spark, SF_SMALL).groupBy("topic").count()
    assert sorted(got.collect()) == sorted(expected.collect())


def test_dau_ttl_state_stream_matches_batch(spark, scratch):
    from tideline.streaming.dau_state import dau_ttl_stream
    path, n = start_log_files(spark, SF_SMALL, scratch)
    out = os.path.join(scratch, "dau_ttl")
    total = spark.read.parquet(path).count()
    q = (dau_ttl_stream(message_file_stream(spark, path)).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", os.path.join(scratch, "ck_ttl"))
         .trigger(processingTime="1 second").start())
    # TTL eviction runs a no-data batch on every trigger, so the query never
    # goes idle (processAllAvailable would wait forever): poll, bounded.
    import time
    deadline = time.time() + 240
    try:
        while time.time() < deadline:
            assert q.exception() is None, q.exception()
            done = sum(p["numInputRows"] for p in q.recentProgress)
            if done >= total and q.lastProgress and q.lastProgress["numInputRows"] == 0:
                break
            time.sleep(1)
        else:
            raise AssertionError("TTL stream did not consume its input in time")
    finally:
        q.stop()
    got = spark.read.schema(S.DAU_INFO).parquet(out)
    expected = QUERIES["dau_info"](spark, SF_SMALL)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in expected.collect())


def test_increment_table_compaction_keeps_reads_equal(spark, scratch):
    t = IncrementTable(spark, os.path.join(scratch, "inc"), S.USER_STATE)
    batches = [[("1", "0", None), ("2", "1", 20)], [("1", "1", 11)], [("3", "1", 30), ("2", "1", 21)], [("4", "1", 40)]]
    for i, rows in enumerate(batches):
        t.write(spark.createDataFrame(rows, S.USER_STATE), i)
    before = {b: sorted(t.latest(["user_id"], before=b).collect()) for b in range(1, 5)}
    t.compact(upto=1, keys=["user_id"])
    t.compact(upto=2, keys=["user_id"])
    after = {b: sorted(t.latest(["user_id"], before=b).collect()) for b in range(1, 5)}
    assert after == before
    assert sorted(t.latest(["user_id"]).collect()) == before[4]
    only = spark.createDataFrame([("2",)], "user_id string")
    assert [r.first_order_id for r in t.latest(["user_id"], only=only).collect()] == [21]


def test_wide_orders_published_through_the_batch_sink(spark, scratch):
    path, n, prov, users = _order_setup(spark, scratch, SF_SMALL)
    sent = []
    sink = jobs.publish_wide_orders(lambda df: sent.append(df.count()), "DW_ORDER_INFO")
    state = IncrementTable(spark, os.path.join(scratch, "st"), S.USER_STATE)
    output = IncrementTable(spark, os.path.join(scratch, "out"), S.ORDER_INFO)
    body = jobs.order_batch(spark, state, output, lambda: spark.read.parquet(prov),
                            lambda: spark.read.parquet(users), as_of=P.AS_OF, sink=sink)
    run(message_file_stream(spark, path).writeStream.foreachBatch(body)
        .option("checkpointLocation", os.path.join(scratch, "ck_pub")).trigger(availableNow=True).start())
    assert sum(sent) == spark.read.parquet(path).count()


def test_increment_table_reads_around_missing_batches(spark, scratch):
    t = IncrementTable(spark, os.path.join(scratch, "inc2"), S.USER_STATE)
    for i, rows in [(0, [("1", "1", 10)]), (1, [("2", "1", 20)]), (3, [("3", "1", 30)]), (6, [("1", "1", 11)])]:
        t.write(spark.createDataFrame(rows, S.USER_STATE), i)  # batches 2, 4, 5 wrote nothing
    t.compact(upto=1, keys=["user_id"])
    got = {b: sorted((r.user_id, r.first_order_id) for r in t.latest(["user_id"], before=b).collect())
           for b in (2, 3, 4, 6, 7)}
    assert got[2] == got[3] == [("1", 10), ("2", 20)]
    assert got[4] == got[6] == [("1", 10), ("2", 20), ("3", 30)]
    assert got[7] == [("1", 11), ("2", 20), ("3", 30)]


def test_late_event_dropped_by_watermark_kept_by_exact_form(spark, scratch):
    """Events 19 days late.  Spark drops late rows against the watermark
    of the previous micro-batch, so they arrive two batches after the
    high-water event here."""
    import json
    day = 1704067200000  # 2024-01-01 UTC

    def start(mid, ts):
        return json.dumps({"common": {"mid": mid, "uid": "1", "ar": "2", "ch": "c", "vc": "3"}, "ts": ts})

    path = os.path.join(scratch, "late_msgs")
    batches = [[("m1", day + 86400000)], [("m2", day + 20 * 86400000)], [("m9", day + 20 * 86400000)],
               [("m5", day + 86400000), ("m1", day + 86400000 + 7200000)]]  # new device late; late duplicate
    off = 0
    for rows in batches:
        data = []
        for mid, ts in rows:
            data.append(("t", 0, off, None, start(mid, ts)))
            off += 1
        spark.createDataFrame(data, S.MESSAGE).coalesce(1).write.mode("append").parquet(path)

    out_w = os.path.join(scratch, "late_wm")
    q = jobs.start_dau_watermark(message_file_stream(spark, path), out_w, os.path.join(scratch, "ck_lw"),
                                 AVAILABLE_NOW)
    run(q)
    dropped = sum((p.get("stateOperators") or [{}])[0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress)
    got_w = sorted((str(r.dt), r.mid) for r in spark.read.parquet(out_w).collect())
    out_x = os.path.join(scratch, "late_x")
    run(jobs.start_dau_exact(spark, message_file_stream(spark, path), out_x, os.path.join(scratch, "ck_lx"),
                             AVAILABLE_NOW))
    got_x = sorted((r.dt, r.mid) for r in IncrementTable(spark, out_x, S.DAU_INFO, ["dt"]).read().collect())
    assert got_w == [("2024-01-02", "m1"), ("2024-01-21", "m2"), ("2024-01-21", "m9")]
    assert dropped == 2
    assert got_x == [("2024-01-02", "m1"), ("2024-01-02", "m5"), ("2024-01-21", "m2"), ("2024-01-21", "m9")]


def test_order_stream_stop_and_restart_gives_same_tables(spark, scratch):
    rows = M.order_info_rows(spark, SF_SMALL)
    msgs = M.order_messages(spark, SF_SMALL, rows=rows).join(
        rows.select(F.col("id").cast("string").alias("key"), F.substring("create_time", 1, 4).alias("yr")), "key")
    years = sorted(r[0] for r in msgs.select("yr").distinct().collect())
    path = os.path.join(scratch, "order_msgs")
    prov, users = os.path.join(scratch, "prov"), os.path.join(scratch, "users")
    M.province_rows(spark, SF_SMALL, missing_region=P.MISSING_REGION).write.parquet(prov)
    M.user_rows(spark, SF_SMALL, missing_segment=P.MISSING_SEGMENT).write.parquet(users)
    root, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    def append(ys):
        for y in ys:
            msgs.where(F.col("yr") == y).select(*MESSAGE_COLUMNS).coalesce(1).write.mode("append").parquet(path)

    def start():
        return jobs.start_orders(spark, message_file_stream(spark, path), root, ck, prov, users,
                                 AVAILABLE_NOW, as_of=P.AS_OF, compact_every=3)

    half = len(years) // 2
    append(years[:half])
    run(start())  # stops once the first files are done
    append(years[half:])
    run(start())  # restarts from the checkpoint and its state tables
    out = IncrementTable(spark, f"{root}/order_wide", S.ORDER_INFO).read()
    assert _wide_rows(out) == _wide_rows(QUERIES["order_wide"](spark, SF_SMALL))
