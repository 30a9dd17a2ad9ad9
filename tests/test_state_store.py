"""Streams with their state in the state store: first orders and devices of a day;
warm start, read-back, replay, a new checkpoint on a used folder, expiry by day."""
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tideline.functions import schemas as S
from tideline.operators import orders
from tideline.plans import params as P
from tideline.plans.queries import QUERIES
from tideline.sources import messages as M
from tideline.streaming import jobs, state
from tideline.streaming.io import MESSAGE_COLUMNS, message_file_stream
from conftest import SF_MID, SF_SMALL
from test_streaming import AVAILABLE_NOW, _order_setup, _wide_rows, run, start_log_files

DAY = 1704067200000  # 2024-01-01 UTC


@pytest.fixture()
def at(scratch):
    return lambda *p: os.path.join(scratch, *p)


def put(frame, path):
    frame.select(*MESSAGE_COLUMNS).coalesce(1).write.mode("append").parquet(path)


def wide_of(spark, root):
    return jobs.read_batches(spark, f"{root}/order_wide", S.ORDER_INFO)


def test_state_store_orders_match_full_history(spark, at, scratch):
    path, n, prov, users = _order_setup(spark, scratch, SF_SMALL)
    saved = []
    run(jobs.start_stateful_orders(spark, message_file_stream(spark, path), at("out"), at("ck"), prov, users, AVAILABLE_NOW,
                                   as_of=P.AS_OF, saved=lambda *a: saved.append(a)))
    assert _wide_rows(wide_of(spark, at("out"))) == _wide_rows(QUERIES["order_wide"](spark, SF_SMALL))
    assert [b for _, b, _ in saved] == list(range(n)) and sum(r for *_, r in saved) == spark.read.parquet(path).count()
    firsts = QUERIES["order_first_flag"](spark, SF_SMALL)  # K8: the state store read as a table
    got = {(r.user_id, r.first_order_id) for r in state.user_state(spark, at("ck")).collect()}
    assert len(got) == firsts.select("user_id").distinct().count()


def two_batches(spark, at):
    """The messages before and after the state cut, one file each."""
    before = M.order_messages(spark, SF_SMALL, rows=M.order_info_rows(spark, SF_SMALL, created_before=P.STATE_CUT))
    after = M.order_messages(spark, SF_SMALL, rows=M.order_info_rows(spark, SF_SMALL, created_since=P.STATE_CUT))
    put(before, at("msgs"))
    time.sleep(1.1)  # files are taken by age
    put(after, at("msgs"))
    return before, after


def flag_batches(spark, at, ck, crash_at=None, seed=None, path="msgs"):
    """Final and state flags of each batch through the state store, as one stream."""
    state.use_state_store(spark)
    seen = {}

    def body(df, batch_id):
        kept = df.persist()
        kept.count()
        rows, _ = jobs.split_valid(kept.where("first IS NULL").drop("first"))
        firsts = kept.where("first IS NOT NULL").select("first.*")
        flagged = orders.flags_of_firsts(rows, firsts).select("id", "user_id", "if_first_order")
        alone = orders.state_flags_of_firsts(rows, firsts).select("id", "user_id", "if_first_order")
        seen.setdefault(batch_id, []).append((sorted(map(tuple, flagged.collect())), sorted(map(tuple, alone.collect()))))
        kept.unpersist()
        if batch_id == crash_at and len(seen[batch_id]) == 1:
            raise RuntimeError("simulated failure before the checkpoint commit")

    def start():
        return jobs.orders_with_firsts(message_file_stream(spark, at(path)), seed).writeStream.foreachBatch(body) \
            .option("checkpointLocation", at(ck)).trigger(availableNow=True).start()

    q = start()
    if crash_at is not None:
        with pytest.raises(Exception):
            q.awaitTermination(300)
        q = start()
    run(q)
    return seen


@pytest.mark.parametrize("crash_at", [None, 0, 1])
def test_two_batches_equal_the_query_also_after_a_replay(spark, at, crash_at):
    two_batches(spark, at)
    seen = flag_batches(spark, at, "ck", crash_at)
    want = QUERIES["order_first_two_batches"](spark, SF_SMALL).collect()
    for batch_id in (0, 1):
        expected = sorted((r.id, r.user_id, r.if_first_order) for r in want if r.batch == batch_id + 1)
        assert len(seen[batch_id]) == (2 if crash_at == batch_id else 1)
        assert all(final == expected for final, _ in seen[batch_id])


def test_a_new_query_starts_from_a_user_state_table(spark, at):
    """Warm start: flags equal the batch queries over the same seed, and the state read
    back equals the upserted table."""
    seed = M.user_state_seed(spark, SF_SMALL, P.STATE_CUT)
    seed.write.parquet(at("seed"))
    after = M.order_messages(spark, SF_SMALL, rows=M.order_info_rows(spark, SF_SMALL, created_since=P.STATE_CUT))
    put(after, at("msgs"))
    (final, alone), = flag_batches(spark, at, "ck", seed=spark.read.parquet(at("seed")))[0]
    named = lambda q: sorted((r.id, r.user_id, r.if_first_order) for r in QUERIES[q](spark, SF_SMALL).collect())
    assert alone == named("order_state_flag")
    assert final == named("first_order_in_batch")
    stored = {tuple(r) for r in state.user_state(spark, at("ck")).collect()}
    assert stored == {tuple(r) for r in QUERIES["user_state"](spark, SF_SMALL).where("if_consumed = '1'").collect()}


def order(i, user, created, offset):
    return ("t", 0, offset, str(i), json.dumps({"id": i, "user_id": user, "province_id": 1, "create_time": created,
                                                "order_status": "F"}))


def test_hot_user_duplicates_and_late_orders(spark, at):
    """A third of the rows are one user's; the first order is delivered again, and an older
    order of the user comes too late to change it."""
    one = [order(i, 7 if i % 3 == 0 else i, f"2020-01-01 00:{59 - i % 60:02d}:00", i) for i in range(1, 300)]
    first = min((json.loads(r[4]) for r in one if json.loads(r[4])["user_id"] == 7), key=lambda o: (o["create_time"], o["id"]))
    two = [order(first["id"], 7, first["create_time"], 1000), order(first["id"], 7, first["create_time"], 1001),
           order(9001, 7, "2019-01-01 00:00:00", 1002), order(9002, 9999, "2021-01-01 00:00:00", 1003),
           order(9002, 9999, "2021-01-01 00:00:00", 1004)]
    spark.createDataFrame(one, S.MESSAGE).repartition(6).sortWithinPartitions("offset").coalesce(1).write.parquet(at("msgs"))
    time.sleep(1.1)
    put(spark.createDataFrame(two, S.MESSAGE), at("msgs"))
    seen = flag_batches(spark, at, "ck")
    final = seen[0][0][0]
    assert [i for i, u, f in final if u == 7 and f == "1"] == [first["id"]]
    assert sorted((i, f) for i, u, f in seen[1][0][0]) == sorted(
        [(first["id"], "1"), (first["id"], "0"), (9001, "0"), (9002, "1"), (9002, "0")])


def test_task_rows_are_reduced_in_pieces():
    import pyarrow as pa
    rows = pa.table({"user_id": [i % 50 for i in range(1000)], "id": list(range(1000, 0, -1)), "t": [None, "b"] * 500})
    for most in (10, 80, 10_000):
        got = pa.Table.from_batches(state.least_in_task(["user_id"], ["t", "id"], most)(rows.to_batches(max_chunksize=37)))
        best = {}
        for u, i, t in zip(*[got[c].to_pylist() for c in ("user_id", "id", "t")]):
            best[u] = min(best.get(u, (True, "z", 0)), (t is not None, t or "", i))
        want = {}
        for u, i, t in zip(*[rows[c].to_pylist() for c in ("user_id", "id", "t")]):
            want[u] = min(want.get(u, (True, "z", 0)), (t is not None, t or "", i))
        assert best == want
        assert most < 10_000 or got.num_rows == 50


def test_new_checkpoint_on_a_used_folder_keeps_both(spark, at, scratch):
    """Batch ids start at 0 again; nothing is skipped and nothing replaced."""
    M.province_rows(spark, SF_SMALL).write.parquet(at("prov"))
    M.user_rows(spark, SF_SMALL).write.parquet(at("users"))
    for k in (1, 2):
        put(spark.createDataFrame([order(k, k, "2020-01-01 00:00:00", k), ("t", 0, 10 + k, None, "{}")], S.MESSAGE), at(f"m{k}"))
        run(jobs.start_stateful_orders(spark, message_file_stream(spark, at(f"m{k}")), at("out"), at(f"ck{k}"), at("prov"),
                                       at("users"), AVAILABLE_NOW))
    wide = wide_of(spark, at("out"))
    assert sorted(r.id for r in wide.collect()) == [1, 2] and wide.select("query").distinct().count() == 2
    assert jobs.read_batches(spark, at("out", "rejects"), S.REJECT).count() == 2


# --------------------------------------------------------------- devices of a day
def launch(mid, ts, offset):
    return ("t", 0, offset, None, json.dumps({"common": {"mid": mid, "uid": "1", "ar": "2", "ch": "c", "vc": "3"}, "ts": ts}))


def wait_for(q, done, seconds=180):
    """A query with timers never goes idle: poll, bounded."""
    until = time.time() + seconds
    while time.time() < until:
        assert q.exception() is None, q.exception()
        if done():
            return
        time.sleep(0.5)
    raise AssertionError("the stream did not get there in time")


def rows_read(q):
    return sum(p["numInputRows"] for p in q.recentProgress)


def test_day_launches_match_batch(spark, at, scratch):
    path, n = start_log_files(spark, SF_SMALL, scratch)
    put(spark.createDataFrame([("t", 0, 1 << 40, None, "not json")], S.MESSAGE), path)
    q = jobs.start_dau_by_day(spark, message_file_stream(spark, path), at("out"), at("ck"), {"processingTime": "1 second"},
                              rejects=at("bad"))
    try:
        wait_for(q, lambda: q.lastProgress and q.lastProgress["batchId"] > n and q.lastProgress["numInputRows"] == 0)
    finally:
        q.stop()
    got = jobs.read_batches(spark, at("out"), S.DAU_INFO).drop("query", "batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, QUERIES["dau_info"](spark, SF_SMALL).collect()))
    assert [r.value for r in jobs.read_batches(spark, at("bad"), S.REJECT).collect()] == ["not json"]


def test_a_day_expires_as_a_whole(spark, at):
    """Device B is not seen again for longer than the expiry.  While device A keeps the day
    alive, B stays known; once the day had no event for that long, B counts again."""
    ttl = 15_000

    def send(*launches):
        put(spark.createDataFrame([launch(*x) for x in launches], S.MESSAGE), at("msgs"))

    send(("A", DAY, 1), ("B", DAY, 2), ("B", DAY - 1, 3))
    q = jobs.start_dau_by_day(spark, message_file_stream(spark, at("msgs"), 10), at("out"), at("ck"),
                              {"processingTime": "1 second"}, ttl_ms=ttl)
    found = lambda mid: jobs.read_batches(spark, at("out"), S.DAU_INFO).where((F.col("mid") == mid) & (F.col("dt") == "2024-01-01")).count()
    try:
        wait_for(q, lambda: found("A") and found("B"))
        start = time.time()
        i = 10
        while time.time() - start < ttl / 1000 + 8:  # A's events move the expiry of the day
            send(("A", DAY + i, i))
            i += 1
            time.sleep(3)
        read = q.lastProgress["batchId"]
        send(("B", DAY + 999, 999), ("C", DAY, 1000))
        wait_for(q, lambda: found("C"))
        assert found("B") == 1 and found("A") == 1
        time.sleep(ttl / 1000 + 6)  # no event of the day at all
        send(("B", DAY + 5000, 5000))
        wait_for(q, lambda: found("B") == 2)
        assert q.lastProgress["batchId"] > read
    finally:
        q.stop()


# -------------------------------------------------------------- counts of batches
def test_metrics_tell_what_each_batch_read_and_saved(spark, at, scratch):
    """A2, A3, S6 by listener: counts and offsets of each batch as tables."""
    from tideline import apps
    from tideline.streaming import metrics
    path, n, prov, users = _order_setup(spark, scratch, SF_SMALL)
    a = apps.parser().parse_args(["orders", "--out", at("out"), "--provinces", prov, "--users", users, "--bootstrap", "none:0",
                                  "--trigger-seconds", "0"])
    for q in apps.start(a, spark, message_file_stream(spark, path), at("ck")):
        run(q)
    total = spark.read.parquet(path).count()
    saved = metrics.saved(spark, at("out_metrics"))
    assert saved.count() == n and saved.agg(F.sum("rows")).first()[0] == total
    deadline = time.time() + 30
    while metrics.progress(spark, at("out_metrics")).count() < n and time.time() < deadline:
        time.sleep(0.5)  # the listener is told a little later
    rows = metrics.progress(spark, at("out_metrics")).orderBy("batch").collect()
    assert [r.batch for r in rows] == list(range(n)) and sum(r.rows_in for r in rows) >= total
    assert all(r.sources and all(s.end_offset for s in r.sources) for r in rows)
    wide = wide_of(spark, at("out")).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in wide} == {r.batch: r.rows for r in saved.collect()}


def test_watermark_form_reports_rows_before_and_after(spark, at, scratch):
    from tideline import apps
    from tideline.streaming import metrics
    path, n = start_log_files(spark, SF_SMALL, scratch)
    put(spark.createDataFrame([("t", 0, 1 << 40, None, "not json")], S.MESSAGE), path)
    a = apps.parser().parse_args(["dau", "--form", "watermark", "--out", at("out"), "--bootstrap", "none:0", "--trigger-seconds", "0"])
    queries = apps.start(a, spark, message_file_stream(spark, path), at("ck"))
    for q in queries:
        run(q)
    assert [r.value for r in spark.read.schema(S.REJECT).parquet(at("out_rejects")).collect()] == ["not json"]
    named = lambda: [r for r in metrics.progress(spark, at("out_metrics")).collect() if "dau_before" in (r.observed or {})]
    deadline = time.time() + 30
    while len(named()) < n and time.time() < deadline:
        time.sleep(0.5)
    rows = named()
    assert sum(r.observed["dau_before"]["rows"] for r in rows) == spark.read.parquet(path).count() - 1
    assert sum(r.observed["dau_after"]["rows"] for r in rows) == spark.read.schema(S.DAU_INFO).parquet(at("out")).count()


def test_late_rows_are_written_not_dropped(spark, at):
    """In time + late + rejected = what came in; late rows meet the watermark of the
    batches before them, whatever their device."""
    from tideline.streaming import metrics
    batches = [[("m1", DAY + 86400000)], [("m2", DAY + 20 * 86400000), ("m2", DAY + 20 * 86400000 + 5)], [("m9", DAY + 20 * 86400000)],
               [("m5", DAY + 86400000), ("m1", DAY + 86400000 + 7200000), ("m1", DAY + 86400000 + 7200000), ("m9", DAY + 20 * 86400000 + 9)]]
    off = 0
    for rows in batches:
        data = [launch(mid, ts, off + i) for i, (mid, ts) in enumerate(rows)]
        off += len(rows) + 1
        put(spark.createDataFrame([*data, ("t", 0, off - 1, None, "broken")], S.MESSAGE), at("msgs"))
        time.sleep(1.1)  # files are taken by age
    listener = metrics.BatchListener(spark, at("metrics"))
    spark.streams.addListener(listener)
    q = jobs.start_dau_with_late(spark, message_file_stream(spark, at("msgs")), at("out"), at("ck"), at("late"), at("bad"),
                                 trigger={"processingTime": "1 second"})
    listener.open = False
    rows_of = lambda name, schema: jobs.read_batches(spark, at(name), schema)
    counts = lambda: metrics.progress(spark, at("metrics")).where("observed['on_time'] IS NOT NULL").agg(
        F.sum(F.col("observed")["on_time"]["rows"])).first()[0]
    try:
        wait_for(q, lambda: rows_of("late", S.DAU_INFO).count() >= 3 and rows_of("bad", S.REJECT).count() >= 4 and counts() == 5, 300)
    finally:
        q.stop()
        spark.streams.removeListener(listener)
    assert sorted(r.mid for r in rows_of("late", S.DAU_INFO).collect()) == ["m1", "m1", "m5"]
    assert sorted((r.mid, r.dt) for r in rows_of("out", S.DAU_INFO).collect()) == [("m1", "2024-01-02"), ("m2", "2024-01-21"), ("m9", "2024-01-21")]
    assert counts() + rows_of("late", S.DAU_INFO).count() + rows_of("bad", S.REJECT).count() == spark.read.parquet(at("msgs")).count()
