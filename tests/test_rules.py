"""Rule tests on tiny hand-made messages, one per quirk of SURVEY §2.10."""
import json

from pyspark.sql import functions as F

from tideline.functions import schemas as S
from tideline.functions.columns import AGE_GROUP_LABELS, FEMALE_LABEL, MALE_LABEL
from tideline.operators import cdc, dau, offsets, orders, search
from tideline.operators.upsert import keyed_upsert


def msgs(spark, values, topic="t", partition=0, start=0):
    rows = [(topic, partition, start + i, None, v if (v is None or isinstance(v, str)) else json.dumps(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, S.MESSAGE)


def start(mid, ts, ch="c"):
    return {"common": {"mid": mid, "uid": "1", "ar": "2", "ch": ch, "vc": "3"}, "ts": ts}


# ------------------------------------------------------------------ start log
def test_bad_start_logs_are_rejected_not_fatal(spark):
    m = msgs(spark, ["{not json", {"ts": 1}, start(None, 5), start("m1", 1704067200000), None])
    good, bad = dau.start_rows(m)
    assert good.count() == 1 and bad.count() == 4


def test_first_arrival_wins_per_day_and_device(spark):
    day = 1704067200000  # 2024-01-01 00:00 UTC
    m = msgs(spark, [start("m1", day + 5000, "b"), start("m1", day + 1000, "a"),
                     start("m1", day + 1000, "late-offset"), start("m1", day + 86400000, "next-day"),
                     start("m2", day + 7000, "x")])
    out = {(r.dt, r.mid): (r.ch, r.hr, r.mi) for r in dau.dau_info(m).collect()}
    assert out == {("2024-01-01", "m1"): ("a", "00", "00"), ("2024-01-02", "m1"): ("next-day", "00", "00"),
                   ("2024-01-01", "m2"): ("x", "00", "00")}


def test_dau_incremental_drops_seen_keys(spark):
    day = 1704067200000
    seen = spark.createDataFrame([("2024-01-01", "m1")], "dt string, mid string")
    m = msgs(spark, [start("m1", day + 10), start("m2", day + 20)])
    assert [r.mid for r in dau.dau_incremental(m, seen).collect()] == ["m2"]


# --------------------------------------------------------------------- orders
def order(i, user, ct, status="O", province=1):
    return {"id": i, "user_id": user, "province_id": province, "order_status": status,
            "final_total_amount": 10.0, "create_time": ct}


def flags(df):
    return {(r.id, r.offset): r.if_first_order for r in df.collect()}


def test_order_rejects_and_date_parts(spark):
    m = msgs(spark, [order(1, 7, "2020-01-02 13:45:00"), order(2, 7, None), order(3, 7, "2020-01-03"),
                     "garbage"])
    good, bad = orders.order_rows(m)
    got = {r.id: (r.create_date, r.create_hour) for r in good.collect()}
    assert got == {1: ("2020-01-02", "13"), 3: ("2020-01-03", None)}
    assert bad.count() == 2


def test_equal_create_time_tie_breaks_by_id(spark):
    m = msgs(spark, [order(9, 1, "2020-01-01 00:00:00"), order(4, 1, "2020-01-01 00:00:00"),
                     order(5, 1, "2020-01-02 00:00:00")])
    good, _ = orders.order_rows(m)
    f = flags(orders.first_order_flags(good))
    assert f == {(9, 0): "0", (4, 1): "1", (5, 2): "0"}


def test_duplicate_delivery_keeps_one_first(spark):
    m = msgs(spark, [order(1, 1, "2020-01-01 00:00:00"), order(1, 1, "2020-01-01 00:00:00")])
    good, _ = orders.order_rows(m)
    assert sorted(flags(orders.first_order_flags(good)).values()) == ["0", "1"]


def _empty_state(spark):
    return spark.createDataFrame([], S.USER_STATE)


def test_earlier_order_in_later_batch_is_not_first(spark):
    b1, _ = orders.order_rows(msgs(spark, [order(2, 1, "2020-02-01 00:00:00")]))
    f1 = orders.first_order_flags(b1, _empty_state(spark))
    state = orders.upsert_state(_empty_state(spark), f1)
    b2, _ = orders.order_rows(msgs(spark, [order(1, 1, "2020-01-01 00:00:00")], start=10))
    assert flags(f1) == {(2, 0): "1"}
    assert flags(orders.first_order_flags(b2, state)) == {(1, 10): "0"}


def test_replayed_batch_keeps_its_first_order(spark):
    b, _ = orders.order_rows(msgs(spark, [order(1, 1, "2020-01-01 00:00:00"),
                                          order(2, 1, "2020-01-02 00:00:00"),
                                          order(3, 2, "2020-01-01 00:00:00")]))
    f1 = flags(orders.first_order_flags(b, _empty_state(spark)))
    state = orders.upsert_state(_empty_state(spark), orders.first_order_flags(b, _empty_state(spark)))
    f2 = flags(orders.first_order_flags(b, state))  # same batch after the state write
    assert f1 == f2 == {(1, 0): "1", (2, 1): "0", (3, 2): "1"}


def test_not_consumed_state_counts_as_new(spark):
    state = spark.createDataFrame([("1", "0", None), ("2", "1", 99)], S.USER_STATE)
    b, _ = orders.order_rows(msgs(spark, [order(1, 1, "2020-01-01 00:00:00"), order(2, 2, "2020-01-01 00:00:00")]))
    assert flags(orders.first_order_flags(b, state)) == {(1, 0): "1", (2, 1): "0"}
    assert flags(orders.state_flag(b, state)) == {(1, 0): "1", (2, 1): "0"}


def test_exactly_one_first_per_user(spark):
    from tideline.plans.queries import QUERIES
    df = QUERIES["order_first_flag"](spark, "/root/testdata/sf0.001")
    per_user = df.groupBy("user_id").agg(F.sum((F.col("if_first_order") == "1").cast("int")).alias("n"))
    assert per_user.where("n <> 1").count() == 0


# ----------------------------------------------------------------- enrichment
def test_age_groups_and_gender_labels(spark):
    users = spark.createDataFrame([
        (1, "a", "2003-01-30", "F"),   # 21 on 2024-01-30
        (2, "b", "2003-01-31", "M"),   # 20 (birthday tomorrow)
        (3, "c", "1993-01-30", None),  # 31
        (4, "d", "1993-01-31", "X"),   # 30
        (5, "e", None, "F"),           # no age
    ], S.USER_INFO)
    o = spark.createDataFrame([(i, i) for i in range(1, 7)], "id long, user_id long")
    std = {r.id: (r.user_gender, r.user_age_group)
           for r in orders.enrich_user(o, users, "2024-01-30").collect()}
    a20, a21_30, a30 = AGE_GROUP_LABELS
    assert std == {1: (FEMALE_LABEL, a21_30), 2: (MALE_LABEL, a20), 3: (None, a30), 4: (None, a21_30),
                   5: (FEMALE_LABEL, None), 6: (None, None)}
    sw = {r.id: r.user_gender for r in orders.enrich_user(o, users, "2024-01-30", "swapped").collect()}
    assert sw == {1: MALE_LABEL, 2: FEMALE_LABEL, 3: FEMALE_LABEL, 4: FEMALE_LABEL, 5: MALE_LABEL, 6: None}


def test_enrichment_keeps_row_count_and_unknown_province(spark):
    prov = spark.createDataFrame([(1, "P1", "0", "101")], S.BASE_PROVINCE)
    o = spark.createDataFrame([(1, 1), (2, 7), (3, None)], "id long, province_id long")
    out = {r.id: r.province_name for r in orders.enrich_province(o, prov).collect()}
    assert out == {1: "P1", 2: None, 3: None}


# ------------------------------------------------------------------------ CDC
def env(table, typ, data):
    return {"table": table, "type": typ, "data": data}


def test_object_dialect_filters(spark):
    m = msgs(spark, [
        env("order_info", "insert", {"id": 1}),
        env("order_info", "bootstrap-insert", {"id": 2}),      # dropped (Q10)
        env("order_info", "update", {"id": 3}),                # dropped
        env("base_province", "bootstrap-insert", {"id": 4}),   # kept
        env("base_province", "delete", {"id": 5}),             # dropped
        env("ORDER_INFO", "insert", {"id": 6}),                # case-sensitive: dropped
        env("not_listed", "insert", {"id": 7}),                # dropped
        env("user_info", "insert", {}),                        # empty: dropped
        env("user_info", "insert", None),                      # null: reject (Q8)
        env("user_info", None, {"id": 8}),                     # null type: reject
        "{{{",                                                 # malformed: reject
    ])
    routed, rejects = cdc.route_object(m)
    got = sorted((r.topic, r.key) for r in routed.collect())
    assert got == [("ODS_T_BASE_PROVINCE", "4"), ("ODS_T_ORDER_INFO", "1")]
    assert rejects.count() == 3
    vals = [json.loads(r.value) for r in cdc.to_topic_messages(routed).collect()]
    assert sorted(v["id"] for v in vals) == [1, 4]  # the payload keeps its types


def test_array_dialect_forwards_everything(spark):
    m = msgs(spark, [
        env("order_info", "DELETE", [{"id": 1}, {"id": 2}]),
        env("Order_Info", "INSERT", [{"id": 3}]),
        env("order_info", "INSERT", []),
        env("order_info", "INSERT", None),
    ])
    routed, rejects = cdc.route_array(m)
    got = sorted((r.topic, r.key, r.op_type) for r in routed.collect())
    assert got == [("ODS_T_ORDER_INFO", "1", "DELETE"), ("ODS_T_ORDER_INFO", "2", "DELETE"),
                   ("ODS_T_ORDER_INFO", "3", "INSERT")]
    assert rejects.count() == 1


# --------------------------------------------------------------------- upsert
def test_upsert_twice_equals_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    upd = spark.createDataFrame([(2, "B"), (3, "c")], "id long, v string")
    once = keyed_upsert(base, upd, ["id"])
    twice = keyed_upsert(once, upd, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_last_in_batch_wins(spark):
    base = spark.createDataFrame([(1, "a", 0)], "id long, v string, o long")
    upd = spark.createDataFrame([(1, "x", 5), (1, "y", 9)], "id long, v string, o long")
    assert keyed_upsert(base, upd, ["id"], order=["o"]).collect()[0].v == "y"


# -------------------------------------------------------------------- offsets
def test_ledger_never_moves_backwards_and_resume(spark):
    m = spark.createDataFrame([("t", 0, o, None, "x", b) for o, b in [(0, 1), (1, 1), (2, 2)]] +
                              [("t", 1, 5, None, "x", 1)],
                              "topic string, partition int, offset long, key string, value string, batch_id int")
    ranges = offsets.offset_ranges(m)
    led = offsets.ledger_after(ranges, "g")
    assert sorted((r.partition, r.until_offset) for r in led.collect()) == [(0, 3), (1, 6)]
    older = spark.createDataFrame([("g", "t", 0, 10)], S.OFFSET_LEDGER)
    led2 = offsets.ledger_after(ranges, "g", existing=older)
    assert sorted((r.partition, r.until_offset) for r in led2.collect()) == [(0, 10), (1, 6)]
    more = m.unionByName(spark.createDataFrame([("t", 0, 3, None, "x", 3), ("t", 2, 0, None, "x", 3)],
                                               m.schema))
    rest = offsets.resume_rows(more, led, "g")
    assert sorted((r.partition, r.offset) for r in rest.collect()) == [(0, 3), (2, 0)]
    rest_latest = offsets.resume_rows(more, led, "g", missing="latest")
    assert sorted((r.partition, r.offset) for r in rest_latest.collect()) == [(0, 3)]
    assert json.loads(offsets.kafka_starting_offsets(led.collect())) == {"t": {"0": 3, "1": 6}}


# --------------------------------------------------------------------- search
def test_term_match_is_whole_word_and_ordered(spark):
    docs = spark.createDataFrame([(1, "The Red sea", 5.0), (2, "redsea only", 1.0), (3, "red, again", 2.0),
                                  (4, "nothing", 0.0), (5, "SEA", 2.0)], "id long, name string, score double")
    got = [r.id for r in search.term_match_search(docs, "red sea", limit=10).collect()]
    assert got == [3, 5, 1]
    assert [r.id for r in search.term_match_search(docs, "red sea", limit=2).collect()] == [3, 5]


def test_nested_match_on_array_and_flat_forms(spark):
    convs = spark.createDataFrame([(1, [("user", "hello world")]), (2, [("user", "x"), ("bot", "a WORLD!")]),
                                   (3, [("user", "worldly")])],
                                  "conv_id long, turns array<struct<role:string,text:string>>")
    hits = [r.conv_id for r in convs.where(search.nested_match("turns", "text", "world")).collect()]
    assert sorted(hits) == [1, 2]
    flat = convs.select("conv_id", F.inline("turns"))
    got = {r.conv_id: (r.n_turns, r.n_matching) for r in search.nested_match_search(flat, "world").collect()}
    assert got == {1: (1, 1), 2: (2, 1)}


def test_array_dialect_with_object_rules(spark):
    m = msgs(spark, [
        env("order_info", "DELETE", [{"id": 1}]),
        env("order_info", "INSERT", [{"id": 2}, {}]),
        env("order_info", "UPDATE", [{"id": 3}]),
        env("base_province", "UPDATE", [{"id": 4}]),
    ])
    routed, _ = cdc.route_array(m, filter_like_object=True)
    assert sorted((r.topic, r.key) for r in routed.collect()) == [("ODS_T_BASE_PROVINCE", "4"),
                                                                   ("ODS_T_ORDER_INFO", "2")]


def test_empty_batches_write_nothing(spark, tmp_path):
    from tideline.streaming import jobs
    from tideline.streaming.table import IncrementTable
    empty = spark.createDataFrame([], S.MESSAGE)
    state = IncrementTable(spark, str(tmp_path / "st"), S.USER_STATE)
    out = IncrementTable(spark, str(tmp_path / "out"), S.ORDER_INFO)
    jobs.order_batch(spark, state, out, lambda: None, lambda: None)(empty, 0)
    assert out.read().count() == 0 and not (tmp_path / "out").exists()
    jobs.dim_batch(jobs.dim_table(spark, str(tmp_path / "dim")))(empty, 0)
    assert not (tmp_path / "dim").exists()
    dau_tbl = IncrementTable(spark, str(tmp_path / "dau"), S.DAU_INFO, partition_by=["dt"])
    jobs.dau_exact_batch(spark, dau_tbl)(msgs(spark, ["{bad"]), 0)
    assert not (tmp_path / "dau").exists()
