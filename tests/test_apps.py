"""The apps joined up: change capture to topics, topics to the dimension and the
wide orders; rejects; read errors; live parameters."""
import datetime
import os

import pytest
from pyspark.sql import functions as F

from tideline import apps
from tideline.functions import schemas as S
from tideline.operators import cdc, orders, search
from tideline.operators.parse import parse_province, split_valid
from tideline.operators.upsert import keyed_upsert
from tideline.plans import params as P
from tideline.plans.queries import QUERIES
from tideline.sources import messages as M
from tideline.streaming import jobs
from tideline.streaming.io import MESSAGE_COLUMNS, message_file_stream
from tideline.streaming.table import IncrementTable, VersionedTable, current
from conftest import SF_SMALL
from test_streaming import AVAILABLE_NOW, _wide_rows, run


def args(*argv):
    return apps.parser().parse_args([*argv, "--bootstrap", "none:0", "--trigger-seconds", "0"])


def messages_of(spark, path):
    return message_file_stream(spark, path)


def test_capture_to_dimension_to_orders(spark, scratch):
    at = lambda *p: os.path.join(scratch, *p)
    M.cdc_object_messages(spark, SF_SMALL).select(*MESSAGE_COLUMNS).coalesce(2).write.parquet(at("cdc"))
    for q in apps.start(args("cdc", "--out", at("ods")), spark, messages_of(spark, at("cdc")), at("ck_cdc")):
        run(q)
    bad = spark.read.schema(S.REJECT).parquet(at("ods_rejects"))
    n_prov = spark.read.parquet(f"{SF_SMALL}/nation.parquet").count()
    assert bad.count() == n_prov and {r.reason for r in bad.collect()} == {"no data"}

    def topic(name):
        spark.read.parquet(at("ods")).where(F.col("topic") == name).select(*MESSAGE_COLUMNS).coalesce(1).write.parquet(at(name))
        return messages_of(spark, at(name))

    M.user_rows(spark, SF_SMALL, missing_segment=P.MISSING_SEGMENT).write.parquet(at("users"))
    for q in apps.start(args("dim", "--out", at("prov")), spark, topic(M.PROVINCE_TOPIC), at("ck_dim")):
        run(q)
    want = M.province_rows(spark, SF_SMALL).where("id % 4 <> 2")
    assert sorted(current(spark, at("prov"), S.BASE_PROVINCE).collect()) == sorted(want.collect())
    for q in apps.start(args("orders", "--out", at("wide"), "--provinces", at("prov"), "--users", at("users"), "--as-of", P.AS_OF),
                        spark, topic(M.ORDER_TOPIC), at("ck_orders")):
        run(q)
    got = jobs.read_batches(spark, at("wide", "order_wide"), S.ORDER_INFO)
    routed, _ = orders.order_rows(spark.read.parquet(at(M.ORDER_TOPIC)))
    expected = orders.order_wide(routed, want, spark.read.parquet(at("users")), as_of=P.AS_OF)
    assert _wide_rows(got) == _wide_rows(expected) and got.count() == routed.count() > 0
    assert not os.path.exists(at("wide", "rejects"))  # nothing was rejected, nothing is written


def test_three_dimension_batches_then_orders_keep_the_row_count(spark, scratch):
    at = lambda *p: os.path.join(scratch, *p)
    dim = jobs.dim_batch(jobs.dim_table(spark, at("prov")))
    for i in range(3):
        dim(M.province_messages(M.province_rows(spark, SF_SMALL) if i < 2 else M.province_rows_v2(spark, SF_SMALL)), i)
    M.user_rows(spark, SF_SMALL).write.parquet(at("users"))
    M.order_messages(spark, SF_SMALL).coalesce(1).write.parquet(at("msgs"))
    n = spark.read.parquet(at("msgs")).count()
    run(jobs.start_orders(spark, messages_of(spark, at("msgs")), at("out"), at("ck"), at("prov"), at("users"), AVAILABLE_NOW))
    out = IncrementTable(spark, at("out", "order_wide"), S.ORDER_INFO).read()
    assert out.count() == n
    assert out.where("if_first_order = '1'").count() == out.select("user_id").distinct().count()
    assert {r.province_name for r in out.where("province_id IN (SELECT 0)").select("province_name").distinct().collect()} <= {
        r.name for r in current(spark, at("prov"), S.BASE_PROVINCE).collect()}


def test_a_store_that_cannot_be_read_fails(spark, scratch):
    for root in ("nosuchfs://store/table", "hdfs://nowhere.invalid:1/table"):
        with pytest.raises(Exception):
            VersionedTable(spark, root, S.BASE_PROVINCE).read()
        with pytest.raises(Exception):
            IncrementTable(spark, root, S.USER_STATE).read().count()
    assert VersionedTable(spark, os.path.join(scratch, "none"), S.BASE_PROVINCE).read().count() == 0
    assert IncrementTable(spark, os.path.join(scratch, "none"), S.USER_STATE).read(before=3).count() == 0


def test_replay_leaves_a_written_batch_alone(spark, scratch):
    t = IncrementTable(spark, os.path.join(scratch, "t"), S.USER_STATE)
    rows = spark.createDataFrame([("1", "1", 10)], S.USER_STATE)
    t.write(rows, 0)
    files = sorted(os.listdir(os.path.join(scratch, "t", "batch_id=0")))
    t.write(rows, 0)
    assert sorted(os.listdir(os.path.join(scratch, "t", "batch_id=0"))) == files
    v = VersionedTable(spark, os.path.join(scratch, "v"), S.USER_STATE)
    v.commit(rows, 0)
    files = sorted(os.listdir(os.path.join(scratch, "v", "v=0")))
    v.commit(rows, 0)
    assert sorted(os.listdir(os.path.join(scratch, "v", "v=0"))) == files and v.read().count() == 1


def test_compaction_is_not_missed_when_its_batch_is_empty(spark, scratch):
    t = IncrementTable(spark, os.path.join(scratch, "t"), S.USER_STATE)
    t.write(spark.createDataFrame([("1", "1", 10)], S.USER_STATE), 0)
    t.compact_if_due(1, 2, ["user_id"])
    assert t._snapshot_before(None) is None
    t.compact_if_due(3, 2, ["user_id"])  # batch 2 never got there
    assert t._snapshot_before(None) == 3


def test_rejects_of_the_dau_and_dimension_apps(spark, scratch):
    at = lambda *p: os.path.join(scratch, *p)
    M.broken_start_logs(spark, SF_SMALL).select(*MESSAGE_COLUMNS).coalesce(1).write.parquet(at("logs"))
    for q in apps.start(args("dau", "--out", at("dau")), spark, messages_of(spark, at("logs")), at("ck")):
        run(q)
    bad = IncrementTable(spark, at("dau_rejects"), S.REJECT).read()
    want = QUERIES["start_log_rejects"](spark, SF_SMALL)
    assert sorted((r.partition, r.offset, r.reason) for r in bad.collect()) == sorted((r.partition, r.offset, r.reason) for r in want.collect())
    assert bad.where("value IS NULL").count() == 0
    t = jobs.dim_table(spark, at("prov"))
    rej = jobs.rejects_table(spark, at("prov_rejects"))
    msgs = spark.createDataFrame([("t", 0, 0, None, '{"id":"7","name":"a"}'), ("t", 0, 1, None, '{"name":"b"}'), ("t", 0, 2, None, "not json")], S.MESSAGE)
    jobs.dim_batch(t, rej)(msgs, 0)
    assert [r.id for r in t.read().collect()] == [7] and rej.read().count() == 2


def test_print_runs_beside_the_app(spark, scratch):
    """The messages go to the console and the app does its work."""
    at = lambda *p: os.path.join(scratch, *p)
    M.cdc_array_messages(spark, SF_SMALL).select(*MESSAGE_COLUMNS).coalesce(1).write.parquet(at("cdc"))
    queries = apps.start(args("cdc", "--dialect", "array", "--out", at("ods"), "--print"), spark, messages_of(spark, at("cdc")), at("ck"))
    for q in queries:
        run(q)
    printed = queries[-1].lastProgress
    assert "Console" in printed["sink"]["description"] and printed["numInputRows"] == spark.read.parquet(at("cdc")).count()
    assert spark.read.parquet(at("ods")).count() == QUERIES["cdc_route_array"](spark, SF_SMALL).count()


def test_quoted_and_plain_numbers_parse_alike(spark):
    text = '{"id":%s,"user_id":%s,"final_total_amount":%s,"create_time":"2020-01-02 03:04:05"}'
    msgs = spark.createDataFrame([("t", 0, 0, None, text % (1, 2, 3.5)), ("t", 0, 1, None, text % ('"1"', '"2"', '"3.5"')),
                                  ("t", 0, 2, None, text % ('"x"', 2, 1))], S.MESSAGE)
    good, bad = orders.order_rows(msgs)
    assert [(r.id, r.user_id, r.final_total_amount) for r in good.collect()] == [(1, 2, 3.5)] * 2
    assert [(r.offset, r.reason) for r in bad.collect()] == [(2, "no id")]


def test_null_array_elements_are_rejected_and_places_are_told_apart(spark):
    v = '{"table":"order_info","type":"INSERT","data":[{"id":"1"},null,{"id":2}]}'
    good, bad = cdc.route_array(spark.createDataFrame([("t", 3, 5, None, v)], S.MESSAGE))
    assert [(r.key, r.data) for r in good.collect()] == [("1", '{"id":"1"}'), ("2", '{"id":2}')]
    assert good.select("partition", "offset").distinct().count() == 2
    assert [(r.reason, r.value) for r in bad.collect()] == [("null element", v)]


def test_upsert_never_keeps_a_key_twice(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (3, "z")], "id long, name string")
    assert sorted(tuple(r) for r in keyed_upsert(old, new, ["id"]).collect()) == [(1, "a"), (2, "y"), (3, "z")]


def test_ages_follow_the_day(spark):
    users = spark.createDataFrame([(1, "n", "%d-01-01" % (datetime.date.today().year - 25), "F")], S.USER_INFO)
    now = orders.user_attrs(users).first()
    past = orders.user_attrs(users, as_of="%d-06-01" % (datetime.date.today().year - 10)).first()
    assert now.user_age_group != past.user_age_group


def test_search_han_tokens_and_null_scores(spark):
    docs = spark.createDataFrame([(1, "红海行动", 3.0), (2, "看红海行动吧", 2.0), (3, "行人", None), (4, "red sea", 1.0), (5, "redo", 0.5)],
                                 "id long, name string, score double")
    assert [r.id for r in search.term_match_search(docs, "行动").collect()] == [2, 1, 3]
    assert [r.id for r in search.term_match_search(docs, "Red 行").collect()] == [4, 2, 1, 3]


def test_province_message_from_text_numbers(spark):
    msgs = spark.createDataFrame([("t", 0, 0, None, '{"id":"4","name":"n","region_id":1,"area_code":"7"}')], S.MESSAGE)
    good, _ = split_valid(parse_province(msgs))
    assert tuple(good.select("id", "name", "region_id", "area_code").first()) == (4, "n", "1", "7")
