"""Registered batch queries: one per operator family of SURVEY §2.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
tables.  Column names equal those of the DuckDB oracle in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import schemas as S
from tideline.operators import cdc, dau, offsets, orders, search
from tideline.operators.parse import parse_province, parse_start_log, split_valid
from tideline.operators.upsert import keyed_upsert
from tideline.plans import params as P
from tideline.session import keep, prepare, scratch_path
from tideline.sources import messages as M
from tideline.sources.tables import read_table, spread

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ start log
def q_start_log_parse(spark, sf):
    prepare(spark)
    good, _ = split_valid(parse_start_log(M.start_log_messages(spark, sf)))
    return good.select("topic", "partition", "offset", "mid", "uid", "ar", "ch", "vc", "ts")


def q_dau_info(spark, sf):
    prepare(spark)
    return dau.dau_info(M.start_log_messages(spark, sf))


def q_dau_incremental(spark, sf):
    prepare(spark)
    cut = F.lit(P.DAU_SEEN_CUT).cast("timestamp_ntz")
    seen = dau.dau_seen_keys(M.start_log_messages(spark, sf, where=F.col("ts") < cut))
    batch = M.start_log_messages(spark, sf, where=F.col("ts") >= cut)
    return dau.dau_incremental(batch, seen)


def q_dau_index_by_run_date(spark, sf):
    prepare(spark)
    return dau.dau_index_by_run_date(M.start_log_messages(spark, sf))


def q_dau_upsert(spark, sf):
    prepare(spark)
    b1 = M.start_log_messages(spark, sf, where=F.col("ts") < F.lit(P.DAU_BATCH1_END).cast("timestamp_ntz"))
    b2 = M.start_log_messages(spark, sf, where=F.col("ts") >= F.lit(P.DAU_BATCH2_START).cast("timestamp_ntz"))
    first = dau.dau_info(b1)
    return dau.dau_upsert(first, b2)


def q_dau_filter_counts(spark, sf):
    prepare(spark)
    return dau.dau_filter_counts(M.start_log_messages(spark, sf))


# ------------------------------------------------------------------------ CDC
PAYLOAD_FIELDS = ("id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, final_total_amount DOUBLE, "
                  "benefit_reduce_amount DOUBLE, original_total_amount DOUBLE, feight_fee DOUBLE, expire_time STRING, "
                  "create_time STRING, operate_time STRING, name STRING, region_id STRING, area_code STRING, birthday STRING, "
                  "gender STRING, order_id BIGINT, sku_id BIGINT, sku_num DOUBLE, order_price DOUBLE, category STRING, price DOUBLE")


def _route_out(routed: DataFrame) -> DataFrame:
    """The routed messages with every field of their value, by its JSON type."""
    return routed.select("topic", "key", "op_type", F.col("data").alias("value")).select("topic", "key", "op_type", F.size(F.json_object_keys("value")).alias("n_fields"),
                       F.inline(F.array(F.from_json("value", PAYLOAD_FIELDS))))


def q_cdc_route_object(spark, sf):
    prepare(spark)
    routed, _ = cdc.route_object(M.cdc_object_messages(spark, sf))
    return _route_out(routed)


def q_cdc_route_array(spark, sf):
    prepare(spark)
    routed, _ = cdc.route_array(M.cdc_array_messages(spark, sf))
    return _route_out(routed)


def q_cdc_rejects(spark, sf):
    prepare(spark)
    _, one = cdc.route_object(M.cdc_object_messages(spark, sf))
    _, two = cdc.route_array(M.cdc_array_messages(spark, sf))
    return one.unionByName(two)


def q_start_log_rejects(spark, sf):
    prepare(spark)
    _, bad = split_valid(parse_start_log(M.broken_start_logs(spark, sf)))
    return bad.select("topic", "partition", "offset", "reason", F.length("value").alias("value_chars"))


def q_order_rejects(spark, sf):
    prepare(spark)
    _, bad = orders.order_rows(M.broken_orders(spark, sf))
    return bad.select("topic", "partition", "offset", "reason", F.get_json_object("value", "$.id").alias("id"))


def _routed(spark, sf, topic):
    """What a consumer of one per-table topic reads after the CDC router."""
    routed, _ = cdc.route_object(M.cdc_object_messages(spark, sf))
    return cdc.to_topic_messages(routed).where(F.col("topic") == topic)


def q_cdc_order_chain(spark, sf):
    """Captured order rows, routed, parsed and widened."""
    prepare(spark)
    good, _ = orders.order_rows(_routed(spark, sf, M.ORDER_TOPIC))
    return orders.order_wide(keep(good), _provinces(spark, sf), _users(spark, sf), as_of=P.AS_OF)


def q_cdc_province_chain(spark, sf):
    """Captured province rows, routed, parsed and upserted."""
    prepare(spark)
    good, _ = split_valid(parse_province(_routed(spark, sf, M.PROVINCE_TOPIC)))
    return keyed_upsert(M.province_rows_v2(spark, sf), good, ["id"], order=["offset"])


# --------------------------------------------------------------------- orders
ORDER_SOURCE_OUT = [n for n, _ in S.ORDER_SOURCE_FIELDS]


def _orders(spark, sf, midnight=False, since=None, before=None, kept=True):
    """Typed orders, parsed once: ``kept`` for queries that read them twice."""
    rows = M.order_info_rows(spark, sf, midnight, created_since=since, created_before=before)
    good, _ = orders.order_rows(M.order_messages(spark, sf, rows=rows))
    return keep(good) if kept else good


def _after_cut(spark, sf):
    return _orders(spark, sf, since=P.STATE_CUT)


def _seed(spark, sf):
    """The user state as stored before the batch: kept, like the state table that
    a stream job reads."""
    return keep(M.user_state_seed(spark, sf, P.STATE_CUT))


def q_order_parse(spark, sf):
    prepare(spark)
    return _orders(spark, sf, kept=False).select(*ORDER_SOURCE_OUT, "create_date", "create_hour")


def q_state_lookup(spark, sf):
    prepare(spark)
    return orders.state_lookup(_seed(spark, sf), _after_cut(spark, sf))


def q_order_state_flag(spark, sf):
    prepare(spark)
    o = _after_cut(spark, sf)
    return orders.state_flag(o, _seed(spark, sf)).select(
        "id", "user_id", "if_first_order")


def q_first_order_in_batch(spark, sf):
    prepare(spark)
    o = _after_cut(spark, sf)
    return orders.first_order_flags(o, _seed(spark, sf)).select(
        "id", "user_id", "create_time", "if_first_order")


def q_order_first_flag(spark, sf):
    prepare(spark)
    o = _orders(spark, sf, midnight=True)
    return orders.first_order_flags(o).select("id", "user_id", "create_time", "if_first_order")


def q_order_first_two_batches(spark, sf):
    prepare(spark)
    b1 = _orders(spark, sf, before=P.STATE_CUT)
    b2 = _after_cut(spark, sf)
    f1 = keep(orders.first_order_flags(b1))  # batch 1 feeds batch 2's state
    state1 = orders.state_updates(f1)
    f2 = orders.first_order_flags(b2, state1)
    cols = ["id", "user_id", "if_first_order"]
    return (f1.select(F.lit(1).alias("batch"), *cols)
              .unionByName(f2.select(F.lit(2).alias("batch"), *cols)))


def q_user_state(spark, sf):
    prepare(spark)
    seed = _seed(spark, sf)
    flagged = orders.first_order_flags(_after_cut(spark, sf), seed)
    return orders.upsert_state(seed, flagged)


# ----------------------------------------------------------------- dimensions
def q_dim_scan(spark, sf):
    prepare(spark)
    return M.province_rows(spark, sf)


def q_dim_upsert(spark, sf):
    prepare(spark)
    existing = M.province_rows(spark, sf, missing_region=P.MISSING_REGION)
    loaded_late = M.province_rows(spark, sf).where(F.col("region_id") == str(P.MISSING_REGION))
    changes = M.province_rows_v2(spark, sf).unionByName(loaded_late)
    good, _ = split_valid(parse_province(M.province_messages(changes.unionByName(changes))))  # delivered twice
    return keyed_upsert(existing, good, ["id"], order=["offset"])


def q_user_dim_upsert(spark, sf):
    prepare(spark)
    existing = M.user_rows(spark, sf, missing_segment=P.MISSING_SEGMENT)
    cu = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    everyone = M.user_rows(spark, sf)
    seg = everyone.join(cu, everyone.id == cu.c_custkey)
    renamed = (seg.where(F.col("c_mktsegment") == P.CHANGED_SEGMENT)
                  .select("id", F.concat(F.upper("name"), F.lit(" (renamed)")).alias("name"),
                          "birthday", "gender"))
    inserted = seg.where(F.col("c_mktsegment") == P.MISSING_SEGMENT).select("id", "name", "birthday", "gender")
    changes = renamed.unionByName(inserted)
    return keyed_upsert(existing, changes.unionByName(changes), ["id"])  # delivered twice


def q_keyed_upsert(spark, sf):
    prepare(spark)
    v1 = M.order_info_rows(spark, sf)
    changed = (v1.where(F.col("order_status") == P.UPDATED_STATUS)
                 .withColumn("order_status", F.lit(P.NEW_STATUS))
                 .withColumn("operate_time", F.date_format(
                     F.to_timestamp("create_time") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")))
    v2, _ = orders.order_rows(M.order_messages(spark, sf, rows=changed))
    return keyed_upsert(v1, v2, ["id"], order=["offset"])


# ----------------------------------------------------------------- enrichment
def _provinces(spark, sf):
    return M.province_rows(spark, sf, missing_region=P.MISSING_REGION)


def _users(spark, sf):
    return M.user_rows(spark, sf, missing_segment=P.MISSING_SEGMENT)


def q_order_province_enrich(spark, sf):
    prepare(spark)
    o = orders.enrich_province(_orders(spark, sf, kept=False), _provinces(spark, sf))
    return o.select("id", "province_id", "province_name", "province_area_code")


def q_order_user_enrich(spark, sf):
    prepare(spark)
    o = orders.enrich_user(_orders(spark, sf, kept=False), _users(spark, sf), P.AS_OF)
    return o.select("id", "user_id", "user_gender", "user_age_group")


def q_order_user_enrich_swapped(spark, sf):
    prepare(spark)
    o = orders.enrich_user(_orders(spark, sf, kept=False), _users(spark, sf), P.AS_OF, gender_rule="swapped")
    return o.select("id", "user_id", "user_gender", "user_age_group")


def _wide(spark, sf, state=None):
    return orders.order_wide(_orders(spark, sf), _provinces(spark, sf), _users(spark, sf),
                             state=state, as_of=P.AS_OF)


def q_order_wide(spark, sf):
    prepare(spark)
    return _wide(spark, sf)


def q_dw_order_messages(spark, sf):
    prepare(spark)
    msgs = orders.wide_order_messages(_wide(spark, sf), M.WIDE_ORDER_TOPIC)
    v = F.inline(F.array(F.from_json("value", S.ORDER_INFO)))
    return msgs.select("topic", "key", v).select("topic", "key", *S.ORDER_INFO_COLUMNS)


def q_order_wide_repeated_dims(spark, sf):
    """Dimensions that hold a key more than once do not multiply orders."""
    prepare(spark)
    prov = _provinces(spark, sf).unionByName(M.province_rows_v2(spark, sf)).unionByName(_provinces(spark, sf))
    users = _users(spark, sf).unionByName(_users(spark, sf).withColumn("birthday", F.lit("2010-06-30")))
    return orders.order_wide(_orders(spark, sf), prov, users, as_of=P.AS_OF)


def q_order_upsert(spark, sf):
    prepare(spark)
    wide1 = keep(_wide(spark, sf))  # batch 1 feeds batch 2's state
    state1 = orders.state_updates(wide1)
    rows = M.order_info_rows(spark, sf)
    changed = (rows.where(F.col("order_status") == P.UPDATED_STATUS)
                   .withColumn("order_status", F.lit(P.NEW_STATUS)))
    again = M.order_messages(spark, sf, rows=changed)
    o2, _ = orders.order_rows(again.unionByName(again.withColumn("offset", F.col("offset") + (1 << 40))))  # delivered twice
    wide2 = orders.order_wide(keep(o2), _provinces(spark, sf), _users(spark, sf), state=state1, as_of=P.AS_OF)
    return keyed_upsert(wide1, wide2, ["id"], order=["if_first_order"])


# -------------------------------------------------------------------- offsets
def _ranges(spark, sf):
    return offsets.offset_ranges(M.start_log_messages(spark, sf, with_batch=True))


def _ledger(spark, sf):
    cut_day = F.datediff(F.lit(P.LEDGER_CUT_DAY).cast("date"), F.lit("1970-01-01").cast("date"))
    r = _ranges(spark, sf).where(F.col("batch_id") <= cut_day)
    return offsets.ledger_after(r, P.CONSUMER_GROUP)


def q_offset_ranges(spark, sf):
    prepare(spark)
    return _ranges(spark, sf)


def q_offset_ledger(spark, sf):
    prepare(spark)
    return _ledger(spark, sf)


def q_offset_resume(spark, sf):
    prepare(spark)
    msgs = M.start_log_messages(spark, sf)
    return offsets.resume_rows(msgs, _ledger(spark, sf), P.CONSUMER_GROUP).select(
        "topic", "partition", "offset")


# --------------------------------------------------------------------- search
def _searched(spark, sf):
    return spread(read_table(spark, sf, "documents", ["doc_id", "text", "n_chars"]), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("name"), F.col("n_chars").alias("score"))


def q_term_match_postings(spark, sf):
    """The same search over a postings table, which is built here first."""
    prepare(spark)
    path = scratch_path(spark, f"postings-{uuid.uuid4().hex}")
    search.write_postings(search.token_postings(_searched(spark, sf)), path)
    return search.postings_search(spark.read.parquet(path), P.DOC_QUERY, limit=P.SEARCH_LIMIT)


def q_term_match_search(spark, sf):
    prepare(spark)
    docs = _searched(spark, sf)
    return search.term_match_search(docs, P.DOC_QUERY, limit=P.SEARCH_LIMIT).select("id", "score")


def q_nested_match_search(spark, sf):
    prepare(spark)
    turns = spread(read_table(spark, sf, "conversations", ["conv_id", "text"]), "conv_id")
    return search.nested_match_search(turns, P.CONV_QUERY)


QUERIES: dict[str, Query] = {
    "start_log_parse": q_start_log_parse,
    "dau_info": q_dau_info,
    "dau_incremental": q_dau_incremental,
    "dau_index_by_run_date": q_dau_index_by_run_date,
    "dau_upsert": q_dau_upsert,
    "dau_filter_counts": q_dau_filter_counts,
    "cdc_route_object": q_cdc_route_object,
    "cdc_route_array": q_cdc_route_array,
    "cdc_rejects": q_cdc_rejects,
    "start_log_rejects": q_start_log_rejects,
    "order_rejects": q_order_rejects,
    "cdc_order_chain": q_cdc_order_chain,
    "cdc_province_chain": q_cdc_province_chain,
    "order_parse": q_order_parse,
    "state_lookup": q_state_lookup,
    "order_state_flag": q_order_state_flag,
    "first_order_in_batch": q_first_order_in_batch,
    "order_first_flag": q_order_first_flag,
    "order_first_two_batches": q_order_first_two_batches,
    "user_state": q_user_state,
    "dim_scan": q_dim_scan,
    "dim_upsert": q_dim_upsert,
    "user_dim_upsert": q_user_dim_upsert,
    "keyed_upsert": q_keyed_upsert,
    "order_province_enrich": q_order_province_enrich,
    "order_user_enrich": q_order_user_enrich,
    "order_user_enrich_swapped": q_order_user_enrich_swapped,
    "order_wide": q_order_wide,
    "order_wide_repeated_dims": q_order_wide_repeated_dims,
    "dw_order_messages": q_dw_order_messages,
    "order_upsert": q_order_upsert,
    "offset_ranges": q_offset_ranges,
    "offset_ledger": q_offset_ledger,
    "offset_resume": q_offset_resume,
    "term_match_search": q_term_match_search,
    "term_match_postings": q_term_match_postings,
    "nested_match_search": q_nested_match_search,
}
