"""Topic-shaped inputs derived from the warehouse tables (FIXTURES.md).

Each function returns a DataFrame with the columns of a decoded topic message
(``topic, partition, offset, key, value``) or a typed view used to build one.
They are plain projections/joins of the parquet tables, so their work grows
with the tables, and the same frames feed the batch queries and the file-based
stream tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.columns import epoch_millis
from tideline.sources.tables import read_table, spread

# Topic names (deployment settings; the per-table topics follow the routing
# rule "ODS_T_" + TABLE, so those two must stay as they are).
START_TOPIC = "START_LOG"
ORDER_TOPIC = "ODS_T_ORDER_INFO"
PROVINCE_TOPIC = "ODS_T_BASE_PROVINCE"
CDC_OBJECT_TOPIC = "ODS_DB_OBJECT"
CDC_ARRAY_TOPIC = "ODS_DB_ARRAY"
WIDE_ORDER_TOPIC = "DW_ORDER_INFO"
# ---------------------------------------------------------------------------
# CDC operation types of the two capture dialects.
OBJECT_TYPES = ("insert", "update", "delete", "bootstrap-insert")
ARRAY_TYPES = ("INSERT", "UPDATE", "DELETE")
# ---------------------------------------------------------------------------

# Partitions of the synthetic topics; partition = key % N, offset = key div N.
TOPIC_PARTITIONS = 4
# Upper bound of rows packed into one array-dialect message.
ARRAY_CHUNK_KEYS = 1024
DEFAULT_STATE_CUT = "1998-01-01 00:00:00"


def _coords(key: str):
    k = F.col(key)
    return [(k % TOPIC_PARTITIONS).cast("int").alias("partition"),
            F.expr(f"`{key}` div {TOPIC_PARTITIONS}").alias("offset")]


def _pick(values, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


# ----------------------------------------------------------------- start log
def start_log_messages(spark: SparkSession, sf_dir: str, where=None,
                       with_batch: bool = False) -> DataFrame:
    """Start-log messages built from ``events`` (one per event).

    ``where``: predicate on the events table (pushed into the scan) selecting
    the time range a batch covers.  ``with_batch`` adds ``batch_id`` = the
    event day number, one micro-batch per day.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    if where is not None:
        ev = ev.where(where)
    ev = spread(ev, "event_id")
    uid = F.col("user_id").cast("string")
    common = F.struct(
        F.concat(F.lit("mid_"), uid).alias("mid"),
        uid.alias("uid"),
        (F.col("user_id") % 25).cast("string").alias("ar"),
        F.col("event_type").alias("ch"),
        F.get_json_object("props", "$.k").alias("vc"),
    )
    value = F.to_json(F.struct(common.alias("common"), epoch_millis("ts").alias("ts")))
    extra = [F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("batch_id")] \
        if with_batch else []
    return ev.select(F.lit(START_TOPIC).alias("topic"), *_coords("event_id"),
                     F.lit(None).cast("string").alias("key"), value.alias("value"), *extra)


def broken_start_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start-log messages of which some event types are damaged: ``error`` is cut off,
    ``signup`` has no device, ``purchase`` no time."""
    ev = spread(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]), "event_id")
    mid = F.when(F.col("event_type") != "signup", F.concat(F.lit("mid_"), F.col("user_id").cast("string")))
    ts = F.when(F.col("event_type") != "purchase", epoch_millis("ts"))
    value = F.to_json(F.struct(F.struct(mid.alias("mid"), F.col("event_type").alias("ch")).alias("common"), ts.alias("ts")))
    value = F.when(F.col("event_type") == "error", F.substring(value, 1, 12)).otherwise(value)
    return ev.select(F.lit(START_TOPIC).alias("topic"), *_coords("event_id"),
                     F.lit(None).cast("string").alias("key"), value.alias("value"))


# -------------------------------------------------------------------- orders
def order_info_rows(spark: SparkSession, sf_dir: str, midnight: bool = False,
                    created_since: str | None = None, created_before: str | None = None) -> DataFrame:
    """Source part of OrderInfo from ``orders`` left join ``customer``.

    ``create_time`` spreads orders over the day from the key (``midnight=True``
    keeps the table's midnight times so equal create times occur).
    ``created_since`` / ``created_before`` keep orders created in that range;
    a create time lies within one day after ``o_orderdate``, so a widened
    bound on ``o_orderdate`` reaches the parquet reader as a pushed filter.
    """
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    if created_since is not None:
        o = o.where(F.col("o_orderdate") > F.lit(created_since).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    if created_before is not None:
        o = o.where(F.col("o_orderdate") < F.lit(created_before).cast("timestamp_ntz"))
    o = spread(o, "o_orderkey")
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    j = o.join(cu, o.o_custkey == cu.c_custkey, "left")
    if midnight:
        ct = F.col("o_orderdate")
    else:
        ct = F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), ((F.col("o_orderkey") * 7919) % 86400).cast("decimal(18,6)"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    out = j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        F.lit(0.0).alias("benefit_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        F.lit(0.0).alias("feight_fee"),
        F.date_format(ct + F.expr("INTERVAL 15 MINUTES"), fmt).alias("expire_time"),
        F.date_format(ct, fmt).alias("create_time"),
        F.date_format(ct, fmt).alias("operate_time"),
    )
    if created_since is not None:
        out = out.where(F.col("create_time") >= created_since)
    if created_before is not None:
        out = out.where(F.col("create_time") < created_before)
    return out


ORDER_PAYLOAD = ["id", "province_id", "order_status", "user_id", "final_total_amount",
                 "benefit_reduce_amount", "original_total_amount", "feight_fee",
                 "expire_time", "create_time", "operate_time"]


def order_messages(spark: SparkSession, sf_dir: str, midnight: bool = False,
                   rows: DataFrame | None = None) -> DataFrame:
    """Order-topic messages: key = order id, value = JSON of the order."""
    r = rows if rows is not None else order_info_rows(spark, sf_dir, midnight)
    return r.select(F.lit(ORDER_TOPIC).alias("topic"), *_coords("id"),
                    F.col("id").cast("string").alias("key"),
                    F.to_json(F.struct(*ORDER_PAYLOAD)).alias("value"))


def broken_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages of which some states are damaged: ``P`` has no create time,
    ``O`` no user."""
    r = order_info_rows(spark, sf_dir)
    r = r.withColumn("create_time", F.when(F.col("order_status") != "P", F.col("create_time"))) \
         .withColumn("user_id", F.when(F.col("order_status") != "O", F.col("user_id")))
    return order_messages(spark, sf_dir, rows=r)


# ---------------------------------------------------------------- dimensions
def province_rows(spark: SparkSession, sf_dir: str, missing_region: int | None = None) -> DataFrame:
    """base_province from ``nation``.  ``missing_region`` leaves that region's
    provinces out of the dimension (orders then meet an unknown province)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    if missing_region is not None:
        n = n.where(F.col("n_regionkey") != missing_region)
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        (F.col("n_nationkey") + 100).cast("string").alias("area_code"),
    )


def province_rows_v2(spark: SparkSession, sf_dir: str, changed_regions=(0, 2)) -> DataFrame:
    """Changed province rows (renamed, new area code) for the upsert tests."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    n = n.where(F.col("n_regionkey").isin(*changed_regions))
    return n.select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.concat(F.lower("n_name"), F.lit(" v2")).alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        (F.col("n_nationkey") + 200).cast("string").alias("area_code"),
    )


def province_messages(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit(PROVINCE_TOPIC).alias("topic"), *_coords("id"),
                       F.col("id").cast("string").alias("key"),
                       F.to_json(F.struct("id", "name", "region_id", "area_code")).alias("value"))


def user_rows(spark: SparkSession, sf_dir: str, missing_segment: str | None = None) -> DataFrame:
    """user_info from ``customer``: birthday spread over ~68 years, gender
    F / M / unknown.  ``missing_segment`` leaves that market segment's users out
    of the dimension (orders then meet an unknown user)."""
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    if missing_segment is not None:
        cu = cu.where(F.col("c_mktsegment") != missing_segment)
    k = F.col("c_custkey")
    birthday = F.date_add(F.lit("1950-01-01").cast("date"), ((k * 37) % 25000).cast("int"))
    gender = F.when(k % 3 == 0, "F").when(k % 3 == 1, "M")
    return cu.select(k.alias("id"), F.col("c_name").alias("name"),
                     F.date_format(birthday, "yyyy-MM-dd").alias("birthday"), gender.alias("gender"))


def user_state_seed(spark: SparkSession, sf_dir: str, cut: str = DEFAULT_STATE_CUT) -> DataFrame:
    """User state as left by processing every order created before ``cut``.

    A user whose first order is still pending ('P') is stored with
    ``if_consumed = '0'``, which readers must treat as not consumed.
    """
    o = order_info_rows(spark, sf_dir, created_before=cut)
    first = (o.groupBy("user_id")
              .agg(F.min(F.struct("create_time", "id", "order_status")).alias("f")))
    consumed = F.col("f.order_status") != "P"
    return first.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(consumed, "1").otherwise("0").alias("if_consumed"),
        F.when(consumed, F.col("f.id")).alias("first_order_id"),
    )


# ----------------------------------------------------------------------- CDC
def _envelope(table, op, data_json) -> F.Column:
    return F.concat(F.lit('{"table":"'), table, F.lit('","type":"'), op, F.lit('","data":'),
                    data_json, F.lit("}"))


def cdc_object_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-dialect CDC messages: one changed row per message.

    Tables: order_info (orders), base_province (nation), user_info (customer),
    order_detail (lineitem), spu_info, sku_info, base_category3 and base_trademark
    (part), not_listed (supplier); operation type by key % 4;
    plus, per province, one message with an empty and one with a null payload.
    """
    def frame(rows, table, pidx, key_col, payload_cols, data_override=None):
        k = F.col(key_col)
        data = data_override if data_override is not None else F.to_json(F.struct(*payload_cols))
        return rows.select(
            F.lit(CDC_OBJECT_TOPIC).alias("topic"), F.lit(pidx).cast("int").alias("partition"),
            k.cast("long").alias("offset"), F.lit(None).cast("string").alias("key"),
            _envelope(F.lit(table), _pick(OBJECT_TYPES, k), data).alias("value"))

    orders = order_info_rows(spark, sf_dir)
    prov = province_rows(spark, sf_dir)
    users = user_rows(spark, sf_dir)
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    li = spread(li, "l_orderkey")
    detail = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").alias("sku_num"), F.col("l_extendedprice").alias("order_price"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"))
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"]).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"])
    pid = F.col("p_partkey").alias("id")
    empties = prov.select((F.col("id") * 2).alias("k2"))
    nulls = prov.select((F.col("id") * 2 + 1).alias("k2"))
    parts = [
        frame(orders, "order_info", 0, "id", ORDER_PAYLOAD),
        frame(prov, "base_province", 1, "id", ["id", "name", "region_id", "area_code"]),
        frame(users, "user_info", 2, "id", ["id", "name", "birthday", "gender"]),
        frame(detail, "order_detail", 3, "id",
              ["id", "order_id", "sku_id", "sku_num", "order_price", "create_time"]),
        frame(sup, "not_listed", 4, "id", ["id", "name", "nation_id"]),
        frame(part.select(pid, F.col("p_name").alias("name"), F.col("p_type").alias("category")), "spu_info", 6, "id",
              ["id", "name", "category"]),
        frame(part.select(pid, F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")), "sku_info", 7, "id",
              ["id", "name", "price"]),
        frame(part.select(pid, F.col("p_type").alias("name")), "base_category3", 8, "id", ["id", "name"]),
        frame(part.select(pid, F.col("p_brand").alias("name")), "base_trademark", 9, "id", ["id", "name"]),
        frame(empties, "base_province", 5, "k2", None, F.lit("{}")),
        frame(nulls, "base_province", 5, "k2", None, F.lit("null")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cdc_array_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array-dialect CDC messages: orders of one order date, packed in key
    chunks of at most ``ARRAY_CHUNK_KEYS`` keys and sorted by key; the
    operation type rotates per message.  Plus, per region, one message with an
    empty array, one with a null payload and one with a null element."""
    keyed = order_info_rows(spark, sf_dir)
    days = F.datediff(F.to_date(F.substring("create_time", 1, 10)), F.lit("1970-01-01").cast("date"))
    chunk = F.expr(f"id div {ARRAY_CHUNK_KEYS}")
    grouped = (keyed.groupBy(days.alias("days"), chunk.alias("chunk"))
               .agg(F.array_sort(F.collect_list(F.struct(*ORDER_PAYLOAD))).alias("rows")))
    msgs = grouped.select(
        F.lit(CDC_ARRAY_TOPIC).alias("topic"), (F.col("chunk") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (F.col("chunk") * 100000 + F.col("days")).cast("long").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        _envelope(F.lit("order_info"), _pick(ARRAY_TYPES, F.col("days") + F.col("chunk")),
                  F.to_json("rows")).alias("value"))
    reg = read_table(spark, sf_dir, "region", ["r_regionkey"])
    extra = [reg.select(F.lit(CDC_ARRAY_TOPIC).alias("topic"), F.lit(TOPIC_PARTITIONS).cast("int").alias("partition"),
                        (F.col("r_regionkey") * 3 + i).cast("long").alias("offset"),
                        F.lit(None).cast("string").alias("key"),
                        _envelope(F.lit("order_info"), F.lit("INSERT"), F.lit(txt)).alias("value"))
             for i, txt in enumerate(["[]", "null", "[null]"])]
    return msgs.unionByName(extra[0]).unionByName(extra[1]).unionByName(extra[2])
