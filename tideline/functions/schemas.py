"""Record schemas of the warehouse."""

from pyspark.sql import types as T

S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Start log as produced by the app SDK: common.{mid,uid,ar,ch,vc}, ts in epoch millis.
COMMON = _struct(("mid", S), ("uid", S), ("ar", S), ("ch", S), ("vc", S))
START_LOG = _struct(("common", COMMON), ("ts", L))

# One daily-active-device row (first launch of a device on a day).
DAU_INFO = _struct(("mid", S), ("uid", S), ("ar", S), ("ch", S), ("vc", S),
                   ("dt", S), ("hr", S), ("mi", S), ("ts", L))

# The wire field names of order messages.
# Order as it arrives on the order topic ("feight_fee" is the wire spelling).
ORDER_SOURCE_FIELDS = [
    ("id", L), ("province_id", L), ("order_status", S), ("user_id", L),
    ("final_total_amount", D), ("benefit_reduce_amount", D),
    ("original_total_amount", D), ("feight_fee", D),
    ("expire_time", S), ("create_time", S), ("operate_time", S),
]
ORDER_SOURCE = _struct(*ORDER_SOURCE_FIELDS)

# Fields filled by the warehouse job; null until known.
ORDER_DERIVED_FIELDS = [
    ("create_date", S), ("create_hour", S), ("if_first_order", S),
    ("province_name", S), ("province_area_code", S),
    ("user_age_group", S), ("user_gender", S),
]
ORDER_INFO = _struct(*(ORDER_SOURCE_FIELDS + ORDER_DERIVED_FIELDS))
ORDER_INFO_COLUMNS = [n for n, _ in ORDER_SOURCE_FIELDS + ORDER_DERIVED_FIELDS]

# Per-user state; first_order_id is ours (makes a replayed batch idempotent, Q5).
USER_STATE = _struct(("user_id", S), ("if_consumed", S), ("first_order_id", L))

# Dimensions.
BASE_PROVINCE = _struct(("id", L), ("name", S), ("region_id", S), ("area_code", S))
USER_INFO = _struct(("id", L), ("name", S), ("birthday", S), ("gender", S))

# Change-data-capture envelopes: object payload (one row) or array payload (rows).
# A payload stays JSON text, so it is passed on with its types.
CDC_OBJECT = _struct(("table", S), ("type", S), ("data", S))
CDC_ARRAY = _struct(("table", S), ("type", S), ("data", T.ArrayType(S)))

# A message that no job could use, with the reason.
REJECT = _struct(("topic", S), ("partition", I), ("offset", L), ("value", S), ("reason", S))

# A topic message after the value bytes are decoded to text.
MESSAGE = _struct(("topic", S), ("partition", I), ("offset", L), ("key", S), ("value", S))

# Offset ledger: one row per (group, topic, partition).
OFFSET_LEDGER = _struct(("group_id", S), ("topic", S), ("partition", I), ("until_offset", L))
