"""CDC routing (F2-F4, K6, P7-P10): decode change envelopes and route each
changed row to the topic of its table, keyed by the row's ``id``.

Both dialects are a single narrow projection: no shuffle, no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import topic_for_table
from tideline.operators.parse import COORDS, REJECT_COLUMNS, missing, parse_cdc_array, parse_cdc_object, split_valid

# ---------------------------------------------------------------------------
# Tables forwarded by the object-dialect router (any operation
# except delete), and the table forwarded only for inserts.
ROUTED_TABLES = ("base_province", "user_info", "spu_info", "sku_info",
                 "base_category3", "base_trademark", "order_detail")
INSERT_ONLY_TABLE = "order_info"
# ---------------------------------------------------------------------------

ROUTE_COLUMNS = ["topic", "partition", "offset", "key", "op_type", "data"]
# Payloads of one array message are told apart by their place in it.
ARRAY_PLACES = 1 << 20


def _route(df: DataFrame) -> DataFrame:
    return df.select(topic_for_table("table").alias("topic"), "partition", "offset",
                     F.get_json_object("data", "$.id").alias("key"),
                     F.col("type").alias("op_type"), "data")


def _filled() -> F.Column:
    return ~F.col("data").rlike(r"^\s*\{\s*\}\s*$")


def route_object(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Object dialect -> (routed rows, rejects).

    F2: payload present and non-empty, type present and not ``delete``.
    F3: ``order_info`` only for type ``insert`` (so ``bootstrap-insert`` order
    rows drop, Q10); the listed tables for any other type; table names are
    case-sensitive.  A null payload or type is a reject, not a failure (Q8).
    """
    p = parse_cdc_object(msgs)
    good, rejects = split_valid(p.withColumn("reason", missing(
        table=F.col("table"), type=F.col("type"), data=F.col("data"))))
    keep = (_filled() & (F.col("type") != "delete")
            & (((F.col("table") == INSERT_ONLY_TABLE) & (F.col("type") == "insert"))
               | F.col("table").isin(*ROUTED_TABLES)))
    return _route(good.where(keep)), rejects


def route_array(msgs: DataFrame, filter_like_object: bool = False) -> tuple[DataFrame, DataFrame]:
    """Array dialect -> (routed rows, rejects): one output per array element.

    F4: no type or table filter, deletes are forwarded (Q7).  An empty array
    yields nothing; a null array or table is a reject, and so is a null element
    (Q8).
    ``filter_like_object`` applies the object dialect's F2/F3 rules instead.
    """
    p = parse_cdc_array(msgs)
    p = p.withColumn("reason", missing(table=F.col("table"), data=F.col("data")))
    rejects = p.where("reason IS NOT NULL").select(*REJECT_COLUMNS)
    rows = p.where("reason IS NULL").select(*COORDS, "value", "table", "type", F.posexplode("data").alias("place", "data"))
    rejects = rejects.unionByName(rows.where("data IS NULL").select(*COORDS, "value", F.lit("null element").alias("reason")))
    rows = rows.where("data IS NOT NULL").withColumn("offset", F.col("offset") * ARRAY_PLACES + F.col("place"))
    if filter_like_object:
        t = F.lower("type")
        rows = rows.where(_filled() & (t != "delete")
                          & (((F.col("table") == INSERT_ONLY_TABLE) & (t == "insert"))
                             | F.col("table").isin(*ROUTED_TABLES)))
    return _route(rows), rejects


def to_topic_messages(routed: DataFrame) -> DataFrame:
    """K6 + P9: ``topic, key, value`` ready for a topic sink; the value is the
    payload with its types.  The source's coordinates serve file replays, where no
    broker gives new ones."""
    return routed.select("topic", "partition", "offset", "key", F.col("data").alias("value"))
