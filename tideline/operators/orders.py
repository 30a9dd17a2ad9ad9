"""Wide orders: first-order flag across batches (J1, A1, W1, O1, T2, K8) and
province / user enrichment (J2, J3, P12-P15, K9).

Skew: one user may own a third of all orders, so no step shuffles whole
orders by user into one window.  The earliest order of each user is found by
an aggregate (combined map-side, one row per user per map task), and the
flag goes back onto the order rows by a join on the message coordinates
(topic, partition, offset), which are unique and evenly spread.  The only
user-keyed join of full order rows is the one that attaches what is known per
user.  Its right side has an exchange of its own, so AQE sees two plain shuffles
and splits a hot user's partition (left outer joins split their left side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import age_group, age_years, gender_label
from tideline.functions.schemas import ORDER_INFO_COLUMNS
from tideline.operators.parse import COORDS, parse_orders, split_valid
from tideline.operators.upsert import keyed_upsert

# Row order inside a user's batch: create_time, then id (Q3 tie-break), then
# the delivery position (a duplicate delivery keeps the earlier copy, Q15).
FIRST_ORDER = ["create_time", "id", "topic", "partition", "offset"]
W_COLS = ["w_topic", "w_partition", "w_offset"]


def order_rows(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid typed order rows with create_date / create_hour, rejects)."""
    return split_valid(parse_orders(msgs))


def _state(state: DataFrame) -> DataFrame:
    """State keyed by the numeric user id (the stored key is its text)."""
    return state.select(F.expr("try_cast(user_id AS BIGINT)").alias("user_id"),
                        "if_consumed", "first_order_id")


def state_lookup(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State rows of the users present in the batch (a semi join; the
    batch keys are distinct, so AQE broadcasts them when they are small)."""
    keys = batch.select(F.col("user_id").cast("string").alias("user_id")).distinct()
    return state.join(keys, "user_id", "left_semi")


def state_flag(orders: DataFrame, state: DataFrame) -> DataFrame:
    """Flag from the state alone: '0' when the user has consumed before
    (and this order is not the recorded first order, Q5), else '1'."""
    st = _state(state)
    j = orders.join(st.withColumnRenamed("user_id", "_u"), orders.user_id == F.col("_u"), "left")
    seen = (F.col("if_consumed") == "1") & ~F.coalesce(F.col("first_order_id") == F.col("id"), F.lit(False))
    return j.withColumn("if_first_order", F.when(seen, "0").otherwise("1")).drop(
        "_u", "if_consumed", "first_order_id")


def batch_winners(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Per user of the batch, the coordinates of the one row flagged '1'.

    Rule (T2 with replay safety, Q5): candidates are all rows of a user who has
    not consumed, or the rows whose id is the user's recorded first order;
    the earliest candidate by FIRST_ORDER wins.  ``w_*`` are null when the
    user has no candidate.  Output: user_id, w_topic, w_partition, w_offset.

    A stream job passes ``state_lookup(state, batch)`` (only the batch's users)
    so a small batch never joins against the whole state.
    """
    rows = orders.select("user_id", *FIRST_ORDER)
    if state is None:
        agg = rows.groupBy("user_id").agg(F.min(F.struct(*FIRST_ORDER)).alias("w"))
        return agg.select("user_id", *[F.col(f"w.{c}").alias(f"w_{c}") for c in COORDS])
    st = _state(state)
    recorded = (st.where((F.col("if_consumed") == "1") & F.col("first_order_id").isNotNull())
                  .select("user_id", F.col("first_order_id").alias("id"), F.lit(0).alias("_rank")))
    # (user_id, id) is a near-unique key, so this join has no hot key.
    marked = (rows.join(recorded, ["user_id", "id"], "left")
                  .withColumn("_rank", F.coalesce("_rank", F.lit(1))))
    agg = marked.groupBy("user_id").agg(F.min(F.struct("_rank", *FIRST_ORDER)).alias("w"))
    j = agg.join(st.select("user_id", "if_consumed"), "user_id", "left")
    wins = (F.coalesce(F.col("if_consumed"), F.lit("")) != "1") | (F.col("w._rank") == 0)
    return j.select("user_id", *[F.when(wins, F.col(f"w.{c}")).alias(f"w_{c}") for c in COORDS])


def apply_flags(orders: DataFrame, winners: DataFrame) -> DataFrame:
    """Put ``if_first_order`` on the rows: '1' for the winning coordinates."""
    w = (winners.where(F.col("w_offset").isNotNull())
                .select(*[F.col(f"w_{c}").alias(c) for c in COORDS], F.lit("1").alias("_flag")))
    return (orders.join(w, COORDS, "left")
                  .withColumn("if_first_order", F.coalesce("_flag", F.lit("0"))).drop("_flag"))


def first_order_flags(orders: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """A1 + W1 (+ J1 when a state is given): rows with the final flag."""
    return apply_flags(orders, batch_winners(orders, state))


def flags_of_firsts(orders: DataFrame, firsts: DataFrame) -> DataFrame:
    """The final flag from each user's first order (``streaming.state.first_orders``): of
    the copies of that order in the batch the earliest is flagged '1' (Q5).  (user_id, id)
    is a near-unique key, so no user's rows meet in one task."""
    copies = orders.select("user_id", *FIRST_ORDER).join(
        firsts.select("user_id", F.col("first_order_id").alias("id")), ["user_id", "id"])
    earliest = copies.groupBy("user_id", "id").agg(F.min(F.struct(*FIRST_ORDER)).alias("w"))
    return apply_flags(orders, earliest.select(*[F.col(f"w.{c}").alias(f"w_{c}") for c in COORDS]))


def state_flags_of_firsts(orders: DataFrame, firsts: DataFrame) -> DataFrame:
    """J1 from the same rows: '0' when the user had consumed before the batch and the
    order is not the recorded first one, else '1'."""
    before = firsts.where("consumed").select(F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"),
                                             "first_order_id")
    return state_flag(orders, before)


def state_updates(flagged: DataFrame) -> DataFrame:
    """F5 + P12: state rows of the users whose first order is in the batch."""
    return flagged.where(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"),
        F.col("id").alias("first_order_id"))


def upsert_state(state: DataFrame, flagged: DataFrame) -> DataFrame:
    """K8: the state after this batch (one row per user)."""
    return keyed_upsert(state.select("user_id", "if_consumed", "first_order_id"),
                        state_updates(flagged), ["user_id"])


# ------------------------------------------------------------- enrichment
def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key of a dimension; of several the largest by its other columns."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*")


def own_exchange(rows: DataFrame) -> DataFrame:
    """Put an exchange under a join side that ends in an aggregate or a join, so that
    the join reads two plain shuffles, which is what AQE can split."""
    return rows.hint("rebalance")


def province_attrs(provinces: DataFrame) -> DataFrame:
    return provinces.select(F.col("id").alias("_pid"), F.col("name").alias("province_name"),
                            F.col("area_code").alias("province_area_code"))


def enrich_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Left join to the province dimension, one row per province (Spark
    broadcasts it when it is small; the caller re-reads it for every batch, T3)."""
    p = one_per_key(province_attrs(provinces), "_pid")
    return orders.join(p, orders.province_id == F.col("_pid"), "left").drop("_pid")


def user_attrs(users: DataFrame, as_of=None, gender_rule: str = "standard") -> DataFrame:
    """P13-P15, one row per user: gender label and age group as of a day (today when
    none is given)."""
    return one_per_key(users.select("id", "birthday", "gender"), "id").select(F.col("id").alias("user_id"),
                        gender_label("gender", gender_rule).alias("user_gender"),
                        age_group(age_years("birthday", as_of)).alias("user_age_group"))


def enrich_user(orders: DataFrame, users: DataFrame, as_of=None,
                gender_rule: str = "standard") -> DataFrame:
    """Left join to the user dimension.  Not forced to broadcast: the
    user dimension grows with the business; AQE picks the strategy and splits
    a hot user's partition."""
    return orders.join(own_exchange(user_attrs(users, as_of, gender_rule)), "user_id", "left")


def order_wide(orders: DataFrame, provinces: DataFrame, users: DataFrame,
               state: DataFrame | None = None, as_of=None,
               gender_rule: str = "standard") -> DataFrame:
    """T2 + J2 + J3: every OrderInfo field.

    The per-user winner and the per-user attributes are joined first (one row
    per user on both sides), so the order rows are shuffled once, by user.
    """
    per_user = batch_winners(orders, state).join(user_attrs(users, as_of, gender_rule),
                                                 "user_id", "left")
    o = enrich_province(orders, provinces).join(own_exchange(per_user), "user_id", "left")
    hit = F.lit(True)
    for cname in COORDS:
        hit = hit & (F.col(cname) == F.col(f"w_{cname}"))
    return o.withColumn("if_first_order", F.when(hit, "1").otherwise("0")).select(*ORDER_INFO_COLUMNS)


def wide_order_messages(wide: DataFrame, topic: str) -> DataFrame:
    """K9: key = order id, value = JSON of the whole record."""
    return wide.select(F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"),
                       F.to_json(F.struct(*ORDER_INFO_COLUMNS)).alias("value"))
