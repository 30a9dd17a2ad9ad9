"""Plan-shape checks that keep the scale properties from regressing, and a
hot-key test where one user owns a third of all orders."""
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators import orders
from tideline.plans.queries import QUERIES
from tideline.sources import messages as M
from conftest import SF_SMALL


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_join_anywhere(spark):
    for name, q in QUERIES.items():
        s = plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s, name


def test_order_wide_has_no_window_by_user_and_combines_map_side(spark):
    s = plan(QUERIES["order_wide"](spark, SF_SMALL))
    assert not re.search(r"Window \[", s), "no window may partition whole order rows"
    assert re.search(r"(Sort|Hash)Aggregate\(keys?=\[user_id#\d+L?\], functions=\[partial_min", s)
    assert "BroadcastHashJoin" in s  # the small province dimension


def test_first_launch_is_limited_before_the_shuffle(spark):
    s = plan(QUERIES["dau_info"](spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit .* Partial", s)


def test_each_message_is_parsed_once(spark):
    s = plan(QUERIES["start_log_parse"](spark, SF_SMALL))
    assert s.count("from_json(") == 1


def test_small_upsert_batch_is_broadcast_not_shuffled(spark):
    s = plan(QUERIES["dim_upsert"](spark, SF_SMALL))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", s)


def test_hot_user_flags_match_a_plain_window(spark):
    rows = M.order_info_rows(spark, SF_SMALL)
    n = rows.count()
    # One user owns every third order.
    hot = rows.withColumn("user_id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    good, _ = orders.order_rows(M.order_messages(spark, SF_SMALL, rows=hot))
    got = orders.first_order_flags(good)
    w = Window.partitionBy("user_id").orderBy("create_time", "id")
    want = good.withColumn("ref", F.when(F.row_number().over(w) == 1, "1").otherwise("0"))
    j = got.select("id", "if_first_order").join(want.select("id", "ref"), "id")
    assert j.count() == n
    assert j.where("if_first_order <> ref").count() == 0
    assert got.where("user_id = 0 AND if_first_order = '1'").count() == 1


def test_hot_device_first_launch_matches_a_plain_window(spark):
    from tideline.operators import dau
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    import tempfile
    path = tempfile.mkdtemp(prefix="tideline-hot-") + "/events.parquet"
    hot.write.parquet(path)
    msgs = M.start_log_messages(spark, path.rsplit("/", 1)[0])
    rows, _ = dau.start_rows(msgs)
    got = dau.first_launches(rows).select("dt", "mid", "offset", "partition")
    w = Window.partitionBy("dt", "mid").orderBy("ts", "offset", "partition")
    want = rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("dt", "mid", "offset", "partition")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.where("mid = 'mid_7'").count() == rows.where("mid = 'mid_7'").select("dt").distinct().count()


def _many_files(spark, rows, parts=8):
    import tempfile
    path = tempfile.mkdtemp(prefix="tideline-files-") + "/t"
    rows.repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def _hot_orders(spark):
    """Order messages in several files; one user owns a third of the orders."""
    rows = M.order_info_rows(spark, SF_SMALL)
    rows = rows.unionByName(rows.withColumn("id", F.col("id") + 1_000_000))
    hot = rows.withColumn("user_id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") * 1000 + F.col("id") % 500))
    return _many_files(spark, M.order_messages(spark, SF_SMALL, rows=hot))


def test_hot_user_is_split_in_order_wide(spark):
    from tideline.session import keep
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        good, _ = orders.order_rows(_hot_orders(spark))
        wide = orders.order_wide(keep(good), M.province_rows(spark, SF_SMALL), M.user_rows(spark, SF_SMALL), as_of="2024-01-30")
        wide.collect()
        s = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert re.search(r"SortMergeJoin\(skew=true\) \[user_id", s), s


def test_orders_are_parsed_once_from_many_files(spark):
    """The parse is kept: every reader of it scans the kept rows."""
    from tideline.session import keep
    good, _ = orders.order_rows(_hot_orders(spark))
    kept = keep(good)
    for df in (orders.first_order_flags(kept),
               orders.order_wide(kept, M.province_rows(spark, SF_SMALL), M.user_rows(spark, SF_SMALL), as_of="2024-01-30")):
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        inside = 1 << 30
        for line in lines:
            if depth(line) <= inside:
                inside = depth(line) if "InMemoryRelation" in line else 1 << 30
                assert "from_json" not in line, line
        assert sum("InMemoryTableScan" in x for x in lines) >= 2
