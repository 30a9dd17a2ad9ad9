"""The keyed table that rewrites only what a batch touches: dimensions and the index by
processing day; replay, a cut overwrite, a query with a new checkpoint."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import schemas as S
from tideline.operators import dau
from tideline.plans.queries import QUERIES
from tideline.sources import messages as M
from tideline.streaming import jobs
from tideline.streaming.buckets import BucketTable
from tideline.streaming.io import message_file_stream
from tideline.streaming.table import IncrementTable, VersionedTable
from conftest import SF_MID, SF_SMALL
from test_streaming import AVAILABLE_NOW, run, start_log_files

NAMED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs
            if f.endswith(".parquet") and "_pending" not in d}


def named(spark, *rows):
    return spark.createDataFrame(rows, NAMED)


def rows_of(t):
    return sorted(map(tuple, t.read().collect()))


def test_a_small_batch_rewrites_only_the_parts_it_touches(spark, scratch):
    users = M.user_rows(spark, SF_MID)
    n = users.count()
    t = BucketTable(spark, scratch, S.USER_INFO, ["id"], parts=64)
    assert t.upsert(users, "q", 0) == 64
    before = files(scratch)
    batch = users.orderBy("id").limit(5).withColumn("name", F.upper("name")).unionByName(
        users.orderBy("id").limit(5).withColumn("id", F.col("id") + 10_000_000))
    touched = t.upsert(batch, "q", 1)
    after = files(scratch)
    parts = lambda paths: {os.path.dirname(p) for p in paths}
    assert 1 <= touched <= 10 and n >= 1000
    assert parts(set(before) ^ set(after)) <= parts(after) and len(parts(set(after) - set(before))) == touched
    assert len(set(before) & set(after)) == len(before) - touched  # the others are the same files
    assert t.read().count() == n + 5 and t.read().select("id").distinct().count() == n + 5
    assert t.read().where("name = upper(name)").count() >= 5


def test_upsert_equals_the_query(spark, scratch):
    """user_dim_upsert through the table: what is stored first, then the changes twice."""
    from tideline.plans import params as P
    from tideline.sources.tables import read_table
    t = BucketTable(spark, scratch, S.USER_INFO, ["id"], parts=8)
    t.upsert(M.user_rows(spark, SF_SMALL, missing_segment=P.MISSING_SEGMENT), "q", 0)
    seg = M.user_rows(spark, SF_SMALL).join(read_table(spark, SF_SMALL, "customer", ["c_custkey", "c_mktsegment"]),
                                            F.col("id") == F.col("c_custkey"))
    changes = seg.where(F.col("c_mktsegment") == P.CHANGED_SEGMENT).withColumn("name", F.concat(F.upper("name"), F.lit(" (renamed)"))) \
        .unionByName(seg.where(F.col("c_mktsegment") == P.MISSING_SEGMENT)).select(*S.USER_INFO.fieldNames())
    t.upsert(changes.unionByName(changes), "q", 1)
    assert rows_of(t) == sorted(map(tuple, QUERIES["user_dim_upsert"](spark, SF_SMALL).select(*S.USER_INFO.fieldNames()).collect()))


def test_replay_and_a_cut_overwrite(spark, scratch, monkeypatch):
    t = BucketTable(spark, scratch, NAMED, ["id"], parts=4)
    t.upsert(named(spark, (1, "a"), (2, "b"), (3, "c")), "q", 0)
    assert t.upsert(named(spark, (1, "other")), "q", 0) == 0  # a replay of a finished batch
    assert rows_of(t) == [(1, "a"), (2, "b"), (3, "c")]

    def cut(self, pending):
        raise RuntimeError("the driver died")

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_replace", cut)
        with pytest.raises(RuntimeError):
            t.upsert(named(spark, (2, "B"), (9, "z")), "q", 1)
    # half of the overwrite happened: a part that was merged is gone
    part = os.path.join(scratch, [d for d in os.listdir(scratch) if d.startswith("part=")][0])
    merged = {d for d in os.listdir(os.path.join(scratch, "_pending", "q-1")) if d.startswith("part=")}
    if os.path.basename(part) in merged:
        os.rename(part, os.path.join(scratch, "_lost"))
    again = BucketTable(spark, scratch, NAMED, ["id"], parts=4)
    assert again.upsert(named(spark, (2, "B"), (9, "z")), "q", 1) == 0
    assert rows_of(again) == [(1, "a"), (2, "B"), (3, "c"), (9, "z")]


def test_another_query_first_ends_what_was_cut(spark, scratch, monkeypatch):
    t = BucketTable(spark, scratch, NAMED, ["id"], parts=4)
    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_replace", lambda self, p: (_ for _ in ()).throw(RuntimeError("cut")))
        with pytest.raises(RuntimeError):
            t.upsert(named(spark, (1, "a")), "old", 0)
    t.upsert(named(spark, (2, "b")), "new", 0)  # ids start again; both rows stay
    assert rows_of(t) == [(1, "a"), (2, "b")]


def test_ties_nulls_and_odd_partition_values(spark, scratch):
    schema = T.StructType([*NAMED.fields, T.StructField("day", T.StringType())])
    t = BucketTable(spark, scratch, schema, ["id"], parts=3, by=["day"])
    rows = [(1, "a", "x'y\\z"), (1, "b", None), (1, None, "x'y\\z"), (2, "same", "d"), (2, "same", "d")]
    t.upsert(spark.createDataFrame(rows, schema), "q", 0)
    t.upsert(spark.createDataFrame([(1, "new", "x'y\\z")], schema), "q", 1)
    assert sorted((r.id, r.name, r.day) for r in t.read().collect() if r.day) == [(1, "new", "x'y\\z"), (2, "same", "d")]
    assert [(r.id, r.name) for r in t.read().collect() if r.day is None] == [(1, "b")]
    t.upsert(spark.createDataFrame([], schema), "q", 2)
    assert t.read().count() == 3


def test_index_by_processing_day_equals_the_query(spark, scratch):
    at = lambda *p: os.path.join(scratch, *p)
    path, n = start_log_files(spark, SF_SMALL, scratch)
    run(jobs.start_dau_exact(spark, message_file_stream(spark, path), at("dau"), at("ck"), AVAILABLE_NOW,
                             index=at("index"), run_date="20240203"))
    want = dau.dau_index_by_run_date(M.start_log_messages(spark, SF_SMALL), F.to_date(F.lit("2024-02-03")))
    assert sorted(map(tuple, jobs.dau_index(spark, at("index")).collect())) == sorted(map(tuple, want.collect()))
    assert want.count() == want.select("mid").distinct().count()  # the doc id is the device alone


def test_a_used_folder_fails_loudly(spark, scratch):
    """T6 of the older tables: batch ids start at 0 again with a new checkpoint."""
    path = os.path.join(scratch, "msgs")
    M.start_log_messages(spark, SF_SMALL).select("topic", "partition", "offset", F.lit(None).cast("string").alias("key"), "value") \
        .coalesce(1).write.parquet(path)
    out = os.path.join(scratch, "dau")
    run(jobs.start_dau_exact(spark, message_file_stream(spark, path), out, os.path.join(scratch, "ck1"), AVAILABLE_NOW))
    n = IncrementTable(spark, out, S.DAU_INFO, ["dt"]).read().count()
    q = jobs.start_dau_exact(spark, message_file_stream(spark, path), out, os.path.join(scratch, "ck2"), AVAILABLE_NOW)
    with pytest.raises(Exception, match="was written by query"):
        q.awaitTermination(300)
    assert n and IncrementTable(spark, out, S.DAU_INFO, ["dt"]).read().count() == n
    run(jobs.start_dau_exact(spark, message_file_stream(spark, path), out, os.path.join(scratch, "ck1"), AVAILABLE_NOW))
    v = VersionedTable(spark, os.path.join(scratch, "v"), NAMED)
    v.commit(named(spark, (1, "a")), 0)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "another")
    try:
        with pytest.raises(RuntimeError, match="was written by query"):
            v.commit(named(spark, (2, "b")), 0)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
