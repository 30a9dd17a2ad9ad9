"""The four streaming apps as Structured Streaming queries.

Every ``foreachBatch`` body calls the same DataFrame functions as the batch
queries, writes its outputs before anything that marks progress (T6), and is
idempotent under replay of the same ``batch_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import schemas as S
from tideline.operators import cdc, dau, offsets, orders
from tideline.operators.parse import parse_orders, parse_province, parse_start_log, split_valid
from tideline.sources.messages import WIDE_ORDER_TOPIC
from tideline.streaming.buckets import BucketTable
from tideline.streaming.dau_state import SEEN_TTL_MS
from tideline.streaming.io import kafka_sink
from tideline.streaming.metrics import counted_write
from tideline.streaming.state import day_launches, first_orders, late_or_not, use_state_store
from tideline.streaming.table import IncrementTable, VersionedTable, current, exists

DAU_SCHEMA = S.DAU_INFO
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}  # T4
# Days of one batch that become a pruning filter on the seen-set; a batch whose
# clocks name more days joins on the day instead, with the same rows.
PRUNED_DAYS = 1000
#: ``saved(output, batch_id, rows)``: how many rows a batch saved (A3).
Saved = Callable[[str, int, int], None]


def _start(writer, trigger: dict | None):
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


# ---------------------------------------------------------------- offsets
def ledger_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, S.OFFSET_LEDGER)


def commit_offsets(ledger: VersionedTable, batch_df: DataFrame, batch_id: int, group_id: str) -> None:
    """K11 after the outputs: the batch's until-offsets, kept only when some
    partition advanced; the ledger never moves backwards."""
    ranges = offsets.offset_ranges(batch_df.withColumn("batch_id", F.lit(batch_id)))
    new = offsets.ledger_after(ranges, group_id, existing=ledger.read(before=batch_id))
    ledger.commit(new, batch_id)


def write_rejects(rejects: IncrementTable | None, bad: DataFrame, batch_id: int) -> None:
    """Messages that a job could not use, with the reason; nothing when there are none."""
    if rejects is not None and not bad.isEmpty():
        rejects.write(bad, batch_id)


def rejects_table(spark: SparkSession, root: str) -> IncrementTable:
    return IncrementTable(spark, root, S.REJECT)


# ------------------------------------------------------------------- DAU
def dau_watermark(msgs: DataFrame, delay: str = "7 days") -> DataFrame:
    """T1, state-store form: keep the first (dt, mid) seen within the
    watermark.  Keys match the batch query; which row of one micro-batch
    survives is not defined by Spark (the exact form below fixes it)."""
    rows, _ = dau.start_rows(msgs)
    rows = rows.observe("dau_before", F.count(F.lit(1)).alias("rows"))
    ev = rows.withColumn("event_time", F.timestamp_millis("ts"))
    firsts = ev.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(dau.DAU_KEY)
    return firsts.select(*dau.DAU_COLUMNS).observe("dau_after", F.count(F.lit(1)).alias("rows"))


def start_dau_watermark(msgs: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Append the watermark-deduplicated first launches to ``root``
    (file sink: exactly-once through its own commit log)."""
    w = (dau_watermark(msgs).writeStream.format("parquet").outputMode("append")
         .option("path", root).option("checkpointLocation", checkpoint).partitionBy("dt"))
    return _start(w, trigger)


def start_dau_rejects(msgs: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Append the start messages that have no device or time, with the reason, to ``root``
    (beside a form whose sink takes launches only)."""
    w = (dau.start_rows(msgs)[1].writeStream.format("parquet").outputMode("append")
         .option("path", root).option("checkpointLocation", checkpoint))
    return _start(w, trigger)


def dau_exact_batch(spark: SparkSession, table: IncrementTable,
                    compact_every: int | None = None, rejects: IncrementTable | None = None,
                    saved: Saved | None = None, index: BucketTable | None = None,
                    run_date: str | None = None) -> Callable[[DataFrame, int], None]:
    """T1, exact form: inside each micro-batch keep the first arrival per
    (dt, mid) by (ts, offset, partition), then drop keys already written by
    earlier batches (J4); the written increments are the seen-set.

    Only the days present in the batch are read back (partition pruning on
    ``dt``); every ``compact_every`` batches the increments are folded into a
    snapshot so the read lists a bounded number of folders.

    ``index`` (K2, K3): the new launches by the day they were processed, one row per
    device; ``run_date`` (yyyyMMdd) or the day the batch runs."""
    def run(batch_df: DataFrame, batch_id: int) -> None:
        parsed = parse_start_log(batch_df).persist()
        good, bad = split_valid(parsed)
        firsts = dau.first_launches(dau.with_day_parts(good)).persist()
        days = [r["dt"] for r in firsts.select("dt").distinct().limit(PRUNED_DAYS + 1).collect()]
        if days:  # a batch without valid rows writes none
            seen = table.read(before=batch_id).select(*dau.DAU_KEY)
            seen = seen.where(F.col("dt").isin(days)) if len(days) <= PRUNED_DAYS else \
                seen.join(firsts.select("dt").distinct(), "dt", "left_semi")
            new = firsts.join(seen, dau.DAU_KEY, "left_anti").persist()
            rows = table.write(new, batch_id)
            if index is not None:
                day = F.lit(run_date) if run_date else F.date_format(F.current_date(), "yyyyMMdd")
                index.upsert(new.withColumn("run_date", day), run_id(batch_df), batch_id, order=dau.ARRIVAL)
            if saved is not None:
                saved("dau", batch_id, rows)
            new.unpersist()
        write_rejects(rejects, bad, batch_id)
        firsts.unpersist()
        parsed.unpersist()
        table.compact_if_due(batch_id, compact_every)
    return run


def index_table(spark: SparkSession, root: str) -> BucketTable:
    schema = T.StructType([*DAU_SCHEMA.fields, T.StructField("run_date", T.StringType())])
    return BucketTable(spark, root, schema, ["mid"], by=["run_date"])


def dau_index(spark: SparkSession, root: str) -> DataFrame:
    """K2: the index as ``dau.dau_index_by_run_date`` names it."""
    return index_table(spark, root).read().select(
        F.concat(F.lit(dau.DAU_INDEX_PREFIX), "run_date").alias("index_name"), *dau.DAU_COLUMNS)


def start_dau_exact(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str,
                    trigger: dict | None = None, compact_every: int = 720, rejects: str | None = None,
                    saved: Saved | None = None, index: str | None = None, run_date: str | None = None):
    """``index``: folder of the index by processing day (``run_date``), read with ``dau_index``."""
    table = IncrementTable(spark, root, DAU_SCHEMA, partition_by=["dt"])
    bad = rejects_table(spark, rejects) if rejects else None
    by_day = index_table(spark, index) if index else None
    w = (msgs.writeStream.foreachBatch(dau_exact_batch(spark, table, compact_every, bad, saved, by_day, run_date))
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger)


# ------------------------------------------------------------------ orders
USER_STATE_SCHEMA = S.USER_STATE
WIDE_SCHEMA = S.ORDER_INFO


def order_batch(spark: SparkSession, state: IncrementTable, output: IncrementTable,
                read_provinces: Callable[[], DataFrame], read_users: Callable[[], DataFrame],
                rejects: IncrementTable | None = None, ledger: VersionedTable | None = None,
                group_id: str = "wide_orders", as_of=None,
                gender_rule: str = "standard", sink: Callable[[DataFrame, int], None] | None = None,
                compact_every: int | None = None, saved: Saved | None = None) -> Callable[[DataFrame, int], None]:
    """T2 + T3 + T5: flag first orders against the user state, enrich with
    freshly read dimensions, write the wide orders, then the state.

    Order of effects (replay-safe): wide rows (overwritten per batch id) ->
    state increment (keyed by user, records first_order_id, Q5) -> offsets.
    Every ``compact_every`` batches the state history is folded into a
    snapshot, so a batch's state read stays bounded as history grows.  Ages are
    as of ``as_of``, or of the day the batch runs.
    """
    def run(batch_df: DataFrame, batch_id: int) -> None:
        parsed = parse_orders(batch_df).persist()  # read and parse the source once for all outputs
        if parsed.isEmpty():  # an empty batch writes nothing
            parsed.unpersist()
            state.compact_if_due(batch_id, compact_every, ["user_id"])
            return
        good, bad = split_valid(parsed)
        # Only the state rows of this batch's users, filtered on the
        # increments scan before the newest-per-user ranking.
        batch_users = good.select(F.col("user_id").cast("string").alias("user_id"))
        st = state.latest(["user_id"], before=batch_id, only=batch_users)
        wide = orders.order_wide(good, read_provinces(), read_users(), state=st,
                                 as_of=as_of, gender_rule=gender_rule).persist()
        rows = output.write(wide, batch_id)
        if saved is not None:
            saved("order_wide", batch_id, rows)
        if sink is not None:  # e.g. Kafka: wide_order_messages(...).write.format("kafka")
            sink(wide, batch_id)
        state.write(orders.state_updates(wide), batch_id)
        state.compact_if_due(batch_id, compact_every, ["user_id"])
        write_rejects(rejects, bad, batch_id)
        if ledger is not None:
            commit_offsets(ledger, parsed.select("topic", "partition", "offset"), batch_id, group_id)
        wide.unpersist()
        parsed.unpersist()
    return run


def start_orders(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str,
                 provinces_path: str, users_path: str, trigger: dict | None = None,
                 compact_every: int = 720, **kw):
    """The order app; state compaction every ``compact_every`` batches (one
    hour at the 5-second trigger)."""
    state = IncrementTable(spark, f"{root}/user_state", USER_STATE_SCHEMA)
    output = IncrementTable(spark, f"{root}/order_wide", WIDE_SCHEMA)
    rejects = rejects_table(spark, f"{root}/rejects")
    body = order_batch(spark, state, output,
                       lambda: current(spark, provinces_path, S.BASE_PROVINCE),
                       lambda: current(spark, users_path, S.USER_INFO), rejects=rejects,
                       compact_every=compact_every, **kw)
    w = msgs.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return _start(w, trigger)


# ------------------------------------------- orders and devices in the state store
def run_id(batch_df: DataFrame) -> str:
    """The id of the streaming query whose micro-batch runs now: the same after a restart
    from its checkpoint, another one for a new checkpoint."""
    return batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_batch(rows: DataFrame, root: str, query: str, batch_id: int) -> int:
    """A micro-batch's rows in a folder of its own (query id, batch id), and how
    many there are.  A replay writes the same folder again; a query with a new checkpoint
    starts folders of its own, so it neither skips nor replaces what is there."""
    return counted_write(rows, lambda df: df.write.mode("overwrite").parquet(f"{root}/query={query}/batch={int(batch_id)}"))


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows that ``write_batch`` wrote below ``root``, with ``query`` and ``batch``."""
    if not exists(spark, root):
        return spark.createDataFrame([], schema).select("*", F.lit("").alias("query"), F.lit(0).cast("long").alias("batch"))
    whole = T.StructType([*schema.fields, T.StructField("query", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).option("basePath", root).parquet(root)


def _tagged(rows: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """One stream of two kinds of rows: those of ``more`` are the struct ``name``."""
    kind = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in more.schema.fields)
    return rows.withColumn(name, F.lit(None).cast(f"struct<{kind}>")).unionByName(
        more.select(F.struct(*more.columns).alias(name)), allowMissingColumns=True)


def orders_with_firsts(msgs: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Parsed order rows (rejects with their reason) and, as the struct ``first``, the
    first order of each user of the batch from the state store."""
    parsed = parse_orders(msgs)
    good, _ = split_valid(parsed)
    return _tagged(parsed, first_orders(good, seed), "first")


def stateful_order_batch(root: str, read_provinces: Callable[[], DataFrame], read_users: Callable[[], DataFrame],
                         as_of=None, gender_rule: str = "standard",
                         sink: Callable[[DataFrame, int], None] | None = None,
                         saved: Saved | None = None) -> Callable[[DataFrame, int], None]:
    """T2, T3, T5 with the user state in the state store: flag, enrich from freshly read
    dimensions, write wide orders and rejects.  The state is Spark's: it is committed
    with the batch, and a replay starts from the version before it."""
    def run(batch_df: DataFrame, batch_id: int) -> None:
        kept = batch_df.persist()
        query, n = run_id(batch_df), kept.count()  # every part of the state store runs once
        if n:  # F6
            good, bad = split_valid(kept.where(F.col("first").isNull()).drop("first"))
            firsts = kept.where(F.col("first").isNotNull()).select("first.*")
            flagged = orders.flags_of_firsts(good, firsts)
            wide = orders.enrich_user(orders.enrich_province(flagged, read_provinces()), read_users(), as_of, gender_rule) \
                .select(*S.ORDER_INFO_COLUMNS).persist()
            rows = write_batch(wide, f"{root}/order_wide", query, batch_id)
            if saved is not None:
                saved("order_wide", batch_id, rows)
            if sink is not None:
                sink(wide, batch_id)
            if not bad.isEmpty():
                write_batch(bad, f"{root}/rejects", query, batch_id)
            wide.unpersist()
        kept.unpersist()
    return run


def start_stateful_orders(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str, provinces_path: str,
                          users_path: str, trigger: dict | None = None, seed: DataFrame | None = None, **kw):
    """The order app.  ``seed`` is the user state that a new checkpoint starts from; what
    the query stored is read with ``state.user_state(spark, checkpoint)`` (K8)."""
    use_state_store(spark)
    body = stateful_order_batch(root, lambda: current(spark, provinces_path, S.BASE_PROVINCE),
                                lambda: current(spark, users_path, S.USER_INFO), **kw)
    w = orders_with_firsts(msgs, seed).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return _start(w, trigger)


def start_dau_by_day(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                     ttl_ms: int = SEEN_TTL_MS, rejects: str | None = None, saved: Saved | None = None):
    """T1 with the devices of each day in the state store and one expiry per day.  First
    launches go to ``root`` by query and batch, messages without a device to ``rejects``."""
    use_state_store(spark)
    good, bad = dau.start_rows(msgs)
    both = _tagged(day_launches(good, ttl_ms), bad, "reject")

    def run(batch_df: DataFrame, batch_id: int) -> None:
        kept = batch_df.persist()
        query, n = run_id(batch_df), kept.count()  # every part of the state store runs once
        if n:
            new = kept.where(F.col("reject").isNull()).select(*dau.DAU_COLUMNS)
            wrong = kept.where(F.col("reject").isNotNull()).select("reject.*")
            rows = 0 if new.isEmpty() else write_batch(new, root, query, batch_id)
            if saved is not None:
                saved("dau", batch_id, rows)
            if rejects and not wrong.isEmpty():
                write_batch(wrong, rejects, query, batch_id)
        kept.unpersist()

    return _start(both.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger)


def start_dau_with_late(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str, late: str, rejects: str,
                        delay: str = "7 days", trigger: dict | None = None, ttl_ms: int = SEEN_TTL_MS,
                        saved: Saved | None = None):
    """First launches of the rows that are not older than the watermark; the older ones
    are written to ``late`` instead of being dropped, messages without a device to
    ``rejects``.  The rows that were in time are counted (``on_time``), so that in time +
    late + rejected is what came in."""
    use_state_store(spark)
    good, bad = dau.start_rows(msgs)
    flagged = late_or_not(good, delay).observe("on_time", F.count_if(~F.col("late")).alias("rows"))
    whole = _tagged(day_launches(flagged, ttl_ms), bad, "reject")

    def run(batch_df: DataFrame, batch_id: int) -> None:
        kept = batch_df.persist()
        query, n = run_id(batch_df), kept.count()  # every part of the state store runs once
        if n:
            outputs = {root: kept.where(~F.col("late")).select(*dau.DAU_COLUMNS), late: kept.where("late").select(*dau.DAU_COLUMNS),
                       rejects: kept.where(F.col("reject").isNotNull()).select("reject.*")}
            rows = {folder: 0 if some.isEmpty() else write_batch(some, folder, query, batch_id) for folder, some in outputs.items()}
            if saved is not None:
                saved("dau", batch_id, rows[root])
        kept.unpersist()

    return _start(whole.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), trigger)


# --------------------------------------------------------------------- CDC
def start_cdc_route(msgs: DataFrame, root: str, checkpoint: str, dialect: str = "object",
                    trigger: dict | None = None, kafka_bootstrap: str | None = None):
    """Route change rows to per-table outputs: ``topic=ODS_T_<TABLE>`` folders
    under ``root``, or the topics themselves when ``kafka_bootstrap`` is given
    (each row goes to the topic in its own ``topic`` column).  Stateless; what
    can't be routed goes through ``start_cdc_rejects``."""
    routed, _ = _routed(msgs, dialect)
    out = cdc.to_topic_messages(routed)
    if kafka_bootstrap:
        return kafka_sink(out, kafka_bootstrap, checkpoint, trigger or DEFAULT_TRIGGER)
    else:
        w = (out.writeStream.format("parquet").outputMode("append")
             .option("path", root).option("checkpointLocation", checkpoint).partitionBy("topic"))
    return _start(w, trigger)


def _routed(msgs: DataFrame, dialect: str) -> tuple[DataFrame, DataFrame]:
    return cdc.route_object(msgs) if dialect == "object" else cdc.route_array(msgs)


def start_cdc_rejects(msgs: DataFrame, root: str, checkpoint: str, dialect: str = "object", trigger: dict | None = None):
    """Append the change messages that can't be routed, with the reason, to ``root``."""
    w = (_routed(msgs, dialect)[1].writeStream.format("parquet").outputMode("append")
         .option("path", root).option("checkpointLocation", checkpoint))
    return _start(w, trigger)


def publish_wide_orders(write_messages: Callable[[DataFrame], None], topic: str = WIDE_ORDER_TOPIC
                        ) -> Callable[[DataFrame, int], None]:
    """K9 as an ``order_batch`` sink: key = order id, value = JSON of the
    wide order, e.g. ``publish_wide_orders(io.kafka_batch_writer(servers))``."""
    def sink(wide: DataFrame, batch_id: int) -> None:
        write_messages(orders.wide_order_messages(wide, topic))
    return sink


# -------------------------------------------------------------- dimension
def dim_table(spark: SparkSession, root: str, schema=S.BASE_PROVINCE, parts: int = 16) -> BucketTable:
    """A dimension by id; ``parts`` grows with its size (a batch rewrites the parts that it touches)."""
    return BucketTable(spark, root, schema, ["id"], parts)


def dim_batch(table: BucketTable, rejects: IncrementTable | None = None, parse=parse_province) -> Callable[[DataFrame, int], None]:
    """K7: upsert dimension rows by id; within a batch the last message wins."""
    def run(batch_df: DataFrame, batch_id: int) -> None:
        parsed = parse(batch_df).persist()  # the source is read once
        if not parsed.isEmpty():  # F6
            good, bad = split_valid(parsed)
            table.upsert(good, run_id(batch_df), batch_id, order=["offset"])
            write_rejects(rejects, bad, batch_id)
        parsed.unpersist()
    return run


def start_dim(spark: SparkSession, msgs: DataFrame, root: str, checkpoint: str,
              trigger: dict | None = None, rejects: str | None = None, parts: int = 16):
    bad = rejects_table(spark, rejects) if rejects else None
    w = msgs.writeStream.foreachBatch(dim_batch(dim_table(spark, root, parts=parts), bad)).option("checkpointLocation", checkpoint)
    return _start(w, trigger)
