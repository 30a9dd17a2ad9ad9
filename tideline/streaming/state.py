"""State of the streams in Spark's state store.

``first_orders`` keeps the first order of each user, ``day_launches`` the devices
of each day.  Both reduce the rows of a task to one row per key before the
shuffle, so a user or a device with a third of a batch sends a few rows, and look
their keys up one by one, so a batch costs what its own keys cost, however many
are stored.  A replayed micro-batch starts from the state version before it and
gives the same rows.  Needs the RocksDB provider (``use_state_store``).

The state is read back as a table through Spark's state data source
(``user_state``), and a new query starts from such a table (``seed``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tideline.operators import dau
from tideline.operators.orders import FIRST_ORDER

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows that a task holds before it hands its least rows on.
TASK_ROWS = 200_000


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# ------------------------------------------------------------- before the shuffle
def _least(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    at = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
    rows = rows.take(at)
    numbered = rows.select(keys).append_column("_row", pa.array(range(rows.num_rows), pa.int64()))
    return rows.take(numbered.group_by(keys).aggregate([("_row", "min")])["_row_min"])


def least_in_task(keys: list[str], order: list[str], most: int = TASK_ROWS) -> Callable:
    """A ``mapInArrow`` body: of the rows of a task the least per key by ``order`` (nulls
    first).  A task of many keys hands its rows on in pieces, so a key may come again."""
    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_least(pa.Table.from_batches([batch]), keys, order))
            n += held[-1].num_rows
            if n >= most:
                whole = _least(pa.concat_tables(held), keys, order)
                if whole.num_rows > most // 2:
                    yield from whole.to_batches()
                    held, n = [], 0
                else:
                    held, n = [whole], whole.num_rows
        if held:
            yield from _least(pa.concat_tables(held), keys, order).to_batches()
    return reduce


def _rank(row: Row, order: list[str]) -> tuple:
    return tuple((row[c] is not None, row[c]) for c in order)


# ------------------------------------------------------------------- first orders
FIRSTS = "user_id bigint, consumed boolean, first_order_id bigint"


class FirstOrders(StatefulProcessor):
    """One row per user of the batch: whether the user had consumed before it, and the
    user's first order, which is this batch's earliest when there was none."""

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", "first_order_id bigint")

    def handleInputRows(self, key, rows, timerValues):
        stored = self.first.get()
        if stored is None:
            order = min((_rank(r, FIRST_ORDER) for r in rows))[FIRST_ORDER.index("id")][1]
            self.first.update((order,))
        else:
            order = stored[0]
        yield Row(user_id=key[0], consumed=stored is not None, first_order_id=order)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["if_consumed"] == "1":
            self.first.update((initialState["first_order_id"],))

    def close(self) -> None:
        pass


def first_orders(rows: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """For each micro-batch of valid order rows the first order of its users (FIRSTS).

    ``seed``: a user-state table (user_id text, if_consumed, first_order_id; one row per
    user) that a query with a new checkpoint starts from.  A user who is not marked '1'
    there has not consumed."""
    keys = rows.select("user_id", *FIRST_ORDER).where(F.col("user_id").isNotNull())
    least = keys.mapInArrow(least_in_task(["user_id"], FIRST_ORDER), keys.schema)
    start = None
    if seed is not None:
        start = seed.select(F.expr("try_cast(user_id AS BIGINT)").alias("user_id"), "if_consumed", "first_order_id") \
            .where(F.col("user_id").isNotNull()).groupBy("user_id")
    return least.groupBy("user_id").transformWithState(FirstOrders(), FIRSTS, "Append", "None", initialState=start)


def user_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """K8: the users who have consumed, as the query at ``checkpoint`` stored them after its
    last committed batch: user_id, if_consumed, first_order_id."""
    rows = spark.read.format("statestore").option("stateVarName", "first").load(checkpoint)
    return rows.select(F.col("key.user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"),
                       F.col("value.first_order_id").alias("first_order_id"))


# ------------------------------------------------------------------ devices of a day
#: Parts of a day's devices.  A batch of a day holds the devices of one part in one task.
DAY_PARTS = 64
_LAUNCH = "mid string, uid string, ar string, ch string, vc string, dt string, hr string, mi string, ts bigint"


class DayLaunches(StatefulProcessor):
    """The devices of a part of a day.  Any event of the day moves the expiry of the whole
    day; the day is forgotten ``ttl_ms`` after its last event."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "mid string", "seen boolean")
        self.until = handle.getValueState("until", "ms bigint")

    def handleInputRows(self, key, rows, timerValues):
        least: dict[str, tuple] = {}
        alive = False
        for r in rows:
            if r["late"]:
                yield Row(**{c: r[c] for c in dau.DAU_COLUMNS}, late=True)
                continue
            alive = True
            if r["mid"] is not None:  # else only word that the day had an event
                rank = _rank(r, dau.ARRIVAL)
                if r["mid"] not in least or rank < least[r["mid"]][0]:
                    least[r["mid"]] = (rank, r)
        if alive:
            self._move_expiry(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        for mid, (_, r) in least.items():
            if not self.seen.containsKey((mid,)):
                self.seen.updateValue((mid,), (True,))
                yield Row(**{c: r[c] for c in dau.DAU_COLUMNS}, late=False)

    def _move_expiry(self, until: int) -> None:
        armed = self.until.get()
        if armed is None or armed[0] != until:
            if armed is not None:
                self.handle.deleteTimer(armed[0])
            self.handle.registerTimer(until)
            self.until.update((until,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        self.until.clear()
        return iter([])

    def close(self) -> None:
        pass


def _launch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Late rows as they are; of the others the least per device and day in the task; and a
    row without a device for each day that had one in time."""
    late: list[pa.RecordBatch] = []

    def in_time():
        for batch in batches:
            if pc.any(batch.column("late")).as_py():
                late.append(batch.filter(batch.column("late")))
            yield batch.filter(pc.invert(batch.column("late")))

    def alike(columns, schema):
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema([(f.name, f.type) for f in schema]))

    for batch in least_in_task(dau.DAU_KEY, dau.ARRIVAL)(in_time()):
        yield alike(batch.columns, batch.schema)
        days = pc.unique(batch.column("dt"))
        word = {"dt": days, "late": pa.array([False] * len(days))}
        yield alike([word.get(f.name, pa.nulls(len(days), f.type)) for f in batch.schema], batch.schema)
    for batch in late:
        yield alike(batch.columns, batch.schema)


def day_launches(rows: DataFrame, ttl_ms: int, parts: int = DAY_PARTS) -> DataFrame:
    """T1 + F1: the first arrival of each (day, device) in a stream of valid start rows, with
    an expiry that belongs to the day; rows marked ``late`` come out as they are.  Each
    task tells every part of a day that the day had an event: one row per task, day and
    part."""
    late = F.col("late") if "late" in rows.columns else F.lit(False)
    keys = rows.select(*dau.DAU_COLUMNS, "offset", "partition", late.alias("late"))
    least = keys.mapInArrow(_launch_rows, f"{_LAUNCH}, offset bigint, partition int, late boolean")
    part = F.pmod(F.when(F.col("late"), F.xxhash64("partition", "offset")).otherwise(F.xxhash64("mid")), F.lit(parts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    placed = least.withColumn("part", F.explode(F.when(F.col("mid").isNull(), every).otherwise(F.array(part))))
    return placed.groupBy("dt", "part").transformWithState(
        DayLaunches(ttl_ms), f"{_LAUNCH}, late boolean", "Append", "ProcessingTime")


# ------------------------------------------------------------------------ late rows
#: Groups that rows are dealt into, evenly and whatever their device, to meet the watermark.
WATERMARK_GROUPS = 64


class LateOrNot(StatefulProcessor):
    """Each row with whether it is older than the watermark; keeps no state."""

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        for r in rows:
            yield Row(**{c: r[c] for c in (*dau.DAU_COLUMNS, "offset", "partition")}, late=r["ts"] < watermark)

    def close(self) -> None:
        pass


def late_or_not(rows: DataFrame, delay: str) -> DataFrame:
    """Start rows with ``late``: whether their time is before the watermark, the newest
    event of the batches so far less ``delay``.  Spark drops such rows in its own stateful
    operators; here none is dropped."""
    timed = rows.select(*dau.DAU_COLUMNS, "offset", "partition", F.timestamp_millis("ts").alias("event_time")) \
        .withWatermark("event_time", delay)
    schema = f"{_LAUNCH}, offset bigint, partition int"
    # the watermark stays in the query, its column does not reach the operator, which would drop by it
    plain = timed.mapInArrow(_without_time, schema)
    group = F.pmod(F.xxhash64("partition", "offset"), F.lit(WATERMARK_GROUPS)).cast("int")
    return plain.withColumn("group", group).groupBy("group").transformWithState(
        LateOrNot(), f"{schema}, late boolean", "Append", "EventTime")


def _without_time(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.drop_columns(["event_time"])
