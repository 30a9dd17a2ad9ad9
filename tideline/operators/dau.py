"""Daily active devices: first launch of each device per day (T1, D1, P2-P4,
J4, K2, K3, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.columns import millis_format
from tideline.operators.parse import parse_start_log, split_valid
from tideline.operators.rank import first_per_key, last_per_key
from tideline.operators.upsert import keyed_upsert

DAU_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]
DAU_KEY = ["dt", "mid"]
# Arrival order inside a topic: event time, then the message position.
ARRIVAL = ["ts", "offset", "partition"]
DAU_INDEX_PREFIX = "dau_info_"


def with_day_parts(parsed: DataFrame) -> DataFrame:
    """P3 + P4: ``dt`` (yyyy-MM-dd), ``hr``, ``mi`` from epoch-millis ``ts``."""
    return (parsed.withColumn("dt", millis_format("ts", "yyyy-MM-dd"))
                  .withColumn("hr", millis_format("ts", "HH"))
                  .withColumn("mi", millis_format("ts", "mm")))


def start_rows(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid start-log rows with day parts, rejects)."""
    good, bad = split_valid(parse_start_log(msgs))
    return with_day_parts(good), bad


def first_launches(rows: DataFrame) -> DataFrame:
    """The first-arriving row of each (dt, mid)."""
    return first_per_key(rows, DAU_KEY, ARRIVAL)


def dau_info(msgs: DataFrame) -> DataFrame:
    rows, _ = start_rows(msgs)
    return first_launches(rows).select(*DAU_COLUMNS)


def dau_incremental(batch_msgs: DataFrame, seen: DataFrame) -> DataFrame:
    """First launches of this batch whose (dt, mid) is not in ``seen``.

    ``seen`` holds (dt, mid) keys; the anti join shares the (dt, mid)
    partitioning of the dedup, so the batch side is not shuffled twice.
    """
    rows, _ = start_rows(batch_msgs)
    firsts = first_launches(rows)
    return firsts.join(seen.select(*DAU_KEY), DAU_KEY, "left_anti").select(*DAU_COLUMNS)


def dau_seen_keys(msgs: DataFrame) -> DataFrame:
    rows, _ = start_rows(msgs)
    return rows.select(*DAU_KEY).distinct()


def weekly_run_date(dt_col="dt") -> F.Column:
    """Processing day of a weekly catch-up run: the Monday after the event week."""
    return F.date_add(F.date_trunc("week", F.to_date(F.col(dt_col))).cast("date"), 7)


def dau_index_by_run_date(msgs: DataFrame, run_date: F.Column | None = None) -> DataFrame:
    """K2 + the reference doc-id rule (Q2): the index is named by the
    processing day and the doc id is ``mid`` alone, so within one run date a
    device keeps only its last written first-launch row."""
    rows, _ = start_rows(msgs)
    firsts = first_launches(rows)
    rd = run_date if run_date is not None else weekly_run_date()
    firsts = firsts.withColumn("run_date", F.date_format(rd, "yyyyMMdd"))
    last = last_per_key(firsts, ["run_date", "mid"], ARRIVAL)
    return last.select(F.concat(F.lit(DAU_INDEX_PREFIX), F.col("run_date")).alias("index_name"),
                       *DAU_COLUMNS)


def dau_upsert(existing: DataFrame, batch_msgs: DataFrame) -> DataFrame:
    """K3: write a batch's first launches into a store keyed by (dt, mid);
    a key already present is replaced by the batch's row (keyed upsert)."""
    rows, _ = start_rows(batch_msgs)
    new = first_launches(rows).select(*DAU_COLUMNS)
    return keyed_upsert(existing.select(*DAU_COLUMNS), new, DAU_KEY)


def dau_filter_counts(msgs: DataFrame) -> DataFrame:
    """A2: rows before and after the dedup, per day.  Two-level aggregation:
    (dt, mid) counts are combined map-side before the day totals."""
    rows, _ = start_rows(msgs)
    per_key = rows.groupBy("dt", "mid").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("dt").agg(F.sum("n").alias("rows_before"),
                                     F.count(F.lit(1)).alias("rows_after"))
