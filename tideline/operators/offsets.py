"""Offset bookkeeping (S3-S6, F7, K11) for topic-shaped inputs.

A structured stream keeps its progress in the checkpoint; these operators
cover the reference's explicit ledger: per-batch offset ranges, the ledger of
committed until-offsets, and the rows a resumed consumer still has to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.rank import last_per_key

LEDGER_KEY = ["group_id", "topic", "partition"]


def offset_ranges(msgs: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Per batch and partition, ``from_offset`` (first read) and
    ``until_offset`` (one past the last read), plus the row count."""
    return (msgs.groupBy(batch_col, "topic", "partition")
                .agg(F.min("offset").alias("from_offset"),
                     (F.max("offset") + 1).alias("until_offset"),
                     F.count(F.lit(1)).alias("n_rows")))


def ledger_after(ranges: DataFrame, group_id: str, batch_col: str = "batch_id",
                 existing: DataFrame | None = None) -> DataFrame:
    """K11 + F7: the ledger after committing ``ranges`` batch by batch.

    A batch writes the until-offset of its partitions only when it advanced
    (``from < until``); the last such write per partition stands.
    """
    prog = (ranges.where(F.col("from_offset") < F.col("until_offset"))
                  .select(F.lit(group_id).alias("group_id"), "topic", "partition",
                          "until_offset", F.col(batch_col).alias("_b")))
    latest = last_per_key(prog, LEDGER_KEY, ["_b"]).drop("_b")
    if existing is None:
        return latest
    # A ledger never moves backwards.
    both = existing.select(*LEDGER_KEY, "until_offset").unionByName(latest)
    return both.groupBy(*LEDGER_KEY).agg(F.max("until_offset").alias("until_offset"))


def resume_rows(msgs: DataFrame, ledger: DataFrame, group_id: str, missing: str = "earliest") -> DataFrame:
    """Rows a consumer of ``group_id`` reads when it resumes.

    A partition with a ledger entry resumes at its until-offset; one without
    starts at the earliest offset, or reads nothing when ``missing='latest'``
    (the reference default for a group without saved offsets).  The ledger has
    one row per topic partition, so AQE broadcasts it once it has measured it.
    """
    led = ledger.where(F.col("group_id") == group_id) \
        .select("topic", "partition", F.col("until_offset").alias("_start"))
    j = msgs.join(led, ["topic", "partition"], "left")
    if missing == "latest":
        cond = F.col("_start").isNotNull() & (F.col("offset") >= F.col("_start"))
    elif missing == "earliest":
        cond = F.col("offset") >= F.coalesce(F.col("_start"), F.lit(0))
    else:
        raise ValueError("missing must be 'earliest' or 'latest'")
    return j.where(cond).drop("_start")


def kafka_starting_offsets(ledger_rows) -> str:
    """Render collected ledger rows (one per partition, so a bounded list) as
    the Kafka source's ``startingOffsets`` JSON."""
    import json
    out: dict = {}
    for r in ledger_rows:
        out.setdefault(r["topic"], {})[str(r["partition"])] = int(r["until_offset"])
    return json.dumps(out, sort_keys=True)
