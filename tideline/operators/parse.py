"""Decode topic messages into typed rows.

Malformed text never fails a batch: ``from_json`` yields nulls, and rows that
miss a required field are split off to a rejects frame by ``split_valid``, with
their message and the reason.  Numbers are read through text, so quoted and plain
numbers both count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import schemas as S
from tideline.functions.columns import date_of_datetime, hour_of_datetime

COORDS = ["topic", "partition", "offset"]


def decode(msgs: DataFrame, schema) -> DataFrame:
    """Parse ``value`` with ``schema`` into top-level columns, keeping the
    message and its coordinates.

    The parsed struct goes through a one-row generator (``inline``), which the
    optimizer does not inline into later filters or per-field projections, so
    ``from_json`` runs exactly once per message (a plain projection let the
    validity filter be pushed below it and parse every message again).
    """
    number = (T.NumericType,)
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, number) else f.dataType)
                         for f in schema.fields])
    parsed = msgs.select(*COORDS, "value", F.inline(F.array(F.from_json("value", text))))
    return parsed.select(*COORDS, "value", *[
        F.col(f.name).try_cast(f.dataType).alias(f.name) if isinstance(f.dataType, number) else F.col(f.name)
        for f in schema.fields])


REJECT_COLUMNS = [*COORDS, "value", "reason"]


def missing(**required) -> F.Column:
    """The reason to reject a row: the first required column that is null."""
    out = F.lit(None).cast("string")
    for what, column in reversed(required.items()):
        out = F.when(column.isNull(), f"no {what}").otherwise(out)
    return out


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without a ``reason``, rejects: coordinates, message and reason)."""
    return df.where(F.col("reason").isNull()).drop("reason", "value"), \
        df.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)


def parse_start_log(msgs: DataFrame) -> DataFrame:
    """P1 + flatten ``common``: one row per start-log message.

    Keeps the message coordinates; there is a ``reason`` when the text is not
    JSON, ``common`` is absent, or ``mid`` / ``ts`` is null (SURVEY Q14).
    """
    p = decode(msgs, S.START_LOG)
    return p.select(
        *COORDS, "value",
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
        F.col("common.ar").alias("ar"), F.col("common.ch").alias("ch"),
        F.col("common.vc").alias("vc"), "ts",
    ).withColumn("reason", missing(mid=F.col("mid"), ts=F.col("ts")))


def parse_orders(msgs: DataFrame) -> DataFrame:
    """P5 + P6: typed order rows with ``create_date`` / ``create_hour``.

    Rejected without ``id``, ``user_id`` or ``create_time``.
    """
    p = decode(msgs, S.ORDER_SOURCE)
    return (p.withColumn("create_date", date_of_datetime("create_time"))
             .withColumn("create_hour", hour_of_datetime("create_time"))
             .withColumn("reason", missing(id=F.col("id"), user_id=F.col("user_id"), create_time=F.col("create_time"))))


def parse_cdc_object(msgs: DataFrame) -> DataFrame:
    """P7, object dialect: ``table, type`` and the payload ``data`` as JSON text."""
    return decode(msgs, S.CDC_OBJECT)


def parse_cdc_array(msgs: DataFrame) -> DataFrame:
    """P7, array dialect: ``table, type`` and the payloads ``data``, each as JSON text."""
    return decode(msgs, S.CDC_ARRAY)


def parse_province(msgs: DataFrame) -> DataFrame:
    """Typed province rows, rejected without ``id``."""
    return decode(msgs, S.BASE_PROVINCE).withColumn("reason", missing(id=F.col("id")))
