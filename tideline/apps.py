"""Run the streaming apps against Kafka topics.

    python -m tideline.apps dau    --bootstrap H:9092 --out /warehouse/dau [--form exact|day|late|watermark|ttl]
    python -m tideline.apps orders --bootstrap H:9092 --out /warehouse/orders \\
                                   --provinces /warehouse/dim/province --users /warehouse/dim/user
    python -m tideline.apps cdc    --bootstrap H:9092 --out /warehouse/ods [--dialect object|array]
    python -m tideline.apps dim    --bootstrap H:9092 --out /warehouse/dim/province

Checkpoints default to ``<spark.checkpoint.dir>/<app>``; the Kafka connector
must be on the classpath (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version>``).
"""

from __future__ import annotations

import argparse

from tideline.functions import schemas as S
from tideline.session import build_session, scratch_path
from tideline.sources import messages as M
from tideline.streaming import jobs, metrics
from tideline.streaming.io import console_sink, kafka_batch_writer, kafka_stream
from tideline.streaming.state import use_state_store

TOPICS = {"dau": M.START_TOPIC, "orders": M.ORDER_TOPIC, "dim": M.PROVINCE_TOPIC,
          "cdc:object": M.CDC_OBJECT_TOPIC, "cdc:array": M.CDC_ARRAY_TOPIC}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tideline.apps")
    ap.add_argument("app", choices=["dau", "orders", "cdc", "dim"])
    ap.add_argument("--bootstrap", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--topic")
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--trigger-seconds", type=int, default=5)
    ap.add_argument("--group-id", help="consumer group of the source")
    ap.add_argument("--as-of", help="orders: ages as of this day (default: the day a batch runs)")
    ap.add_argument("--gender-rule", choices=["standard", "swapped"], default="standard")
    ap.add_argument("--rejects", help="folder for messages that can't be used (default: <out>_rejects)")
    ap.add_argument("--print", action="store_true", dest="show", help="also print the decoded messages, up to 1000 rows a batch")
    ap.add_argument("--form", choices=["watermark", "exact", "ttl", "day", "late"], default="exact",
                    help="dau: exact keeps all devices, day forgets a day 7 days after its last event (state store), "
                         "ttl a device 7 days after its last event, watermark drops events older than 7 days, "
                         "late writes those to <out>_late")
    ap.add_argument("--metrics", help="folder for the counts and offsets of each batch (default: <out>_metrics)")
    ap.add_argument("--index", help="dau, exact form: folder of the index by processing day (default: <out>_index)")
    ap.add_argument("--run-date", help="dau: processing day yyyyMMdd of the index (default: the day a batch runs)")
    ap.add_argument("--user-state", help="orders: a user-state table that a new checkpoint starts from")
    ap.add_argument("--dialect", choices=["object", "array"], default="object")
    ap.add_argument("--provinces")
    ap.add_argument("--users")
    ap.add_argument("--publish", action="store_true",
                    help="orders: also send wide orders to DW_ORDER_INFO; cdc: write to the ODS_T_* topics")
    return ap


def start(a: argparse.Namespace, spark, msgs, checkpoint: str) -> list:
    """The app's queries over ``msgs``.  What each batch read and saved goes to the metrics
    folder (A2, A3, S6)."""
    folder = a.metrics or a.out.rstrip("/") + "_metrics"

    def saved_rows(output: str, batch_id: int, rows: int) -> None:
        metrics.saved_rows(spark, folder, spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none", batch_id, output, rows)

    listener = metrics.BatchListener(spark, folder)
    spark.streams.addListener(listener)
    try:
        queries = _start(a, spark, msgs, checkpoint, saved_rows)
        if a.show:  # K12, beside the app
            queries.append(console_sink(msgs, checkpoint + "-print", _trigger(a)))
        return queries
    finally:
        listener.open = False


def _trigger(a: argparse.Namespace) -> dict:
    return {"processingTime": f"{a.trigger_seconds} seconds"} if a.trigger_seconds else {"availableNow": True}


def _start(a: argparse.Namespace, spark, msgs, checkpoint: str, saved_rows) -> list:
    trig = _trigger(a)
    rejects = a.rejects or a.out.rstrip("/") + "_rejects"
    if a.app == "dau":
        if a.form == "exact":
            return [jobs.start_dau_exact(spark, msgs, a.out, checkpoint, trig, rejects=rejects, saved=saved_rows,
                                         index=a.index or a.out.rstrip("/") + "_index", run_date=a.run_date)]
        if a.form == "day":
            return [jobs.start_dau_by_day(spark, msgs, a.out, checkpoint, trig, rejects=rejects, saved=saved_rows)]
        if a.form == "late":
            return [jobs.start_dau_with_late(spark, msgs, a.out, checkpoint, a.out.rstrip("/") + "_late", rejects, trigger=trig,
                                             saved=saved_rows)]
        bad = jobs.start_dau_rejects(msgs, rejects, checkpoint + "-rejects", trig)
        if a.form == "watermark":
            return [jobs.start_dau_watermark(msgs, a.out, checkpoint, trig), bad]
        from tideline.streaming.dau_state import dau_ttl_stream
        use_state_store(spark)
        return [dau_ttl_stream(msgs).writeStream.format("parquet").option("path", a.out)
                .option("checkpointLocation", checkpoint).partitionBy("dt").trigger(**trig).start(), bad]
    if a.app == "orders":
        extra = {}
        if a.publish:
            extra["sink"] = jobs.publish_wide_orders(kafka_batch_writer(a.bootstrap), M.WIDE_ORDER_TOPIC)
        seed = spark.read.schema(S.USER_STATE).parquet(a.user_state) if a.user_state else None
        return [jobs.start_stateful_orders(spark, msgs, a.out, checkpoint, a.provinces, a.users, trig, seed=seed, as_of=a.as_of,
                                           gender_rule=a.gender_rule, saved=saved_rows, **extra)]
    if a.app == "cdc":
        return [jobs.start_cdc_route(msgs, a.out, checkpoint, a.dialect, trig, kafka_bootstrap=a.bootstrap if a.publish else None),
                jobs.start_cdc_rejects(msgs, rejects, checkpoint + "-rejects", a.dialect, trig)]
    return [jobs.start_dim(spark, msgs, a.out, checkpoint, trig, rejects=rejects)]


def main(argv=None) -> None:
    ap = parser()
    a = ap.parse_args(argv)
    if a.app == "orders" and not (a.provinces and a.users):
        ap.error("orders needs --provinces and --users")

    spark = build_session(app_name=f"tideline-{a.app}")
    key = f"cdc:{a.dialect}" if a.app == "cdc" else a.app
    msgs = kafka_stream(spark, a.bootstrap, a.topic or TOPICS[key], a.starting_offsets, group_id=a.group_id)
    ck = a.checkpoint or scratch_path(spark, f"{a.app}-{a.form if a.app == 'dau' else a.dialect}")
    start(a, spark, msgs, ck)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
