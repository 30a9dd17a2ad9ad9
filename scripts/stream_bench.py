"""Stream bench: replay sf-scale messages as time-ordered micro-batches (one
file per batch) through each stream job and report rows/s and p50/p95 batch
duration (``triggerExecution`` of StreamingQueryProgress).

    python scripts/stream_bench.py [sf_dir]     (writes under a fresh /tmp folder)
"""
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tideline.plans import params as P  # noqa: E402
from tideline.session import build_session  # noqa: E402
from tideline.sources import messages as M  # noqa: E402
from tideline.streaming import jobs  # noqa: E402
from tideline.streaming.io import MESSAGE_COLUMNS, message_file_stream  # noqa: E402


def write_splits(frame, split_col, path):
    keys = sorted(r[0] for r in frame.select(split_col).distinct().collect())
    for k in keys:
        frame.where(F.col(split_col) == k).select(*MESSAGE_COLUMNS).coalesce(1).write.mode("append").parquet(path)
    return len(keys)


def stats(progress):
    data = [p for p in progress if p["numInputRows"] > 0]
    durs = sorted(p["durationMs"]["triggerExecution"] / 1000 for p in data)
    rows = sum(p["numInputRows"] for p in data)
    p95 = lambda ds: round(sorted(ds)[min(len(ds) - 1, int(0.95 * len(ds)))], 3)
    in_order = [p["durationMs"]["triggerExecution"] / 1000 for p in data]
    quarter = max(1, len(in_order) // 4)
    return {"batches": len(durs), "rows": rows, "rows_per_sec": round(rows / max(sum(durs), 1e-9), 1),
            "p50_batch_sec": round(statistics.median(durs), 3), "p95_batch_sec": p95(durs),
            "p50_by_quarter": [round(statistics.median(in_order[i * quarter:(i + 1) * quarter]), 3) for i in range(len(in_order) // quarter)][:4],
            "p95_last_quarter": p95(in_order[-quarter:])}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    which = set(sys.argv[2:]) or {"dau", "orders"}
    spark = build_session("local[8]", 8, extra={
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.numRecentProgressUpdates": "1000"})
    spark.sparkContext.setLogLevel("ERROR")
    d = tempfile.mkdtemp(prefix="tideline-stream-bench-")
    out = {}

    # DAU: one batch per event day.
    ev = M.start_log_messages(spark, sf, with_batch=True)
    n = write_splits(ev, "batch_id", f"{d}/start") if "dau" in which else 0
    for form in (("watermark", "exact") if "dau" in which else ()):
        src = message_file_stream(spark, f"{d}/start")
        if form == "watermark":
            q = jobs.start_dau_watermark(src, f"{d}/dau_{form}", f"{d}/ck_{form}", {"availableNow": True})
        else:
            q = jobs.start_dau_exact(spark, src, f"{d}/dau_{form}", f"{d}/ck_{form}", {"availableNow": True})
        q.awaitTermination(1800)
        out[f"dau_{form}"] = stats(q.recentProgress)

    # Orders: one batch per order month.
    if "orders" not in which:
        print(json.dumps({"sf": os.path.basename(sf.rstrip("/")), "day_files": n, "streams": out}))
        return
    rows = M.order_info_rows(spark, sf)
    msgs = M.order_messages(spark, sf, rows=rows).join(
        rows.select(F.col("id").cast("string").alias("key"), F.substring("create_time", 1, 7).alias("ym")), "key")
    write_splits(msgs, "ym", f"{d}/orders")
    M.province_rows(spark, sf, missing_region=P.MISSING_REGION).write.parquet(f"{d}/prov")
    M.user_rows(spark, sf, missing_segment=P.MISSING_SEGMENT).write.parquet(f"{d}/users")
    for form, start in (("orders_state_store", jobs.start_stateful_orders), ("orders_tables", jobs.start_orders)):
        extra = {"compact_every": 24} if form == "orders_tables" else {}
        q = start(spark, message_file_stream(spark, f"{d}/orders"), f"{d}/{form}", f"{d}/ck_{form}",
                  f"{d}/prov", f"{d}/users", {"availableNow": True}, as_of=P.AS_OF, **extra)
        q.awaitTermination(3600)
        out[form] = stats(q.recentProgress)
    print(json.dumps({"sf": os.path.basename(sf.rstrip("/")), "day_files": n, "streams": out}))
    spark.stop()


if __name__ == "__main__":
    t = time.time()
    main()
    print(f"elapsed {time.time() - t:.0f}s", file=sys.stderr)
