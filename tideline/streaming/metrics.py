"""What each micro-batch read and saved, as a table.

A ``StreamingQueryListener`` takes counts and offsets from the progress that Spark
reports anyway, and a batch write counts its rows by an ``Observation`` while it
writes, so no count job runs.  Each batch is one small JSON file, named by query
and batch, so a replayed batch replaces its own.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tideline.streaming.table import _hadoop, exists

PROGRESS = ("query string, name string, batch long, at string, rows_in long, rows_dropped_late long, observed map<string, map<string, long>>, "
            "sources array<struct<description string, start_offset string, end_offset string, rows long>>")
SAVED = "query string, batch long, output string, rows long"


def counted_write(rows: DataFrame, write) -> int:
    """``write(rows)``, and how many rows it wrote."""
    seen = Observation()
    write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def _put(spark: SparkSession, path: str, row: dict) -> None:
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray((json.dumps(row) + "\n").encode()))
    out.close()


def saved_rows(spark: SparkSession, root: str, query: str, batch_id: int, output: str, rows: int) -> None:
    """A3: note that a batch saved ``rows`` rows in ``output``."""
    _put(spark, f"{root}/saved/{query}-{int(batch_id)}-{output}.json", {"query": query, "batch": batch_id, "output": output, "rows": rows})


class BatchListener(StreamingQueryListener):
    """Writes the progress of each batch that had input below ``root``, of the queries that
    start while it is ``open`` (Spark calls ``onQueryStarted`` before ``start`` returns)."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark, self.root = spark, root
        self.queries: set[str] = set()
        self.open = True

    def onQueryStarted(self, event) -> None:
        if self.open:
            self.queries.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.id) not in self.queries or not p.numInputRows:
            return
        observed = {name: {k: int(v) for k, v in row.asDict().items() if isinstance(v, int)} for name, row in p.observedMetrics.items()}
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        sources = [{"description": s.description, "start_offset": s.startOffset, "end_offset": s.endOffset, "rows": s.numInputRows}
                   for s in p.sources]
        _put(self.spark, f"{self.root}/progress/{p.id}-{p.batchId}.json",
             {"query": str(p.id), "name": p.name, "batch": p.batchId, "at": p.timestamp, "rows_in": p.numInputRows,
              "rows_dropped_late": late, "observed": observed, "sources": sources})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: rows read, rows dropped as late, observed counts, offsets by source."""
    return _table(spark, f"{root}/progress", PROGRESS)


def saved(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch and output: rows saved."""
    return _table(spark, f"{root}/saved", SAVED)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)
