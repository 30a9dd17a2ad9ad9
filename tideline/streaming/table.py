"""A keyed table on plain parquet, one version per micro-batch.

No transactional table format is installed, so an upsert writes a complete
new version directory ``v=<batch_id>`` and then appends ``batch_id`` to a
small commit log (itself a parquet table).  Readers take the newest committed
version, and a batch always builds on the newest version *before* its own id,
so a replayed batch (after a failure between the write and the checkpoint
commit) rewrites its own version from the same input: the result is
idempotent.  A folder that was written completely is never written again, so
nothing is overwritten while it may be read.  A folder that does not exist is an
empty table; any other failure to read fails the batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType(), False)])


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists; a store that can't be asked raises."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder ended."""
    return exists(spark, os.path.join(path, "_SUCCESS"))


def claim(spark: SparkSession, root: str, batch_id: int) -> None:
    """Note which streaming query writes batch ``batch_id`` below ``root``.  Batch ids start
    at 0 again with a new checkpoint; such a query must not pass for a replay of the one
    before it, so a batch that another query wrote is an error."""
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    fs, folder = _hadoop(spark, os.path.join(root, "_runs", f"batch={int(batch_id)}"))
    others = [s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName() != run] if fs.exists(folder) else []
    if others:
        raise RuntimeError(f"batch {batch_id} of {root} was written by query {others[0]}, not by {run}: "
                           "go on from that query's checkpoint or write to another folder")
    fs.mkdirs(_hadoop(spark, os.path.join(root, "_runs", f"batch={int(batch_id)}", run))[1])


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 partition_by: list[str] | None = None):
        self.spark, self.root, self.schema = spark, root, schema
        self.partition_by = partition_by or []

    # -- paths
    def _log(self) -> str:
        return os.path.join(self.root, "_commits")

    def _version(self, batch_id: int) -> str:
        return os.path.join(self.root, f"v={batch_id}")

    # -- reads
    def committed_before(self, batch_id: int | None = None) -> int | None:
        """Newest committed version id (below ``batch_id`` when given)."""
        if not exists(self.spark, self._log()):  # no commit yet
            return None
        log = self.spark.read.schema(_LOG_SCHEMA).parquet(self._log())
        if batch_id is not None:
            log = log.where(F.col("batch_id") < batch_id)
        row = log.agg(F.max("batch_id").alias("m")).first()
        return None if row is None or row["m"] is None else int(row["m"])

    def read(self, before: int | None = None) -> DataFrame:
        """The newest committed version (below ``before``), or an empty frame."""
        v = self.committed_before(before)
        if v is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._version(v))

    # -- writes
    def commit(self, df: DataFrame, batch_id: int) -> None:
        """Write ``df`` as version ``batch_id`` and record the commit; a replay of a
        committed batch changes nothing."""
        claim(self.spark, self.root, batch_id)
        if exists(self.spark, self._log()) and self.spark.read.schema(_LOG_SCHEMA).parquet(self._log()) \
                .where(F.col("batch_id") == batch_id).limit(1).count():
            return
        w = df.select(*self.schema.fieldNames()).write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self._version(batch_id))
        (self.spark.createDataFrame([(int(batch_id),)], _LOG_SCHEMA)
             .coalesce(1).write.mode("append").parquet(self._log()))


class IncrementTable:
    """An append-only table of per-batch increments: ``root/batch_id=<n>/``.

    A batch's increment is written once: a replay finds it complete and leaves it,
    or else writes it anew, so writes are idempotent.  Structured Streaming starts batch ``n`` only after batch
    ``n - 1``'s ``foreachBatch`` returned, so every increment below ``n`` is
    complete when batch ``n`` reads.  Writes cost O(batch), never O(table).
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 partition_by: list[str] | None = None):
        self.spark, self.root, self.schema = spark, root, schema
        self.partition_by = partition_by or []
        self._read_schema = T.StructType(
            list(schema.fields) + [T.StructField("batch_id", T.LongType(), True)])
        # This object is the table's only writer: the snapshot list changes only
        # through compact().
        self._snapshots: list[int] | None = None

    # -- compaction: snapshots live under "_snapshots" (a "_" folder is not
    # listed as table data), their commit log under "_snapshots_log".
    def _snap(self, upto: int) -> str:
        return os.path.join(self.root, "_snapshots", f"upto={int(upto)}")

    def _snapshot_before(self, before: int | None) -> int | None:
        if self._snapshots is None:
            path = os.path.join(self.root, "_snapshots_log")
            # The log has one row per compaction: a small, bounded list.
            self._snapshots = sorted({r["batch_id"] for r in self.spark.read.schema(_LOG_SCHEMA).parquet(path)
                                      .distinct().collect()}) if exists(self.spark, path) else []
        ok = [u for u in self._snapshots if before is None or u < before]
        return ok[-1] if ok else None

    def _increments(self) -> DataFrame | None:
        if not exists(self.spark, self.root):
            return None
        return self.spark.read.schema(self._read_schema).option("basePath", self.root).parquet(self.root)

    def _increments_between(self, lo: int, hi: int) -> DataFrame | None:
        """Increments with lo < batch_id < hi, listing only those folders (a
        brace glob), so the listing stays bounded however long the history."""
        ids = ",".join(str(i) for i in range(lo + 1, hi))
        if not ids:
            return None
        fs, glob = _hadoop(self.spark, os.path.join(self.root, f"batch_id={{{ids}}}"))
        there = fs.globStatus(glob)
        if there is None or not len(there):  # none of those batches wrote an increment
            return None
        return self.spark.read.schema(self._read_schema).option("basePath", self.root) \
            .parquet(*[s.getPath().toString() for s in there])

    def read(self, before: int | None = None) -> DataFrame:
        """All rows written below batch ``before``, with their ``batch_id``:
        the newest snapshot below ``before`` plus the increments after it."""
        upto = self._snapshot_before(before)
        if upto is not None and before is not None:
            inc = self._increments_between(upto, before)
        else:
            inc = self._increments()
        lo = F.lit(True) if upto is None else F.col("batch_id") > upto
        hi = F.lit(True) if before is None else F.col("batch_id") < before
        parts = []
        if inc is not None:
            parts.append(inc.where(lo & hi))
        if upto is not None:
            snap = self._snap(upto)
            parts.append(self.spark.read.schema(self.schema).option("basePath", snap).parquet(snap)
                         .withColumn("batch_id", F.lit(upto).cast("long")))
        if not parts:
            return self.spark.createDataFrame([], self._read_schema)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def compact_if_due(self, batch_id: int, every: int | None, keys=None) -> None:
        """Compact when ``every`` batches or more have passed since the last snapshot,
        whether or not this batch had rows."""
        if every and batch_id > 0 and batch_id - (self._snapshot_before(None) or 0) >= every:
            self.compact(batch_id, keys)

    def compact(self, upto: int, keys=None) -> None:
        """Fold everything written up to batch ``upto`` into one snapshot
        (newest row per key when ``keys`` are given, else all rows), so later
        reads scan the snapshot plus a few increments instead of the whole
        history.  Safe to rerun; increments are left for a retention job."""
        df = self.latest(keys, before=upto + 1) if keys else self.read(before=upto + 1)
        w = df.select(*self.schema.fieldNames()).write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self._snap(upto))
        (self.spark.createDataFrame([(int(upto),)], _LOG_SCHEMA).coalesce(1)
             .write.mode("append").parquet(os.path.join(self.root, "_snapshots_log")))
        self._snapshots = None

    def latest(self, keys, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Newest row per key over the increments (below ``before``).

        ``only``: a frame of keys; increments are semi-joined to it *before*
        ranking, so a small batch ranks only its own keys' history (the
        optimizer does not push a semi join below the ranking window).
        """
        from tideline.operators.rank import last_per_key
        df = self.read(before)
        if only is not None:
            df = df.join(only.select(*keys).distinct(), list(keys), "left_semi")
        return last_per_key(df, keys, ["batch_id"]).drop("batch_id")

    def write(self, df: DataFrame, batch_id: int) -> int:
        """Write the batch; how many rows it has."""
        from tideline.streaming.metrics import counted_write
        claim(self.spark, self.root, batch_id)
        path = os.path.join(self.root, f"batch_id={int(batch_id)}")
        if complete(self.spark, path):  # a replay: the same rows are there
            return self.spark.read.schema(self.schema).parquet(path).count()
        return counted_write(df.select(*self.schema.fieldNames()),
                             lambda rows: rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path))


def current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A dimension as it stands: the newest version of a versioned table, or the rows
    of a plain or a bucketed one."""
    if exists(spark, os.path.join(path, "_commits")):
        return VersionedTable(spark, path, schema).read()
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
