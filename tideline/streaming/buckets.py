"""A keyed table whose upsert rewrites only what it touches.

Rows lie in Parquet partitions by a hash of their key (below further partition
columns, if any).  A batch reads the partitions that its keys fall into, merges,
and replaces those by Spark's dynamic partition overwrite; the rest is neither
read nor written.

The merged partitions are first written whole to ``_pending/<query>-<batch>``, and the
overwrite reads them from there.  An overwrite that was cut short is repeated from
that folder before anything else happens: by the replay of its batch, or by the
next batch of another query.  A replay finds its merge there and doesn't merge twice.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.rank import last_per_key
from tideline.streaming.table import _hadoop, complete, exists

PART = "part"


class BucketTable:
    """``keys`` identify a row within the ``by`` partition columns; ``parts`` partitions by key hash."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], parts: int = 64,
                 by: list[str] | None = None):
        self.spark, self.root, self.schema, self.keys, self.parts = spark, root, schema, list(keys), parts
        self.by = list(by or [])
        rest = [f for f in schema.fields if f.name not in self.by]
        self._whole = T.StructType([*rest, *[schema[b] for b in self.by], T.StructField(PART, T.IntegerType())])

    def _read(self, path: str) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], self._whole)
        return self.spark.read.schema(self._whole).option("basePath", path).parquet(path)

    def read(self) -> DataFrame:
        return self._read(self.root).select(*self.schema.fieldNames())

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def _replace(self, pending: str) -> None:
        self._read(pending).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*self.by, PART).parquet(self.root)
        fs, done = _hadoop(self.spark, os.path.join(pending, "_done"))
        fs.create(done, True).close()

    def _unfinished(self) -> list[str]:
        """Whole merges whose overwrite did not end."""
        fs, folder = _hadoop(self.spark, os.path.join(self.root, "_pending"))
        paths = [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return [p for p in paths if complete(self.spark, p) and not exists(self.spark, os.path.join(p, "_done"))]

    def upsert(self, rows: DataFrame, query: str, batch_id: int, order: list[str] | None = None) -> int:
        """The newest row per key wins: of ``rows`` the last by ``order`` (without one, the
        largest), then any row of ``rows`` over a stored one.  Returns how many partitions
        the batch touched."""
        for path in self._unfinished():
            self._replace(path)
        pending = os.path.join(self.root, "_pending", f"{query}-{int(batch_id)}")
        if complete(self.spark, pending):  # a replay
            return 0
        new = self._placed(rows).persist()
        own = [*self.by, PART]
        touched = new.select(*own).distinct()
        n = touched.count()
        if n:
            keys = [*self.by, *self.keys]
            last = last_per_key(new, keys, order or [c for c in self.schema.fieldNames() if c not in keys]).select(*self._whole.fieldNames())
            # the partitions to read are named, so that the scan prunes the others
            hit = [tuple(r) for r in touched.collect()]
            there = self._read(self.root).where(" OR ".join(
                "(" + " AND ".join(f"{c} <=> {_literal(v)}" for c, v in zip(own, row)) + ")" for row in hit))
            kept = there.join(last.select(*keys), keys, "left_anti")
            kept.unionByName(last).repartition(*[F.col(c) for c in own]).write.mode("overwrite").partitionBy(*own).parquet(pending)
            self._replace(pending)
            self._forget(pending)
        new.unpersist()
        return n

    def _forget(self, latest: str) -> None:
        """Drop merges that were put in place, but for the latest, which a replay looks for."""
        fs, folder = _hadoop(self.spark, os.path.join(self.root, "_pending"))
        for s in fs.listStatus(folder):
            p = s.getPath()
            if p.getName() != os.path.basename(latest) and exists(self.spark, os.path.join(p.toString(), "_done")):
                fs.delete(p, True)


def _literal(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
