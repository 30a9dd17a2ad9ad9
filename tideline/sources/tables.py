"""Table scans over the parquet warehouse."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; passing ``columns`` keeps the scan's ReadSchema narrow
    (Catalyst would prune anyway, this documents intent)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Give a source at least ``min_partitions`` splits (default: the default
    parallelism), like the Kafka source's ``minPartitions``.  A source with fewer is
    repartitioned by hash of ``key``, so a recomputed task sees the same rows after
    an executor loss; any other keeps its scan splits."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n, key)
