"""Shared helpers of the corpus operators: row identity, saved intermediate
tables, global ranks, connected components and the numpy word kernels that run
inside Arrow tasks."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.llm.ship import ship
from tideline.session import prepare, scratch_path

#: Words of a contract that splits at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
RID = "_tl_rid"
#: Text bytes that one numpy pass takes at a time; a longer text is a pass of its own.
PASS_BYTES = 2 << 20


# ------------------------------------------------------------------ tables
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of ``saved`` tables: those of the open scope, and all others of this process.
_FOLDERS: list[list[str]] = [[]]


def _delete(jvm, conf, paths: list[str]) -> None:
    for p in paths:
        folder = jvm.org.apache.hadoop.fs.Path(p)
        folder.getFileSystem(conf).delete(folder, True)
    paths.clear()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Removes the tables that ``saved`` writes inside, also on failure: write the results
    that read them before it ends.  Outside any scope they stay until Python exits."""
    _FOLDERS.append([])
    try:
        yield
    finally:
        _delete(spark._jvm, spark._jsc.hadoopConfiguration(), _FOLDERS.pop())


def _delete_at_exit(jvm, conf) -> None:
    try:
        for paths in _FOLDERS:
            _delete(jvm, conf, paths)
    except Exception:  # the JVM has gone first: the folders stay
        pass


def saved(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows of ``df`` written as a table below the shared checkpoint folder
    and read again: a lineage cut that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"tideline-llm-{uuid.uuid4().hex}")
    if not any(_FOLDERS):
        atexit.unregister(_delete_at_exit)
        atexit.register(_delete_at_exit, spark._jvm, spark._jsc.hadoopConfiguration())
    _FOLDERS[-1].append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a map-side bitmap at the most (16 MB).
MOST_BITS = 1 << 27


def met_map_side(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``keys``: a bitmap of key hashes
    (64 bits a key, ``MOST_BITS`` at the most) is broadcast, so rows leave before a
    shuffle.  Some that don't belong stay; a join must follow."""
    bits = 1 << 15
    n = keys.count()
    while bits < MOST_BITS and bits < 64 * n:
        bits <<= 1
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    held = F.expr("bitmap_construct_agg(_tl_slot % 32768)").alias("_tl_map")
    maps = keys.select(slot.alias("_tl_slot")).groupBy(F.expr("_tl_slot div 32768").alias("_tl_bucket")).agg(held)
    byte = F.expr("cast(conv(hex(substring(_tl_map, cast(_tl_slot % 32768 div 8 + 1 as int), 1)), 16, 10) as int)")
    met = rows.withColumn("_tl_slot", slot).withColumn("_tl_bucket", F.expr("_tl_slot div 32768")).join(F.broadcast(maps), "_tl_bucket")
    return met.filter(F.getbit(byte, (F.col("_tl_slot") % 8).cast("int")) == 1).drop("_tl_slot", "_tl_bucket", "_tl_map")


def _is_scan(plan) -> bool:
    """Whether a plan is one scan of files, perhaps with columns chosen or rows filtered."""
    if not plan.deterministic():
        return False
    name = plan.getClass().getSimpleName()
    if name in ("Project", "Filter"):
        return _is_scan(plan.children().head())
    return name == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"


def with_rid(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with a row id that is the same in every evaluation.  A scan of files deals
    them into the same partitions each time, so the position in the scan serves;
    anything else is saved first."""
    ship(docs.sparkSession)
    df = docs.select(*columns) if columns else docs
    if not _is_scan(docs._jdf.queryExecution().optimizedPlan()):
        df = saved(df)
    return df.withColumn(RID, F.monotonically_increasing_id())


def global_rank(df: DataFrame, order: list[str], out: str = "rank") -> DataFrame:
    """``df`` (narrow rows) with its 0-based position in the total order of
    ``order``.  Rows are range-partitioned and sorted, so equal leading keys are
    split too; only one row per partition meets in the offset step."""
    placed = saved(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_tl_part", F.spark_partition_id())
                   .withColumn("_tl_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = placed.groupBy("_tl_part").agg(F.count("*").alias("_tl_n"))
    before = Window.orderBy("_tl_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tl_part", F.coalesce(F.sum("_tl_n").over(before), F.lit(0)).alias("_tl_off"))
    return placed.join(offsets, "_tl_part").withColumn(out, F.col("_tl_off") + F.col("_tl_at")) \
        .drop("_tl_part", "_tl_at", "_tl_off")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of an edge list over longs: the smallest node that links
    reach.  Each round takes the smallest label among a node's neighbours (a
    map-side combined minimum) and then the label of that label; lineage is cut
    every round."""
    a, b = F.col(a), F.col(b)
    ends = F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in ((a, b), (b, a), (a, a), (b, b))])
    both = saved(edges.select(F.inline(ends)).distinct())
    labels = saved(both.groupBy("u").agg(F.min("v").alias("l")))
    while True:
        # a node is a neighbour of its own: its label comes along, without a join
        step = both.join(labels.select(F.col("u").alias("v"), F.col("l").alias("vl")), "v") \
            .groupBy("u").agg(F.max(F.when(F.col("u") == F.col("v"), F.col("vl"))).alias("l"), F.min("vl").alias("m"))
        jump = labels.select(F.col("u").alias("m"), F.col("l").alias("ml"))
        new = saved(step.join(jump, "m").select("u", F.least("m", "ml").alias("l"), (F.least("m", "ml") < F.col("l")).alias("moved")))
        if new.filter("moved").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("l").alias("component"))
        labels = new.select("u", "l")


# ------------------------------------------------------- numpy word kernels
_rng = np.random.default_rng(20240607)
BYTE_KEYS = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
STEP = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)

SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INV, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PASS_BYTES
    while size < n:
        size *= 2
    return _powers(size)


def text_passes(column: pa.Array | pa.ChunkedArray, most: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, row offsets) for runs of whole texts of about
    ``most`` bytes; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, at, values = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes with ``word_byte`` set; runs end with their row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = word_byte[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def prefix_hash(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """Running polynomial hash of the bytes (``fold`` maps bytes first)."""
    keys = BYTE_KEYS if fold is None else BYTE_KEYS[fold]
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(keys[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes anywhere."""
    down = powers(len(prefix))[1]
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes, by doubling: a run twice
    as long is hashed from its two halves (overlapping when ``k`` is odd)."""
    if k == 1:
        return words
    half = (k + 1) // 2
    part = window_hash(words, half)
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix64(part[:n] * STEP[0] + part[k - half:k - half + n] * STEP[1] + np.uint64(k))


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def emit(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
