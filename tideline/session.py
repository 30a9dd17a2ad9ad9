"""Session construction and the few session-level settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs depend on for correct results (dates are rendered in UTC,
# see SURVEY Q13) and for scale (AQE re-plans joins and splits skewed keys).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tideline", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the cluster
    defaults win.  Local tests pass ``local[N]`` and a small partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Remove reliable checkpoint files once their DataFrame is garbage-collected.
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    prepare(spark)
    return spark


# Frames kept by the query that runs now, per application.
_KEPT: dict[str, list] = {}


def keep(df):
    """Persist ``df`` (memory, then disk) for a query that reads it from several
    places, so its source is scanned and parsed once.  It is released when the
    next query prepares, or by ``release``; a lost executor only means that its
    part is computed again."""
    _KEPT.setdefault(df.sparkSession.sparkContext.applicationId, []).append(df.persist())
    return df


def release(spark: SparkSession) -> None:
    for df in _KEPT.pop(spark.sparkContext.applicationId, []):
        df.unpersist()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings a query needs on a session someone else built,
    and release what the query before kept."""
    release(spark)
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to a shared file system.  Only when it
    is unset (local tests) do we create a private folder under the temp dir.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tideline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (state tables, stream checkpoints)."""
    return os.path.join(checkpoint_dir(spark), *parts)


def cluster_conf(shuffle_bytes: float, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings sized for a cluster run, so each shuffle partition fits
    executor memory without spilling heavily.

    ``shuffle_bytes``: the largest shuffle a job writes (after projection and
    map-side partial aggregation; for the order job about the projected
    order rows).  Partitions start at ~``target_partition_mb`` each (at least
    two waves of tasks); AQE then coalesces small ones and splits skewed ones.
    """
    target = target_partition_mb * 1024 * 1024
    n = max(2 * total_cores, int(shuffle_bytes // target) + 1)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target),
        # Joins broadcast only what AQE measured below this size at run time.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
