"""SparkSession helpers: session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every livemart job relies on.  The session time zone pins the
# date/hour strings derived from epoch milliseconds; AQE re-plans joins and
# shuffle partition counts from runtime sizes and splits skewed partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs a shuffle for an aggregate on
    # top that relied on the join's partitioning (only when skew is detected)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per batch instead of uploading a snapshot each time
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "livemart", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with livemart's defaults.

    On a cluster pass ``master=None`` and leave the master to spark-submit;
    size ``shuffle_partitions`` to the data (about 128-256 MB per partition
    after the map-side combine, see ``cluster_conf``) -- AQE then coalesces
    small ones.  Without it Spark's own setting stays.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Only a local
    master (tests) may run without it: then a fresh scratch folder is
    created and set.  On a cluster a machine-local folder would not survive
    the loss of that machine, so an unset value is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3) "
                               "for checkpoints and intermediate tables")
        root = tempfile.mkdtemp(prefix="livemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique location under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "livemart", *parts, uuid.uuid4().hex])


def cluster_conf(total_cores: int, input_bytes: int, target_partition_bytes: int = 256 << 20,
                 max_partitions: int | None = None) -> dict:
    """Shuffle sizing for a cluster run.

    Starts with enough shuffle partitions that each holds about
    ``target_partition_bytes`` of the *input* (an upper bound: map-side
    combining only shrinks it), at least three waves of the cluster's cores,
    and lets AQE coalesce small partitions back to the target and split
    skewed ones.  ``max_partitions`` (none unless given) bounds the count
    where the driver's bookkeeping of map outputs is short of memory; the
    partitions then grow and spill.  Pass the
    result as ``extra=`` to ``build_session`` or to spark-submit ``--conf``.
    """
    by_size = -(-int(input_bytes) // int(target_partition_bytes))
    partitions = max(by_size, 3 * int(total_cores), 1)
    if max_partitions is not None:
        partitions = min(partitions, max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(min(target_partition_bytes, 256 << 20)),
    }
