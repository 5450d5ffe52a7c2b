"""Session construction and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a production run wants. AQE re-plans joins from real shuffle sizes
# (broadcast only what turns out small, split skewed partitions, coalesce tiny
# ones), so the static partition count is just an upper bound per stage.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # the reference raised the broadcast threshold to 100 MB; Catalyst and AQE
    # only broadcast a side whose estimated / measured size is below it
    "spark.sql.autoBroadcastJoinThreshold": str(100 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.orc.compression.codec": "snappy",
}


def shuffle_width(input_gb: float | None) -> int | None:
    """Shuffle partitions for an input of that many GB: about 128 MB each, 200 at least; None leaves Spark's setting."""
    return None if input_gb is None else max(200, round(input_gb * 8))


def build_session(master: str | None = None, app: str = "coursewise",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written intermediates and sink round trips.

    It is the session's checkpoint directory (``spark.checkpoint.dir``). A
    cluster must name one; only a local-mode session without one gets a
    private folder (as in tests), which is then registered as its checkpoint
    directory so ``DataFrame.checkpoint()`` uses the same place.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. Spark Connect: only the configuration is visible
        sc = None
    d = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this job")
    d = tempfile.mkdtemp(prefix="coursewise-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
