"""Session construction and shared-storage locations.

The library never invents a machine-local folder on a cluster: intermediate
tables and streaming checkpoints live under ``spark.checkpoint.dir`` as the
cluster names it.  Only a local-mode session without that setting (tests,
laptops) gets a private temporary folder.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "threadlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured for the jobs in this package.

    AQE stays on so that partition counts, join strategies and skewed join
    partitions are re-planned from runtime sizes; the session zone is pinned to
    UTC (all time math in ``functions.timefmt`` is zone-free anyway).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a job over ``input_bytes`` of input.

    The initial shuffle partition count is at least twice the cores and about
    one partition per ``partition_bytes`` of input, so that every reducer's
    share fits in executor memory before AQE coalesces small partitions to
    the advisory size.  Scan splits and the skew threshold use the same unit;
    a larger ``partition_bytes`` means fewer, larger shuffle blocks.
    """
    n = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, wiring it into the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset, a
    local-mode session gets a fresh temporary folder; a cluster session raises,
    because a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or \
        spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(HDFS / object store) before running these jobs on a cluster")
        root = tempfile.mkdtemp(prefix="threadlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root.  Its folder is
    removed when the session's JVM ends (a result may read it until then)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    folder = f"{root}/threadlens/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{folder}/data"
