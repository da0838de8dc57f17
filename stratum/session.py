"""Session builder and the shared scratch location for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "stratum",
                conf: dict[str, str] | None = None, *, input_bytes: int | None = None,
                total_cores: int | None = None) -> SparkSession:
    """Builder with UTC session time, AQE and skew-join handling on.

    With ``input_bytes`` and ``total_cores``, shuffles and splits are sized
    for them (:func:`scale_conf`; ``conf`` still has the last word).

    ANSI mode stays at Spark's default (on); operators use ``try_cast`` /
    ``try_divide`` where the source semantics need NULL instead of an error.
    """
    sized = scale_conf(input_bytes, total_cores) if input_bytes and total_cores else {}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, *, shuffle_fraction: float = 0.3,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and split sizing for a run over ``input_bytes`` of Parquet.

    ``shuffle_fraction`` is the expected shuffle volume relative to the
    input (the unclustered microdata aggregate is the worst case: roughly
    the projected columns).  The initial shuffle partition count targets
    ``target_partition_bytes`` per partition -- never fewer than 3 waves of
    the cores -- and AQE coalesces small ones afterwards; skewed partitions
    are split by the skew-join and rebalance rules.
    """
    shuffle_bytes = max(int(input_bytes * shuffle_fraction), 1)
    partitions = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


class NoSharedFolderError(RuntimeError):
    def __init__(self):
        super().__init__("set spark.checkpoint.dir to a folder that the driver and all executors share")


def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise NoSharedFolderError()
    path = tempfile.mkdtemp(prefix="stratum-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written intermediates.

    Uses the session's checkpoint directory (``spark.checkpoint.dir``).  If
    none is configured, a ``local`` master gets a fresh one (driver and
    executors are one process there); a cluster raises, since a folder of the
    driver's machine is not where its executors write.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise NoSharedFolderError()
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        folder = configured or _local_folder(sc.master)
        sc.setCheckpointDir(folder)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique location under :func:`shared_dir` for one run.  What is
    written there can be read until this process ends, which removes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(remove_scratch)
    _scratch.append(path)
    return path


_scratch: list[str] = []


def remove_scratch() -> None:
    """Delete this process's scratch locations, on whatever file system."""
    from pyspark import SparkContext
    jvm = SparkContext._jvm
    while _scratch:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            where = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
            where.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)
