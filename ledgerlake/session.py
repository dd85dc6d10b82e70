"""Session construction and shared-storage locations.

On a cluster the session is built by the platform; ``get_session`` returns
an active session untouched and only builds one (with these defaults) when
none exists, as in tests and the benchmark.
Scratch and checkpoint data live under ``spark.checkpoint.dir`` (a shared
folder every executor can reach); a local default is set only when the
session has none, as in tests.
"""

from __future__ import annotations

import hashlib
import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the pipeline relies on, used when ``get_session`` builds a session.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # one write as several tables opens a writer a kind instead of sorting the rows
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "ledgerlake",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session, or build one with the pipeline defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def _in_one_process(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local-cluster`` has its own executors)."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Read from ``spark.checkpoint.dir`` (conf) or the SparkContext. Only when
    neither is set (local tests) a folder under the system temp dir is
    created and registered, so later calls and ``DataFrame.checkpoint`` agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not _in_one_process(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")  # the setting itself can't be changed
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _ensure_local(path: str) -> str:
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return _ensure_local(f"{root}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}")


def run_dir(spark: SparkSession, name: str, *keys: str) -> str:
    """A stable folder for this application and ``keys`` under the shared
    checkpoint root: rebuilding overwrites it instead of leaving a copy."""
    root = checkpoint_root(spark)
    tag = hashlib.sha1("|".join(keys).encode()).hexdigest()[:12] if keys else "run"
    return _ensure_local(f"{root}/ledgerlake/{name}-{app_id(spark)}-{tag}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, from the file listing (no content is read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def input_state(spark: SparkSession, path: str) -> int:
    """A number that changes when files under ``path`` appear, go or change
    (from the listing: name, length, time)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return int(files.agg(F.coalesce(F.sum(one), F.lit(0))).first()[0])


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 ** 2,
                 block_bytes: int = 64 * 1024) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on ``total_cores``.

    A shuffle of all rows between as many map as reduce tasks makes
    (input / target)^2 blocks of target^2 / input bytes, so the target grows
    with the root of the input once blocks would fall under ``block_bytes``.
    Scan splits and shuffle partitions share it; sorts spill in large runs
    and AQE merges what turns out smaller. Example: 100 TB on 8,000 cores
    gives 2.7 GB a partition, about 41,000 partitions.
    """
    target = max(16 * 1024 ** 2, int(target_partition_bytes),
                 math.isqrt(int(input_bytes) * block_bytes))
    partitions = max(2 * total_cores, -(-int(input_bytes) // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.maxConcurrentOutputFileWriters": DEFAULT_CONF["spark.sql.maxConcurrentOutputFileWriters"],
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        # broadcast only what AQE measured at run time to be small; the
        # planner's estimate (compressed file size) is not a proven bound
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
