"""Session settings the jobs rely on, and where they may put intermediate files."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

MIB = 1024 * 1024
TARGET_FILE_BYTES = 256 * MIB

# Partition sizes, and the counts above which partitions grow instead: every map task meets every
# shuffle partition, so both counts must stay bounded for the largest inputs.
SCAN_BYTES = 128 * MIB
MAX_SCAN_TASKS = 200_000
SHUFFLE_BYTES = 256 * MIB
MAX_SHUFFLE_PARTITIONS = 20_000

# Zone names, dates and hashes are defined in UTC. Skew handling must also apply where
# splitting a hot join partition costs one more shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort for a shuffled join whose partitions all turn out this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Without the call-site capture of each column function, plans are built several times faster.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# What ``prepare`` has set, by application and key: anything else was set by the user, and stays.
_own_settings: dict[tuple[str, str], str] = {}
_local_scratch: dict[str, str] = {}


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session; object-store settings go in as ``spark.hadoop.*`` keys."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, paths: list[str] | None = None) -> SparkSession:
    """Apply the runtime settings; with ``paths``, size scans and shuffles for those inputs.

    A setting that the user has set in this session stays as it is.

    Shuffles never start with fewer partitions than the session asks for: adaptive execution
    merges small partitions later, but cannot refine a shuffle that began too coarse.
    """
    settings = dict(RUNTIME_SETTINGS)
    if paths:
        size = input_bytes(spark, paths)
        wanted = min(math.ceil(size / SHUFFLE_BYTES), MAX_SHUFFLE_PARTITIONS)
        configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            max(wanted, configured)
        )
        settings["spark.sql.files.maxPartitionBytes"] = str(
            max(SCAN_BYTES, math.ceil(size / MAX_SCAN_TASKS))
        )
    application = spark.sparkContext.applicationId
    given = spark.conf.getAll
    for key, value in settings.items():
        if key in given and given[key] not in (value, _own_settings.get((application, key))):
            continue
        if given.get(key) != value:
            spark.conf.set(key, value)
        _own_settings[application, key] = value
    return spark


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Stored size of files or directories, from the file system's own summary."""
    return sum(_path_bytes(spark, path) for path in paths)


def _path_bytes(spark: SparkSession, path: str) -> int:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getContentSummary(location).getLength()


def files_for(total_bytes: int, at_least: int) -> int:
    """How many output files keep each near the target size."""
    return max(at_least, math.ceil(total_bytes / TARGET_FILE_BYTES))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path every executor can reach, below the folder in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to the machine's temporary folder.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch; frames read from there end with it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def _scratch_root(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if application not in _local_scratch:
            _local_scratch[application] = tempfile.mkdtemp(prefix="kerbside-")
        shared = _local_scratch[application]
    return f"{shared.rstrip('/')}/kerbside/{application}"
