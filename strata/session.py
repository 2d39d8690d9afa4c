"""Session defaults and the shared scratch location.

Everything that has to be written outside a catalog table (landing files,
staged tables, checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``. On a cluster that folder is shared storage, so a
lost executor never takes the only copy with it. Only when the setting is
absent (a bare local test session) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Session with the settings this library is tuned for.

    AQE stays on: it coalesces small shuffle partitions, converts joins whose
    measured side is small into broadcast joins and splits skewed partitions.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_MB = 1024 * 1024


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings sized for the input, for ``build_session(extra=...)``.

    Scans split into ~256 MB tasks. The shuffle starts with one partition per
    ~256 MB of input, at least 2x the cores; AQE then coalesces small partitions to the 256 MB advisory size and splits
    skewed ones (a partition 5x the median and over 512 MB). The Silver
    dedupe and the quality pass shuffle about the projected input, so this
    keeps each reducer's share near the advisory size.
    """
    partitions = max(2 * total_cores, -(-input_bytes // (256 * _MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * _MB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * _MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * _MB),
        "spark.sql.files.maxRecordsPerFile": "50000000",
    }


def input_bytes(spark: SparkSession, locations: list[str]) -> int:
    """Size of the files behind paths, folders or globs (missing ones count 0)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for location in locations:
        path = jvm.org.apache.hadoop.fs.Path(location)
        fs = path.getFileSystem(conf)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(path) or [])
    return total


def apply_scale(spark: SparkSession, size: int) -> None:
    """Set ``scale_settings`` for ``size`` input bytes on a running session."""
    for key, value in scale_settings(size, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first; set our own (a fresh temp folder) only when
    the session has none and runs in local mode (tests). On a cluster a
    missing setting is an error, never a machine-local folder.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder on shared storage: "
                               "scratch data must survive the loss of any one machine")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


# Scratch folders and databases handed out by this process, for release_scratch.
_issued_paths: list[str] = []
_issued_databases: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the scratch root."""
    path = f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex[:12]}"
    _issued_paths.append(path)
    return path


def note_scratch_database(name: str) -> None:
    _issued_databases.append(name)


def release_scratch(spark: SparkSession) -> int:
    """Drop the scratch databases and delete the scratch folders issued so far.

    Only for callers that own the whole lifecycle (benchmarks, test
    sessions): frames returned earlier may still read these files.
    """
    for name in _issued_databases:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _issued_paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    released = len(_issued_paths) + len(_issued_databases)
    _issued_paths.clear()
    _issued_databases.clear()
    return released
