"""Session settings the library relies on, and a local builder for tests and the bench.

Library functions never build a session; callers pass theirs.  ``configure`` applies
the runtime SQL settings that make the plans scale (AQE with skew-join splitting and
partition coalescing, UTC session time); ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir`` and only falls back to a scratch
folder in local mode (tests).
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

# Runtime-settable SQL confs; sized for a large cluster, harmless on local[8].
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; beyond that, fall back
    # from whole-stage codegen to per-operator code instead of running interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # broadcast only what is proven small: no plan-time broadcast from file-size estimates
    # (compressed Parquet can be far larger in memory); AQE still converts a join to a
    # broadcast at runtime from the measured shuffle size, and fiscalflow.operators.joins
    # broadcasts a side after counting it.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
}


# invoice XML files are a few KB: at the default 4 MB open cost a 128 MB scan task
# would hold ~32 files; 64 KB packs ~2,000 per task
SMALL_FILES = {"spark.sql.files.openCostInBytes": "65536"}

# Added on a shared, busy cluster (``configure(spark, cluster=True)``): coalesce shuffle
# partitions to the advisory size instead of to the core count.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    **SMALL_FILES,
}
ADVISORY_BYTES = 128 << 20

# of the Parquet files the library writes: message text takes about half of what it takes with the default codec
CODEC = {"compression": "zstd"}
# of staged rows, which are read whole and once or twice: dictionaries and bounds of message text cost more than its parsing
STAGED = {**CODEC, "parquet.enable.dictionary": "false", "parquet.column.statistics.enabled": "false", "parquet.size.statistics.enabled": "false"}


# shuffle files go when the action that made them ends, not whenever the driver's garbage is collected
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Queries started inside run with ``values``; the session's own settings come back after."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def frees_shuffles(job: Callable) -> Callable:
    """The actions of a job (its first argument is the session) leave no shuffle files.  For jobs that write each frame once: a frame that is
    collected a second time makes its shuffles again."""
    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with settings(spark, FREED):
            return job(spark, *args, **options)

    return run


def initial_partitions(shuffle_bytes: int) -> int:
    """Shuffle partitions to begin with, of the advisory size for the largest shuffle expected;
    AQE only ever merges them.  At most 100,000, beyond which map outputs get too many blocks."""
    return max(200, min(100_000, -(-shuffle_bytes // ADVISORY_BYTES)))


def configure(spark: SparkSession, extra: dict[str, str] | None = None, cluster: bool = False,
              shuffle_bytes: int = 10 << 40) -> SparkSession:
    """``shuffle_bytes``: the largest shuffle expected, used with ``cluster``."""
    conf = {**SCALE_CONF, **(CLUSTER_CONF if cluster else {}), **(extra or {})}
    if cluster:
        conf.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions(shuffle_bytes)))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a scratch folder only in local mode with none configured."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="fiscalflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the machine's own (or a mounted) file system, None if it lies in another one."""
    fs, p = _file_system(spark, path)
    return p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, in whatever file system holds it."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders and files directly below a folder, as full paths."""
    fs, p = _file_system(spark, path)
    return sorted(f.getPath().toString() for f in fs.listStatus(p))


def create_empty_file(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.create(p).close()


def rename_folder(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _file_system(spark, old)
    if not fs.rename(p, _file_system(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "fiscalflow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench (never used inside the library)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
