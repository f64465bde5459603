"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the rows must be shuffled again after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Timers and state with expiry need it; state lies on disk, not in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


#: Partitions a shuffle starts with before AQE merges the small ones.
START_PARTITIONS = 400
_START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def split_shuffles(spark: SparkSession) -> None:
    """Let shuffles start with at least ``START_PARTITIONS``, unless the session names a number of its own.

    AQE merges partitions but divides none of a plain join or aggregate, so with few of them a task's share would
    grow with the input.
    """
    if spark.conf.get(_START, None) is None:
        spark.conf.set(_START, str(max(START_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside frees the disk of its shuffles when it ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def apply_settings(spark: SparkSession) -> None:
    """Set the run-time settings the operators rely on in a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def build_session(app: str = "framefold", **extra: str) -> SparkSession:
    """A session with the settings the operators rely on.

    Sizing (executors, memory, shuffle partitions) is left to the cluster; the
    settings below hold at any size. AQE picks post-shuffle partition counts
    from at least ``START_PARTITIONS`` (``split_shuffles``),
    splits skewed join partitions and turns a join into a broadcast only from
    measured sizes.
    """
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    split_shuffles(spark)
    return spark


_OWN_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, for written tables and checkpoints.

    It lies under ``spark.checkpoint.dir``, which belongs to the caller. Where that is unset, as in tests
    on a local master, one folder of this machine serves the application and goes when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        app = spark.sparkContext.applicationId
        if app not in _OWN_FOLDERS:
            _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="framefold-")
            atexit.register(shutil.rmtree, _OWN_FOLDERS[app], ignore_errors=True)
        base = _OWN_FOLDERS[app]
    return f"{base.rstrip('/')}/framefold/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="framefold-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "framefold_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for at, _, names in os.walk(os.path.join(root, "framefold")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
