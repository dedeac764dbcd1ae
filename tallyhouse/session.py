"""Session settings and the shared folder every executor can reach."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files as soon as they end.

    Else these stay until the driver happens to collect its garbage, beside those of every later step.
    What was written is read from the shared folder, so nobody needs them again.
    """
    if str(spark.conf.get(_CLEANUP, "false")).lower() == "true":
        yield
        return
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="run-")
    return _LOCAL_DIRS[app]
