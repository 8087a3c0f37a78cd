"""Session helpers: a local session for tests, and where runs may write."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Runtime settings every run of this library wants. The JVM never compiles a
# method over 8000 bytes of bytecode; above that size Spark had better split
# the generated code (wide JSON rows reach it) than keep one method per stage.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


_LOCAL_FOLDERS: dict[str, str] = {}  # by application, for local sessions without a shared folder


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Small enough parts that a task can sort its rows in memory, however few shuffle partitions the session has: 128 MB of a
# compressed file may be millions of rows. Adaptive execution joins what is small.
LARGE_SORTS = {
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Some settings, put back at the end."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def large_sorts(spark: SparkSession) -> Iterator[None]:
    """Settings for writes that sort whole large tables; cached rows are not for it, as their parts are not joined."""
    with settings(spark, LARGE_SORTS):
        yield


def local_session(cores: int | str = 8, app: str = "rillmart") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return apply_settings(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return _LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="rillmart-"))
    raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path for one bounded run; expiring old ones is up to the cluster."""
    return f"{shared_folder(spark).rstrip('/')}/rillmart/{name}-{uuid.uuid4().hex}"
