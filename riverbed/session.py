"""Session construction and shared scratch space.

Scratch data (staged batches, incremental targets built by example queries)
lives under the cluster's shared ``spark.checkpoint.dir``. A local default is
set only when the session has none, as happens in tests.
"""

from __future__ import annotations

import datetime
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins from real shuffle sizes
# (runtime broadcast, skew split, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app: str = "riverbed",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set a local one
    only when the session has none (tests, laptops)."""
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="riverbed-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/riverbed/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test on the cluster's file system (HDFS, object store or
    local), through the Hadoop FileSystem Spark itself uses."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern on the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [st.getPath().toString() for st in found or []]


_LISTING = threading.Lock()


@contextmanager
def shared_listing(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list their folders and files by a few tasks per core.
    Spark's own setting allows 10,000, so nearly every path is a task of its own,
    and starting tasks is then all that a listing of many small files does."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with _LISTING:
        before = spark.conf.get(name)
        spark.conf.set(name, str(max(16, 4 * spark.sparkContext.defaultParallelism)))
        try:
            yield
        finally:
            spark.conf.set(name, before)


def escape_glob(path: str) -> str:
    """A path as a pattern that matches that path alone."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def set_file_time(spark: SparkSession, path: str, when) -> None:
    """Give a file the modification time ``when`` (zone-free UTC), as a copy
    that preserves times does."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    millis = int(when.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(p, millis, -1)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, for a result
    that several branches of a plan read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
