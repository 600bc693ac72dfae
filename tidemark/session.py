"""Session factory and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

#: Applied when the session does not set them itself.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_spark(app: str = "tidemark", master: str | None = None, catalog: dict[str, str] | None = None, **conf: str) -> SparkSession:
    """One factory for every entry point; `catalog` holds the options of an external table catalog, if its jars are there.

    The session is proved usable by a trivial query; a failure is raised, never turned into a process exit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **(catalog or {}), **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sql("SELECT 1").collect()
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a folder of this machine only in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isDefined():
        return made.get().rstrip("/")
    local = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def work_dir(spark: SparkSession, what: str) -> str:
    """A new folder of its own in the shared folder; it goes when the session's JVM ends, as results are read from it until then."""
    at = f"{shared_dir(spark)}/tidemark/{what}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return at


def sweep(spark: SparkSession, older_than_s: float = 7 * 86400) -> list[str]:
    """Delete work folders of sessions that were killed and could not do it themselves."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    before = (time.time() - older_than_s) * 1000
    gone = [s.getPath() for s in fs.listStatus(root) if s.getModificationTime() < before]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.toString() for p in gone)
