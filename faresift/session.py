"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Wall-clock columns are zone-free; the zone only matters for files with zoned timestamps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A scan task usually sees one or two source files, so it can keep a writer open for each
    # and need not sort its rows by target folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Plans here have hundreds of column expressions: do not look up the caller for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Names of scratch folders begin like this.
SCRATCH_PREFIXES = ("faresift-", "llm-")


def get_session(app_name: str = "faresift", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared scratch folder that the cluster names.

    Only a session without ``spark.checkpoint.dir`` on a local master gets a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="faresift-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """A new folder path under the shared scratch folder."""
    return f"{work_root(spark)}/faresift-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, min_age_hours: float = 168.0) -> list[str]:
    """Remove folders that this library left in the shared scratch folder and that were not written to for so long.

    Results that were returned lazily read such folders, so choose an age that outlives every job.
    """
    root, fs = hadoop_path(spark, work_root(spark))
    removed = []
    for status in fs.listStatus(root):
        place, age = status.getPath(), time.time() - status.getModificationTime() / 1000
        if place.getName().startswith(SCRATCH_PREFIXES) and age >= min_age_hours * 3600:
            fs.delete(place, True)
            removed.append(place.toString())
    return removed


def hadoop_path(spark: SparkSession, path: str):
    """(Path, FileSystem) of Hadoop for a path in any storage Spark can reach."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
