"""Session settings and the shared working area for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from daylake.errors import NoSharedFolder

# Settings that change results or plans.  Cluster sizing (executors, memory,
# initial shuffle partitions) belongs to the submit configuration.
SESSION_SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Recording the Python call site of every expression costs a third of the time
    # it takes to build a query; it only adds context to error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "daylake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; ``conf`` (dots as ``__``) overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_dir(spark: SparkSession, label: str) -> str:
    """A new, unused directory name below the folder that all machines share.

    That folder is the one in ``spark.checkpoint.dir``, or the one given to
    ``setCheckpointDir``.  Only a session that runs on one machine (``local[...]``)
    may go without; it gets a temporary folder.  Elsewhere a missing folder is an
    error: executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise NoSharedFolder(
                f"under master {master} staged tables need a shared folder; name one in "
                "spark.checkpoint.dir"
            )
        root = tempfile.mkdtemp(prefix="daylake-")
    return f"{root.rstrip('/')}/daylake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage: later actions read the written files, so neither a second
    action nor a lost executor repeats the work upstream of this point.
    """
    return _write_and_read(df, working_dir(df.sparkSession, label), compression)


def _write_and_read(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    options = {"compression": compression} if compression else {}
    df.write.mode("error").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`stage` for the length of a block; the files are removed after it."""
    spark = df.sparkSession
    path = working_dir(spark, label)
    try:
        yield _write_and_read(df, path)
    finally:
        context = spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
