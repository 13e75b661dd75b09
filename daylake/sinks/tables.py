"""Writing day-partitioned tables.

Replacement works by partition: the partitions present in the incoming rows are
replaced, all others stay.  The overwrite mode is fixed where it takes effect (per
write for paths, per table for catalog tables), never left to the session: under
static mode the same statement would delete the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from daylake.schemas import conform
from daylake.sources.tables import Table

_FILE_PROVIDERS = {"parquet", "orc"}


def lay_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Rows shuffled to their partitions for writing.

    The rebalance hint sizes the write tasks at run time: small partitions share a
    task, and a partition holding much of the data is split over many, so no task
    or file grows with the largest partition.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return spread.sortWithinPartitions(*partition_by, *sort_by)


def quoted(name: str) -> str:
    """A table or database name with each of its parts in backquotes."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ensure_table(spark: SparkSession, table: Table) -> None:
    """Create database and table if they do not exist (nothing to do for a path)."""
    if not table.name:
        return
    database = table.name.rsplit(".", 1)[0] if "." in table.name else None
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    parts = ", ".join(f"`{c}`" for c in table.partition_by)
    statement = [f"CREATE TABLE IF NOT EXISTS {quoted(table.name)} ({columns}) USING {table.provider}"]
    if table.provider in _FILE_PROVIDERS:
        statement.append("OPTIONS (partitionOverwriteMode 'dynamic')")
    statement.append(f"PARTITIONED BY ({parts})")
    if table.bucket_by:
        clustered = ", ".join(f"`{c}`" for c in table.bucket_by)
        ordered = ", ".join(f"`{c}`" for c in table.sort_by)
        statement.append(f"CLUSTERED BY ({clustered}) SORTED BY ({ordered}) INTO {table.buckets} BUCKETS")
    if table.path:
        statement.append(f"LOCATION {text_literal(table.path)}")
    spark.sql(" ".join(statement))


def _write_catalog_table(df: DataFrame, table: Table) -> None:
    spark = df.sparkSession
    ensure_table(spark, table)
    if table.provider not in _FILE_PROVIDERS:
        df.writeTo(table.name).overwritePartitions()
        return
    if not _is_dynamic(spark, table):
        raise ValueError(
            f"table {table.name} would be overwritten as a whole: create it with "
            "OPTIONS (partitionOverwriteMode 'dynamic') or set the session's mode"
        )
    # insertInto matches by position; partition columns come last in the catalog.
    df.select(*spark.read.table(table.name).columns).write.insertInto(table.name, overwrite=True)


def _is_dynamic(spark: SparkSession, table: Table) -> bool:
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "STATIC")
    if mode.lower() == "dynamic":
        return True
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table.name)}")
    storage = detail.where(F.col("col_name") == "Storage Properties").select("data_type").head()
    return bool(storage) and "partitionoverwritemode=dynamic" in storage[0].lower()


def replace_partitions(df: DataFrame, table: Table, *, keep_layout: bool = False) -> None:
    """Create the table if missing; replace exactly the partitions present in ``df``.

    An empty ``df`` changes nothing.  With ``keep_layout`` rows are written by the
    tasks that hold them, without a shuffle: right for map-only steps over an input
    that is already laid out by the same partition.
    """
    rows = conform(df, table.schema)
    if table.bucket_by:
        # By the hash that buckets go by: a bucket is written by one task, as one file in
        # each partition.
        rows = rows.repartition(table.buckets, *table.bucket_by)
    elif not keep_layout:
        rows = lay_out(rows, table.partition_by, table.sort_by)
    if table.name:
        _write_catalog_table(rows, table)
        return
    (
        rows.write.format(table.provider)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*table.partition_by)
        .save(table.path)
    )


def export_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, keep_layout: bool = False
) -> None:
    """Parquet copy of ``df``; with partition columns only their days are replaced.

    ``keep_layout`` as in :func:`replace_partitions`.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    (
        (df if keep_layout else lay_out(df, partition_by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def persist(
    df: DataFrame,
    table: Table,
    *,
    export_path: str | None = None,
    export_partition_by: Sequence[str] = (),
    keep_layout: bool = False,
) -> None:
    """Replace the table's partitions, then export the same rows if asked.

    Callers whose ``df`` is expensive pass a staged frame, so that the second write
    does not repeat it.
    """
    replace_partitions(df, table, keep_layout=keep_layout)
    if export_path:
        export_parquet(df, export_path, export_partition_by, keep_layout=keep_layout)


def write_samples(samples: DataFrame, path: str) -> None:
    """Contract samples, one directory per suite and partition."""
    (
        samples.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("suite", "partition_key")
        .parquet(path)
    )


def drop_days(df: DataFrame, table: Table) -> None:
    """Remove the table's partitions of the days in ``df`` (bounded by the calendar)."""
    (by,) = table.partition_by
    if not table.name:
        drop_day_folders(df, table.path, by)
        return
    days = [r[0] for r in df.select(by).distinct().collect()]
    if not days:
        return
    parts = ", ".join(f"PARTITION (`{by}` = DATE '{day}')" for day in days)
    df.sparkSession.sql(f"ALTER TABLE {quoted(table.name)} DROP IF EXISTS {parts}")
    if table.path:
        drop_day_folders(df, table.path, by)


def drop_day_folders(df: DataFrame, path: str, column: str = "ingest_date") -> None:
    """Remove the folders ``column=day`` below ``path`` for the days in ``df``.

    Days are bounded by the calendar, so the driver may hold them.  Missing folders
    are fine.
    """
    context = df.sparkSession.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(root):
        return
    for row in df.select(column).distinct().collect():
        store.delete(context._jvm.org.apache.hadoop.fs.Path(root, f"{column}={row[0]}"), True)
