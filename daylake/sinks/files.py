"""Data files that a table does not reference."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daylake.operators.days import SAFETY_HORIZON, safety_cutoff
from daylake.sinks.tables import quoted, text_literal
from daylake.sources.tables import Table


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, modificationTime, length`` of the files below ``root`` (no contents read)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "modificationTime", "length")
    )


def live_files(table: DataFrame) -> DataFrame:
    """Paths of the files a table's scan reads, from the listing that the scan holds on
    the driver; no file is opened.  For path tables of moderate size; for a catalog table
    :func:`stray_files` lists by tasks.

    That listing spells paths percent-encoded, a listing of a folder does not.
    """
    spark = table.sparkSession
    listed = spark.createDataFrame([(path,) for path in table.inputFiles()], "path string")
    return listed.select(F.url_decode(F.regexp_replace("path", r"\+", "%2B")).alias("path"))


def orphan_files(
    files: DataFrame,
    live: DataFrame,
    as_of: datetime,
    horizon: timedelta = SAFETY_HORIZON,
) -> DataFrame:
    """Files not in ``live`` that were last changed before ``as_of`` - ``horizon``."""
    old = files.where(F.col("modificationTime") < F.lit(safety_cutoff(as_of, horizon)))
    known = live.select(_normal("path").alias("_live"))
    return old.join(known, _normal("path") == F.col("_live"), "left_anti")


def _normal(path: str) -> Column:
    """One spelling for local paths (``file:/x``, ``file:///x``)."""
    return F.regexp_replace(F.col(path), "^([a-z][a-z0-9+.-]*):/{3}", "$1:/")


# ---------------------------------------------------------------- by folders


def _subfolders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path`` (none where it is missing), without hidden ones."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    found = [s.getPath() for s in store.listStatus(root) if s.isDirectory()]
    return [p.toString() for p in found if not p.getName().startswith((".", "_"))]


def day_folders(spark: SparkSession, table: Table) -> list[str]:
    """All folders that hold a day of the table, also those of audited writes beside it:
    one a day and write, which is all that the driver lists."""
    (by,) = table.partition_by
    roots = [table.path, *_subfolders(spark, f"{table.path.rstrip('/')}_loads")]
    return [f for root in roots for f in _subfolders(spark, root) if f"/{by}=" in f]


def registered_folders(spark: SparkSession, table: Table) -> list[str]:
    """The folders that the catalog's partitions point at: one metadata call a day."""
    name, out = quoted(table.name), []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
        column, value = spec.split("=", 1)
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION (`{column}` = {text_literal(value)})")
        # The partition's place comes first, then the table's.
        out.append(next(r.data_type for r in detail.collect() if r.col_name == "Location"))
    return out


def _listed(batches):
    """Files below each folder, by the store's own listing; no file is opened."""
    import pandas as pd
    from urllib.parse import quote

    from pyarrow import fs

    for batch in batches:
        for folder, layer, day in batch[["folder", "layer", "day"]].itertuples(index=False):
            store, name = fs.FileSystem.from_uri(quote(_uri(folder), safe=":/"))
            found = [
                (f.path, f.mtime, f.size)
                for f in store.get_file_info(fs.FileSelector(name, recursive=True, allow_not_found=True))
                if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))
            ]
            scheme = folder.split(":", 1)[0]
            yield pd.DataFrame(
                {
                    "layer": layer,
                    "day": day,
                    "path": pd.Series([f"{scheme}:{p}" if scheme == "file" else f"{scheme}://{p}" for p, _, _ in found], dtype=object),
                    "modificationTime": pd.Series([m for _, m, _ in found], dtype="datetime64[us, UTC]"),
                    "length": pd.Series([n for _, _, n in found], dtype="int64"),
                }
            )


def files_of(spark: SparkSession, folders: list[tuple[str, str]]) -> DataFrame:
    """``layer, day, path, modificationTime, length`` of the files below the given
    ``(layer, folder)`` pairs, listed by the tasks, a folder at a time."""
    rows = [(f, layer, f.rstrip("/").rsplit("=", 1)[-1]) for layer, f in folders]
    given = spark.createDataFrame(rows, "folder string, layer string, day string")
    spread = given.repartition(max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism)))
    return spread.mapInPandas(
        _listed, "layer string, day string, path string, modificationTime timestamp, length long"
    )


def stray_files(
    spark: SparkSession, table: Table, as_of: datetime, horizon: timedelta = SAFETY_HORIZON
) -> DataFrame:
    """Files of a catalog table's folders that no partition points at, last changed before
    ``as_of`` - ``horizon``.

    A table without a log of its own reads every file of its partitions' folders, so only
    the other folders are listed.  Of files the driver holds nothing.
    """
    live = {_folder_key(f) for f in registered_folders(spark, table)}
    stray = [f for f in day_folders(spark, table) if _folder_key(f) not in live]
    found = files_of(spark, [("", f) for f in stray])
    return found.where(F.col("modificationTime") < F.lit(safety_cutoff(as_of, horizon)))


def _folder_key(folder: str) -> str:
    """One spelling of a folder: listings and catalogs differ in slashes and escapes."""
    from urllib.parse import unquote

    scheme, _, rest = folder.partition(":")
    return f"{scheme}:/{unquote(rest).strip('/')}" if rest else f"file:/{unquote(folder).strip('/')}"


def partition_inventory(spark: SparkSession, tables: Mapping[str, Table]) -> DataFrame:
    """``layer, observation_date, files, bytes`` of every day that a layer stores."""
    folders = [(layer, f) for layer, table in tables.items() for f in day_folders(spark, table)]
    found = files_of(spark, folders)
    return found.groupBy("layer", F.to_date("day").alias("observation_date")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


# Names pyarrow gives to the same stores (fixed values).
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _uri(path: str) -> str:
    """A listed path as a full URI (listings shorten ``file:///x`` to ``file:/x``)."""
    scheme, rest = path.split(":", 1)
    rest = rest if rest.startswith("//") else f"//{rest}"
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def _delete_batches(batches):
    from urllib.parse import quote

    from pyarrow import fs

    for batch in batches:
        for path in batch["path"]:
            store, name = fs.FileSystem.from_uri(quote(_uri(path), safe=":/"))
            try:
                store.delete_file(name)
            except FileNotFoundError:
                pass  # an earlier attempt of this task removed it
        yield batch


def delete_files(orphans: DataFrame) -> int:
    """Remove the reported files, on the executors; returns how many were reported."""
    return orphans.select("path").mapInPandas(_delete_batches, "path string").count()
