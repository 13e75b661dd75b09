"""Helpers shared by the operators: shipping the package, blocks of texts, new columns."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from daylake.session import stage

#: Characters of text that a Python worker works on at once (a longer single text is
#: a block of its own).
BLOCK_CHARS = 4_000_000


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors (once per session).

    The sources are zipped and handed to ``addPyFile``; the driver serves them, so
    executors need no installed copy and no shared folder.
    """
    context = spark.sparkContext
    if getattr(context, "_daylake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="daylake-py-"), "daylake_src.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    context._daylake_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def crc32_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id's decimal text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id)


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether the id's crc32 has that remainder; a null id is never held out."""
    return F.coalesce(crc32_of_id(doc_id) % modulus == remainder, F.lit(False))


def blocks(sizes: Sequence[int], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``limit`` at most, one item at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_CHARS
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches, of ``limit`` bytes of text or one text, with the texts as
    UTF-8 bytes."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for start, stop in blocks(lengths, limit):
            yield batch.slice(start, stop - start), texts.slice(start, stop - start)


#: Rows of a few keys that are sent to all tasks at most (some ten megabytes).
SENT_ROWS = 200_000


def sent_if_small(keys: DataFrame, label: str, limit: int = SENT_ROWS) -> DataFrame:
    """``keys`` (a few numbers a row), written once and counted: up to ``limit`` rows a join
    sends them to the other side's tasks, beyond that it shuffles; the rows are the same."""
    stored = stage(keys, label)
    return F.broadcast(stored) if stored.count() <= limit else stored


def add_from_text(
    df: DataFrame,
    fields: Sequence[tuple[str, str, pa.DataType]],
    make: Callable[[], Callable[[pa.Array], Sequence]],
    text: str = "text",
) -> DataFrame:
    """``df`` with columns computed from its text, in one pass without a shuffle.

    ``fields`` are (name, Spark type, Arrow type); a column of ``df`` that has one of
    these names is replaced.  ``make`` is called once per task and returns the
    function from a block of texts to the new columns.
    """
    new = {name.lower() for name, _, _ in fields}
    kept = [c for c in df.columns if c.lower() not in new or c == text]
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    if text.lower() in new:
        raise ValueError("a new column would replace the text")
    added = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind, _ in fields))
    schema = StructType([*source.schema.fields, *added.fields])
    arrow = [(name, kind) for name, _, kind in fields]

    def run(batches):
        work = make()
        for part, texts in text_blocks(batches, text):
            made = work(texts)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(a, kind) for a, (_, kind) in zip(made, arrow)]],
                names=[*part.schema.names, *[name for name, _ in arrow]],
            )

    return source.mapInArrow(run, schema)
