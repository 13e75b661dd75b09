"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosine checks.

Unit vectors are projected on random (normal, hence 2-stable) directions, shifted and
cut into cells of a fixed width; the cells of ``hashes`` projections are one table's
bucket.  Vectors that share a bucket in any of ``tables`` tables are compared exactly.

Equal vectors are one node with a weight.  A bucket with more than ``block`` nodes is
cut into blocks, and every pair of blocks is a piece of work of its own.  Buckets are
dealt by number first; vectors follow only into buckets of several nodes, and of buckets
with the same nodes only into the first.  A pair that shares several buckets counts in the
first of them, so that only a number per vector and one link per vector and piece leave a
task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daylake.llm.components import connected_components, local_roots
from daylake.session import stage


def _projections(dim: int, tables: int, hashes: int, width: float, seed: int):
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * hashes)), rng.uniform(0, width, tables * hashes)


def bucket_keys(
    vectors: np.ndarray, labels: np.ndarray, *, tables: int, hashes: int, width: float, seed: int
) -> np.ndarray:
    """(rows, tables) 64-bit bucket numbers of vectors of one dimension."""
    dim = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    directions, shift = _projections(dim, tables, hashes, width, seed)
    cells = np.floor((unit @ directions + shift) / width).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(vectors), tables, hashes)
    key = np.zeros((len(vectors), tables), np.uint64)
    place = np.arange(tables, dtype=np.uint64)[None, :] + np.uint64(dim) * np.uint64(1 << 20) + np.uint64(1)
    for part in [place, labels.astype(np.int64).astype(np.uint64)[:, None], *np.moveaxis(cells, 2, 0)]:
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def usable(label: str = "label", embedding: str = "embedding"):
    """Whether a row can link: a label, a vector without null or non-finite components,
    and some component that is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        F.col(label).isNotNull()
        & F.col(embedding).isNotNull()
        & F.forall(embedding, finite)
        & F.exists(embedding, lambda x: x != 0)
    )


def _signed(batches: Iterator[pa.RecordBatch], options: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        sizes = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy().astype(np.float64)
        starts = np.cumsum(sizes) - sizes
        labels = batch.column(2).to_numpy()
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            vectors = flat[starts[rows, None] + np.arange(dim)]
            keys = bucket_keys(vectors, labels[rows], **options)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(3).take(pa.array(rows)),
                    pa.array(labels[rows]),
                    pa.array(list(vectors), pa.list_(pa.float64())),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ],
                names=["node", "weight", "label", "vector", "keys"],
            )


def _compare(
    table: int, left: tuple, right: tuple, same: bool, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs that share no bucket of an earlier table."""
    (x, kx, lx), (y, ky, ly) = left, right
    close = (x @ y.T >= threshold) & (lx[:, None] == ly[None, :])
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    if table and len(i):
        new = ~(kx[i, :table] == ky[j, :table]).any(axis=1)
        return i[new], j[new]
    return i, j


def _pieces(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pieces of work, sorted by (key, one, two): link counts and spanning links."""

    def result(u, v, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], names=["u", "v", "links"]
        )

    def work(rows: pa.Table) -> pa.RecordBatch:
        us, vs, ns = [], [], []
        ids = np.stack([rows.column(c).to_numpy() for c in ("key", "one", "two")], 1)
        cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [len(ids)]]))
        for at, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            piece = rows.slice(at, size)
            node, weight, label, own, table = (
                piece.column(c).to_numpy() for c in ("node", "weight", "label", "own", "table")
            )
            vectors = piece.column("vector").combine_chunks()
            dim = len(vectors[0])
            x = vectors.flatten().to_numpy().reshape(size, dim)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            keys = piece.column("keys").combine_chunks().flatten().to_numpy().reshape(size, -1)
            one, two = ids[at, 1], ids[at, 2]
            a = np.flatnonzero(own == one)
            b = np.flatnonzero(own == two)
            i, j = _compare(
                int(table[0]), (x[a], keys[a], label[a]), (x[b], keys[b], label[b]), one == two, threshold
            )
            if not len(i):
                continue
            i, j = a[i], b[j]
            counts = np.bincount(i, weight[j], size) + np.bincount(j, weight[i], size)
            hit = np.flatnonzero(counts)
            us.append(node[hit])
            vs.append(np.full(len(hit), -1))
            ns.append(counts[hit].astype(np.int64))
            root = local_roots(size, i, j)
            linked = np.flatnonzero(root != np.arange(size))
            us.append(node[linked])
            vs.append(node[root[linked]])
            ns.append(np.zeros(len(linked), np.int64))
        return result(*(np.concatenate(c) if c else [] for c in (us, vs, ns)))

    held: pa.Table | None = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = new if held is None else pa.concat_tables([held, new])
        if not held.num_rows:
            continue
        ids = np.stack([held.column(c).to_numpy() for c in ("key", "one", "two")], 1)
        other = np.flatnonzero((ids != ids[-1]).any(axis=1))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield work(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield work(held)


def near_vectors(
    rows: DataFrame,
    *,
    threshold: float = 0.93,
    tables: int = 20,
    hashes: int = 12,
    width: float = 2.0,
    block: int = 512,
    seed: int = 7,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row (vec_id, embedding, label).

    Only rows with equal, non-null labels and vectors of one dimension are compared.
    Rows that cannot link (see :func:`usable`) have no links and are their own
    component.  Rows with equal vectors and labels link with each other; repeated rows
    count as rows.  A null vec_id never names a component unless all of it are null.
    With the default tables, vectors at the threshold itself meet with probability
    0.95, those at cosine 0.95 with 0.99; links found are always exact.
    """
    options = {"tables": tables, "hashes": hashes, "width": width, "seed": seed}
    source = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("long").alias("label"),
    )
    good = source.where(usable())
    nodes = good.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("weight")
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    signed = stage(
        nodes.select("node", "embedding", "label", "weight").mapInArrow(
            lambda batches: _signed(batches, options),
            "node long, weight long, label long, vector array<double>, keys array<long>",
        ),
        "signed-vectors",
    )
    dealt = signed.select("node", F.posexplode("keys").alias("table", "key"))
    # Near vectors share many buckets, so of buckets with the same nodes the first one does.
    same = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"same{k}") for k in (0, 1)]
    buckets = (
        dealt.groupBy("key")
        .agg(F.min("table").alias("table"), F.count("*").alias("n"), *same)
        .where(F.col("n") > 1)
        .groupBy("n", "same0", "same1")
        .agg(F.min_by("key", F.struct("table", "key")).alias("key"))
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("cuts"))
    )
    cut = dealt.join(stage(buckets, "buckets"), "key")
    own = F.pmod(F.xxhash64("node", F.lit(seed)), F.col("cuts")).cast("int")
    paired = (
        cut.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("one", F.least("own", "other"))
        .withColumn("two", F.greatest("own", "other"))
        .join(signed, "node")
        .select("key", "one", "two", "own", "table", "node", "weight", "label", "vector", "keys")
    )
    work = paired.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    found = stage(
        work.mapInArrow(lambda batches: _pieces(batches, threshold), "u long, v long, links long"),
        "vector-links",
    )
    counts = found.where("v < 0").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("v >= 0").select("u", "v"))
    named = (
        nodes.join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    ids = named.groupBy("root").agg(F.min("first_id").alias("_component"))
    known = named.join(ids, "root").select(
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("_links"),
        "_component",
    )
    match = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    linked = good.join(known, match).select("vec_id", F.col("_links").alias("n_links"), F.col("_component").alias("component_id"))
    alone = source.where(~usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
