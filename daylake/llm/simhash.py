"""SimHash near-duplicates through a Gray-order hierarchical index.

Two of three parts of a fingerprint may hold all differing bits, so fingerprints with
at most two differing bits agree in one of three fixed parts.  Distinct fingerprints
are dealt by (part, value of the part); inside a group they are sorted by Gray rank
and indexed: a node knows the bits that all fingerprints below it share, and two nodes
are dropped as soon as their shared bits differ in more than two places.  Groups hand
on one link per fingerprint (to the least one of its local component) rather than all
pairs.

A group with more than ``max_group`` distinct fingerprints, such as those of thousands
of near copies, is not gathered: its fingerprints are matched exactly by shared
neighbours instead.  Fingerprints differ in at most two bits exactly if some
fingerprint lies within one bit of both; grouped by it there are never more than 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daylake.llm.common import SENT_ROWS, add_from_text, free_name, text_blocks, sent_if_small
from daylake.llm.components import connected_components, local_roots
from daylake.session import stage

BITS = 64
DISTANCE = 2
#: Bit ranges (from the lowest, width) of the three parts.
PARTS = ((0, 21), (21, 21), (42, 22))
LEAF = 16
#: Groups of up to so many fingerprints are compared without an index.
SMALL = 8
FANOUT = 8

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text; 0 for one without words."""
    from xxhash import xxh64_intdigest

    # bytes.split() cuts at exactly the six ASCII blanks.
    words = text.translate(_FOLD).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]]).tolist()
        hashes = [
            xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())
        ]
    return _majority(np.array(hashes, "<u8"))


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        some = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint's 64 bits as a (signed) long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            prints = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long"
    )


# --- the index inside one group ---------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _levels(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(shared bits, their values) of the nodes, leaves of single fingerprints first."""
    all_ones, none = prints, prints
    mask = np.full(len(prints), ~np.uint64(0))
    levels = [(mask, prints)]
    width = LEAF
    while len(all_ones) > 1:
        cuts = np.arange(0, len(all_ones), width)
        all_ones = np.bitwise_and.reduceat(all_ones, cuts)
        none = np.bitwise_or.reduceat(none, cuts)
        levels.append((all_ones | ~none, all_ones))
        width = FANOUT
    return levels


def linked_pairs(prints: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of distinct fingerprints, in Gray order, that link.

    Pairs of nodes go down level by level.  Bits that a node shares with its parent
    were compared above; a child adds the differences in its newly shared bits.
    """
    levels = _levels(prints)
    top = len(levels) - 1
    todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint64))]
    while todo:
        level, a, b, apart, seen = todo.pop()
        if level == 0:
            yield a, b
            continue
        width = LEAF if level == 1 else FANOUT
        mask, value = levels[level - 1]
        n = len(mask)
        step = max(1, 4_000_000 // (width * width))
        for at in range(0, len(a), step):
            grid = np.arange(width)
            ca = (a[at : at + step, None, None] * width + grid[:, None]).repeat(width, axis=2).ravel()
            cb = (b[at : at + step, None, None] * width + grid[None, :]).repeat(width, axis=1).ravel()
            old = np.repeat(seen[at : at + step], width * width)
            far = np.repeat(apart[at : at + step], width * width)
            good = (ca < n) & (cb < n) & (ca <= cb if level > 1 else ca < cb)
            ca, cb, old, far = ca[good], cb[good], old[good], far[good]
            shared = mask[ca] & mask[cb]
            far = far + np.bitwise_count((value[ca] ^ value[cb]) & shared & ~old)
            near = far <= distance
            if near.any():
                todo.append((level - 1, ca[near], cb[near], far[near], shared[near]))


def _group_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group's fingerprints to the first of their local component."""
    ordered = prints[np.argsort(gray_rank(prints))]
    a, b = [], []
    for i, j in linked_pairs(ordered):
        a.append(i)
        b.append(j)
    if not a:
        return ordered[:0], ordered[:0]
    root = local_roots(len(ordered), np.concatenate(a), np.concatenate(b))
    linked = np.flatnonzero(root != np.arange(len(root)))
    return ordered[linked], ordered[root[linked]]


def _small_links(prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of many small groups at once: every fingerprint against those one,
    two, ... places behind it in its group."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    u, v = [prints[:0]], [prints[:0]]
    for step in range(1, int(sizes.max(initial=1))):
        near = (group[step:] == group[:-step]) & (
            np.bitwise_count(prints[step:] ^ prints[:-step]) <= DISTANCE
        )
        u.append(prints[step:][near])
        v.append(prints[:-step][near])
    return np.concatenate(u), np.concatenate(v)


def _links_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (part, value, fp), sorted by group: links of every group."""

    def work(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts = np.concatenate([[0], cuts])
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        small = (sizes > 1) & (sizes <= SMALL)
        u, v = _small_links(prints[np.repeat(small, sizes)], sizes[small])
        us, vs = [u], [v]
        for i in np.flatnonzero(sizes > SMALL):
            u, v = _group_links(prints[starts[i] : starts[i] + sizes[i]])
            us.append(u)
            vs.append(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"]
        )

    keys = np.zeros((0, 2), np.int64)
    prints = np.zeros(0, np.uint64)
    for batch in batches:
        new = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy()], 1)
        keys = np.concatenate([keys, new])
        prints = np.concatenate([prints, batch.column(2).to_numpy().view(np.uint64)])
        if not len(keys):
            continue
        # The last group may go on in the next batch.
        other = np.flatnonzero((keys != keys[-1]).any(axis=1))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield work(keys[:cut], prints[:cut])
            keys, prints = keys[cut:], prints[cut:]
    if len(keys):
        yield work(keys, prints)


def _part_value(part: int) -> Column:
    low, width = PARTS[part]
    return F.shiftright("fp", low).bitwiseAND(F.lit((1 << width) - 1))


def links(distinct: DataFrame, max_group: int = 4096) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that connect exactly those that
    chains of pairs with at most two differing bits connect."""
    keys = F.array(
        *[F.struct(F.lit(p).alias("part"), _part_value(p).alias("value")) for p in range(3)]
    )
    dealt = distinct.select("fp", F.explode(keys).alias("k")).select("k.part", "k.value", "fp")
    sizes = dealt.groupBy("part", "value").agg(F.count("*").alias("n"))
    hot = stage(sizes.where(F.col("n") > max_group).select("part", "value"), "hot-groups")
    usual = dealt.join(hot, ["part", "value"], "left_anti")
    grouped = usual.repartition("part", "value").sortWithinPartitions("part", "value")
    found = grouped.mapInArrow(_links_of_groups, "u long, v long")
    crowded = dealt.join(hot, ["part", "value"], "left_semi").select("fp").distinct()
    one_off = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    near = crowded.select("fp", F.explode(F.concat(F.array("fp"), one_off)).alias("near"))
    least = near.groupBy("near").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("all"))
    stars = least.where(F.size("all") > 1).select(F.explode("all").alias("u"), "v")
    return found.union(stars.where("u <> v").distinct())


def near_duplicates(docs: DataFrame, max_group: int = 4096) -> DataFrame:
    """doc_id, fp and component_id for every row of ``docs``.

    ``component_id`` is the least doc_id reachable over links, the row's own included;
    null if no row of the component has an id.  Null and blank texts have fingerprint
    zero and are linked like any other.  Repeated rows get a row each.
    """
    prints = stage(fingerprints(docs), "fingerprints")
    return components_of(prints, max_group)


def components_of(prints: DataFrame, max_group: int = 4096) -> DataFrame:
    """The same from stored fingerprints (doc_id, fp)."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fps")
    roots = connected_components(links(distinct.select("fp"), max_group))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, max_group: int = 4096, sent_rows: int = SENT_ROWS) -> DataFrame:
    """One row of each component, with all columns: that with the least doc_id, among
    equal ids that with the least hash of its text.

    Rows are told apart by id and text, so texts that share an id without resembling each
    other all stay.  Of rows repeated with id and text one stays, and a component without
    any id keeps one row, too.
    """
    said = free_name(docs.columns, "_text_hash")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias(said))
    prints = stage(_with_fingerprint(hashed, "fp").select(F.col("doc_id").cast("long"), said, "fp"), "fingerprints")
    keys = prints.groupBy("doc_id", said, "fp").agg(F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("anonymous"), "doc_id", F.col(said).alias("hash"), "n")
    distinct = stage(keys.groupBy("fp").agg(F.min(row).alias("first")), "distinct-fps")
    roots = connected_components(links(distinct.select("fp"), max_group))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        F.coalesce("root", "fp").alias("root"), "first"
    )
    name = free_name(docs.columns, "_kept_id")
    many = free_name(docs.columns, "_kept_rows")
    kept_hash = free_name(docs.columns, "_kept_hash")
    keep = stage(
        rooted.groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias(name), F.col("first.hash").alias(kept_hash), F.col("first.n").alias(many)),
        "kept-rows",
    )
    own = F.col("doc_id").cast("long").eqNullSafe(F.col(name)) & (F.xxhash64("text") == F.col(kept_hash))
    # Fewer rows go than stay: the keys of those that go meet the texts where these are.
    again = keep.where(F.col(many) > 1).select(name, kept_hash)
    pairs = prints.select(F.col("doc_id").alias(name), F.col(said).alias(kept_hash)).distinct()
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"k.{c}")) for c in (name, kept_hash)]
    gone = pairs.alias("p").join(keep.alias("k"), same[0] & same[1], "left_anti")
    out = docs.join(sent_if_small(gone.union(again), "gone-rows", sent_rows), own, "left_anti")
    if again.isEmpty():
        return out
    repeated = docs.join(sent_if_small(again, "repeated-rows", sent_rows), own, "left_semi")
    return out.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def _with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    def make():
        return lambda texts: (np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64).view(np.int64),)

    return add_from_text(docs, [(name, "long", pa.int64())], make)
