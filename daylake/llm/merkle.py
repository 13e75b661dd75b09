"""Merkle manifest of a table: a tree of digests by source, one above all sources, and
for every row the proof that leads from its digest to the root.

Cogrouped subtree exchange.  Leaves stand in order of their id within a source and are
cut into superblocks of ``fan ** levels`` consecutive leaves.  Going up, a superblock is
reduced in one group to the one node that stands for it; those nodes are the leaves of
the next layer, until one is left.  Going down, the nodes of a layer are cogrouped by
superblock with the outer nodes that lie beside their way to the root, and hand them on
to the layer below.  In the last cogroup each superblock of leaves gets its outer nodes
and finishes on its own: it reduces its subtree again, joins inner and outer proof parts,
and folds every leaf up to the root.

No group is larger than a superblock (small ones share a group), whatever the size of a
source, and a layer has 4096 times fewer nodes than the one below.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from daylake.llm.common import crc32_of_id
from daylake.llm.ordering import numbered, unit_of
from daylake.session import stage

#: Leaves of a group of superblocks that share one cogroup, on average.
ROWS_PER_UNIT = 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(text: Column | str = "text") -> Column:
    """Digest of a row: each of doc_id, source, lang, n_chars and text as its UTF-8 byte
    count, a colon and the value, or ``-`` for null."""
    body = F.col(text) if isinstance(text, str) else text
    fields = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*fields, _field(body)).cast("binary"), 256)


def lowered(text: str = "text") -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(F.col(text), _UPPER, _LOWER)


def is_tampered() -> Column:
    """Rows whose id's crc32 is divisible by 5; a null id is not tampered with."""
    return F.coalesce(crc32_of_id() % 5 == 0, F.lit(False))


def levels_of(nodes: list[str], fan: int, levels: int, alone: bool) -> list[list[str]]:
    """The nodes and what they are reduced to, level by level: ``levels`` times, or, where
    the superblock is the whole tree (``alone``), until one node is left."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        now = out[-1]
        out.append([digest("".join(now[i : i + fan])) for i in range(0, len(now), fan)])
    return out


def _is_alone(block: int, n: int, fan: int, levels: int) -> bool:
    """A first superblock that is not full is the whole tree (a full one reduces to one
    node either way)."""
    return block == 0 and n < fan**levels


class Paths:
    """Siblings and folds of one superblock, given its nodes and its outer levels.

    A level of a path is ``(at, siblings)``: the place in the run, and the other digests
    of the run.  As text: ``at:`` and the digests, levels joined by ``;``.
    """

    def __init__(self, nodes: list[str], fan: int, levels: list[list[str]], outer: str) -> None:
        self.fan, self.levels, self.outer = fan, levels, outer
        self.above = [parse_level(x) for x in outer.split(";") if x]
        self.outside = "".join("".join(run) for _, run in self.above)
        self.suffix: dict[tuple[int, int], str] = {}
        self.folded: dict[tuple[int, int, str], str] = {}

    def level(self, depth: int, i: int) -> tuple[int, list[str]]:
        now, start = self.levels[depth], i // self.fan * self.fan
        return i - start, now[start:i] + now[i + 1 : start + self.fan]

    def path(self, i: int) -> str:
        inner = []
        for depth in range(len(self.levels) - 1):
            at, run = self.level(depth, i)
            inner.append(f"{at}:{''.join(run)}")
            i //= self.fan
        return ";".join([*inner, *([self.outer] if self.outer else [])])

    def siblings(self, i: int, depth: int = 0) -> str:
        """All sibling digests of a node, from its level to the root."""
        if depth == len(self.levels) - 1:
            return self.outside
        key = (depth + 1, i // self.fan)
        if key not in self.suffix:
            self.suffix[key] = self.siblings(i // self.fan, depth + 1)
        return "".join(self.level(depth, i)[1]) + self.suffix[key]

    def fold(self, i: int, value: str, depth: int = 0) -> str:
        """The root that ``value`` in place of node ``i`` leads to."""
        key = (depth, i, value)
        if key not in self.folded:
            if depth < len(self.levels) - 1:
                at, run = self.level(depth, i)
                parent = digest("".join([*run[:at], value, *run[at:]]))
                self.folded[key] = self.fold(i // self.fan, parent, depth + 1)
            else:
                top = value
                for at, run in self.above:
                    top = digest("".join([*run[:at], top, *run[at:]]))
                self.folded[key] = top
        return self.folded[key]


def parse_level(text: str) -> tuple[int, list[str]]:
    at, run = text.split(":")
    return int(at), [run[i : i + 64] for i in range(0, len(run), 64)]


def _superblocks(frame: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """The superblocks of a group, their nodes in order."""
    ordered = frame.sort_values(["tree", "block", "idx"], kind="stable")
    for (tree, block), nodes in ordered.groupby(["tree", "block"], sort=False):
        yield tree, int(block), nodes


def _with_unit(nodes: DataFrame, fan: int, levels: int, total: int) -> DataFrame:
    blocked = nodes.withColumn("block", F.floor(F.col("idx") / fan**levels).cast("long"))
    return blocked.withColumn("unit", unit_of(total, ROWS_PER_UNIT, "tree", "block"))


def _reduced(nodes: DataFrame, fan: int, levels: int, total: int) -> DataFrame:
    """One node for each superblock: ``tree, idx, digest``."""

    def reduce(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, block, part in _superblocks(frame):
            alone = _is_alone(block, len(part), fan, levels)
            out.append((tree, block, levels_of(part["digest"].tolist(), fan, levels, alone)[-1][0]))
        return pd.DataFrame(out, columns=["tree", "idx", "digest"])

    grouped = _with_unit(nodes, fan, levels, total).groupBy("unit")
    return grouped.applyInPandas(reduce, "tree string, idx long, digest string")


def _handed_on(
    nodes: DataFrame, outer: DataFrame, fan: int, levels: int, total: int
) -> DataFrame:
    """Outer levels of the superblocks below, which are the ``nodes`` of this layer:
    ``tree, block, path, top, root``."""

    def hand(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        known = {(r.tree, r.block): r for r in above.itertuples()}
        out = []
        for tree, block, part in _superblocks(below):
            r, digests = known[tree, block], part["digest"].tolist()
            alone = _is_alone(block, len(part), fan, levels)
            paths = Paths(digests, fan, levels_of(digests, fan, levels, alone), r.path)
            out += [(tree, int(i), paths.path(k), r.top, r.root) for k, i in enumerate(part["idx"])]
        return pd.DataFrame(out, columns=["tree", "block", "path", "top", "root"])

    left = _with_unit(nodes, fan, levels, total).groupBy("unit")
    right = outer.withColumn("unit", unit_of(total, ROWS_PER_UNIT, "tree", "block")).groupBy("unit")
    return left.cogroup(right).applyInPandas(
        hand, "tree string, block long, path string, top string, root string"
    )


def _climb(leaves: DataFrame, fan: int, levels: int, label: str) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """The layers of all trees (each with its number of nodes), and ``tree, top``."""
    layers = []
    while True:
        total, last = leaves.agg(F.count("*"), F.max("idx")).first()
        layers.append((leaves, total))
        tops = stage(_reduced(leaves, fan, levels, total), label)
        if not last or last < fan**levels:
            return layers, tops.select("tree", F.col("digest").alias("top"))
        leaves = tops


def _descend(layers: list[tuple[DataFrame, int]], outer: DataFrame, fan: int, levels: int, label: str) -> DataFrame:
    """Outer levels of the superblocks of the lowest layer, from those of whole trees."""
    for nodes, total in reversed(layers[1:]):
        outer = stage(_handed_on(nodes, outer, fan, levels, total), label)
    return outer


def merkle_manifest(docs: DataFrame, *, fan: int = 16, levels: int = 3) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Needs doc_id, source, lang, n_chars and text; other columns are ignored.  Within a
    source, leaves ascend by doc_id (null first) and, for a repeated id, by digest; rows
    that are equal throughout are interchangeable.  Sources ascend by their UTF-8 bytes,
    null first.  ``fan`` consecutive nodes become their digest until one is left: the
    subroot of a source, and the root of all sources.  ``proof_sha256`` covers all sibling
    digests from the leaf to the root (none: that of the empty text), and ``folded_root``
    is folded from the row as it would be with A-Z lower-cased, where its id's crc32 is
    divisible by 5, and from the row itself elsewhere.  Texts are read once, whole, and
    never shuffled.  An empty table gives no rows.
    """
    source = F.col("source").cast("string")
    tree = F.coalesce(F.concat(F.lit("+"), source), F.lit("-"))
    leaf = leaf_digest()
    seen = F.when(is_tampered(), leaf_digest(lowered())).otherwise(leaf)
    light = stage(
        docs.select(
            tree.alias("tree"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf.alias("digest"),
            seen.alias("seen"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "merkle-leaves",
    )
    placed = numbered(light, "tree", ["doc_id", "digest", "_row"], "merkle-order")
    # pandas would turn ids with nulls among them into floats.
    placed = placed.select(
        "tree", F.col("pos").alias("idx"), "digest", "seen", F.col("doc_id").cast("string").alias("id")
    )
    layers, subroots = _climb(placed.select("tree", "idx", "digest"), fan, levels, "merkle-tops")
    # "-" (null) sorts after "+": order by the flag first.
    ordered = numbered(
        subroots.select(F.lit("sources").alias("all"), F.col("tree") != "-", "tree", "top").toDF("all", "named", "tree", "top"),
        "all",
        ["named", "tree"],
        "merkle-sources",
    )
    above, roots = _climb(
        ordered.select(F.col("all").alias("tree"), F.col("pos").alias("idx"), F.col("top").alias("digest")),
        fan,
        levels,
        "merkle-roots",
    )
    # One row, or none where there is no document.
    whole = roots.select(
        "tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("path"), "top", F.col("top").alias("root")
    )
    nodes, total = above[0]
    beside = _handed_on(nodes, _descend(above, whole, fan, levels, "merkle-paths"), fan, levels, total)
    outer = ordered.join(beside.select(F.col("block").alias("pos"), "path", "root"), "pos").select(
        "tree", F.lit(0).cast("long").alias("block"), "path", "top", "root"
    )
    outer = _descend(layers, stage(outer, "merkle-paths"), fan, levels, "merkle-paths")

    def finish(leaves: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        known = {(r.tree, r.block): r for r in found.itertuples()}
        out = []
        for tree, block, part in _superblocks(leaves):
            r, digests = known[tree, block], part["digest"].tolist()
            alone = _is_alone(block, len(part), fan, levels)
            paths = Paths(digests, fan, levels_of(digests, fan, levels, alone), r.path)
            proof = [digest(paths.siblings(i)) for i in range(len(digests))]
            fold = [paths.fold(i, value) for i, value in enumerate(part["seen"])]
            out.append(
                pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(object),
                        "leaf": digests,
                        "subroot": r.top,
                        "root": r.root,
                        "proof_sha256": proof,
                        "folded_root": fold,
                        "verified": np.array(fold) == r.root,
                    }
                )
            )
        return pd.concat(out, ignore_index=True)

    nodes, total = layers[0]
    left = _with_unit(placed, fan, levels, total).groupBy("unit")
    right = outer.withColumn("unit", unit_of(total, ROWS_PER_UNIT, "tree", "block")).groupBy("unit")
    rows = left.cogroup(right).applyInPandas(
        finish,
        "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
    return rows.select(F.col("id").cast("long").alias("doc_id"), *rows.columns[1:])
