"""The manifest against a tree built by hand, with superblocks of a few leaves."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from daylake.llm import common
from daylake.llm.merkle import merkle_manifest
from daylake.llm.ordering import numbered

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf string, id string, idx int, path string, root string"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _tree(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([_h("".join(now[i : i + fan])) for i in range(0, len(now), fan)])
    return levels


def _way(levels, i, fan):
    """(left, right) siblings of each level."""
    out = []
    for now in levels[:-1]:
        a = i // fan * fan
        out.append((now[a:i], now[i + 1 : a + fan]))
        i //= fan
    return out


def brute_force(rows, fan):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r, _leaf(*r)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = _tree([leaf for _, leaf in by_source[s]], fan)
    upper = _tree([trees[s][-1][0] for s in order], fan)
    root = upper[-1][0]
    out = []
    for k, s in enumerate(order):
        for i, (r, leaf) in enumerate(by_source[s]):
            way = _way(trees[s], i, fan) + _way(upper, k, fan)
            value = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                value = _leaf(r[0], lower, *r[2:])
            for left, right in way:
                value = _h("".join([*left, value, *right]))
            proof = _h("".join("".join([*a, *b]) for a, b in way))
            out.append((r[0], leaf, trees[s][-1][0], root, proof, value, value == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    common.ship_package(spark)
    return spark.createDataFrame([(*r[:2], r[2], r[3], r[4], "t", "l", "i", 1, "p", "r") for r in rows], DOCS)


def _rows():
    rows = [(i, f"Text {i % 7} Ä", "en", "hot", 9) for i in range(61)]
    rows += [(i, f"Other {i}", None, f"s{i % 5}", None) for i in range(100, 117)]
    rows += [(5, None, "en", None, None), (None, "", "de", None, 0), (None, "X", "de", "hot", 1)]
    rows += [(3, "Text 3 Ä", "en", "hot", 9)] * 3 + [(7, "again", "en", "hot", 5)]  # repeated rows and ids
    rows += [(1000, "One " * 50_000, "en", "Single", 200_000), (1001, "ü", "en", "+", 1), (1002, "ü", "en", "-", 1), (1003, "", "", "", 0)]
    return rows


@pytest.mark.parametrize("fan, levels", [(2, 2), (3, 1), (16, 3)])
def test_manifest_equals_brute_force(spark, fan, levels):
    rows = _rows()
    got = sorted((tuple(r) for r in merkle_manifest(frame(spark, rows), fan=fan, levels=levels).collect()), key=repr)
    assert got == brute_force(rows, fan)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 17])
def test_one_source(spark, n):
    rows = [(i, f"T{i}", "en", "a", 2) for i in range(n)]
    got = sorted((tuple(r) for r in merkle_manifest(frame(spark, rows)).collect()), key=repr)
    assert got == brute_force(rows, 16)


def test_no_documents(spark):
    empty = merkle_manifest(frame(spark, []))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_positions_of_a_key_over_many_tasks(spark):
    rows = [("hot", i % 90, i) for i in range(400)] + [(None, 1, 1000), (None, 1, 1001), ("a", None, 7)]
    rows += [(f"k{i}", i, i) for i in range(50)]
    made = numbered(spark.createDataFrame(rows, "k string, o int, r int").repartition(7), "k", ["o", "r"], "t").collect()
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(r)
    for k, found in want.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert sorted((x["pos"], x["r"]) for x in made if x["k"] == k) == [(i, r[2]) for i, r in enumerate(found)]
