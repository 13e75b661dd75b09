"""The law of the shards, and base spans of secrets against plain patterns."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from daylake.llm import packing
from daylake.llm.queries import QUERIES
from daylake.llm.secrets import base_spans, scan_secrets
from daylake.llm.sharding import place_groups

SF = "/root/testdata/sf0.01"


def test_shards_are_near_equal_in_bytes_and_keep_copies_together(spark):
    rows = QUERIES["op8_sharding"](spark, SF).collect()
    size, slots, of_text, copies = defaultdict(int), defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
        copies[r["text_crc32"], r["size"]] += 1
    assert set(size) == set(range(24))
    assert max(size.values()) <= 1.04 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Only groups over a sixteenth of a shard, in bytes or rows, may be cut.
    for key, shards in of_text.items():
        if len(shards) > 1:
            assert copies[key] * key[1] > sum(size.values()) // (24 * 16) or copies[key] > len(rows) // (24 * 16)


def test_groups_go_where_the_dot_product_is_highest():
    # The first shard is full of bytes, so a group of many bytes goes to the second.
    sizes = np.array([[90.0, 1, 1], [60, 1, 1], [30, 1, 1], [1, 50, 50], [1, 50, 50]])
    shard = place_groups(sizes, 2)
    assert shard[0] != shard[1] == shard[2] and shard[3] != shard[4]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: [tuple(s) for s in r["b"]] for r in scan_secrets(docs).select("doc_id", base_spans().alias("b")).collect()}
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for doc_id, text in [tuple(r) for r in docs.collect()]:
        text, want = text or "", []
        want += [("assign", *m.span()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
        order = ("assign", "access", "hex")
        assert got[doc_id] == sorted(want, key=lambda s: (s[1], order.index(s[0])))


def test_patterns_of_many_lengths_serve_where_all_pieces_are_short():
    lengths, counts = np.unique(np.random.default_rng(1).integers(200, 600, 100_000), return_counts=True)
    bars = dict(zip(lengths.tolist(), counts.tolist()))
    plan = packing.packing_plan(bars, 2048)
    least = packing.least_sequences(bars, 2048)
    best_fit = sum(many for _, many, _ in packing._best_fit(dict(bars), [], 2048))
    assert least <= plan.sequences <= 1.008 * least < best_fit
    found, used = packing.priced_patterns(lengths, counts, 2048)
    by_patterns = ((found < len(lengths)).sum(axis=1) * used).sum()
    assert by_patterns > 0.9 * counts.sum()
    ranks = np.concatenate([np.arange(n) for n in counts])
    sequence, offset = plan.place(np.repeat(lengths, counts), ranks)
    order = np.lexsort((offset, sequence))
    size = np.repeat(lengths, counts)[order]
    begins = np.append(True, np.diff(sequence[order]) > 0)
    want = np.where(begins, 0, np.append(0, (offset[order] + size)[:-1]))
    assert (offset[order] == want).all() and (offset[order] + size).max() <= 2048


def test_a_valued_pattern_is_the_best_that_holds_its_length():
    from itertools import combinations_with_replacement

    rng = np.random.default_rng(5)
    lengths, values = np.array([3, 4, 7, 9, 13]), rng.uniform(-0.1, 1, 5)
    found = packing.valued_patterns(lengths, values, 20, 3)
    size, worth = np.append(lengths, 0), np.append(values, 0)
    for at, pattern in enumerate(found):
        assert at in pattern and size[pattern].sum() <= 20
        want = max(
            worth[[at, *rest]].sum()
            for rest in combinations_with_replacement(range(6), 2)
            if size[[at, *rest]].sum() <= 20
        )
        assert np.isclose(worth[pattern].sum(), want)
