"""Context-tree weighting against a plain recursion over all contexts."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from daylake.llm import common
from daylake.llm.context_tree import DEPTH, GramCounts, Lookup, grams, log_kt, score_texts

SCHEMA = "doc_id long, text string, held boolean, score double, block long, part int, kind string"


def _held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()


def _events(text):
    """(context, last byte first; decision; bit) of every binary decision."""
    padded = [255] * DEPTH + list(text) + [254]
    for i in range(DEPTH, len(padded)):
        context = tuple(padded[i - d] for d in range(1, DEPTH + 1))
        for j in range(8):
            yield context, (1 << j) | (padded[i] >> (8 - j)), (padded[i] >> (7 - j)) & 1


def _kt(zeros, ones):
    return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)


def brute_force(rows):
    counts, below = defaultdict(lambda: [0, 0]), defaultdict(set)
    tokens, ends = Counter(), 0
    for doc_id, text in rows:
        if _held(doc_id):
            continue
        lower = _lower(text)
        tokens.update(lower.split())
        ends += 1
        for context, node, bit in _events(lower):
            for d in range(DEPTH + 1):
                counts[context[:d], node][bit] += 1
                if d:
                    below[context[: d - 1], node].add(context[d - 1])
    memo = {}

    def weighted(context, node):
        key = context, node
        if key not in memo:
            own = _kt(*counts[key]) if key in counts else 0.0
            if len(context) == DEPTH:
                memo[key] = own
            else:
                children = sum(weighted((*context, c), node) for c in sorted(below[key])) if key in below else 0.0
                memo[key] = np.logaddexp(own, children) + math.log(0.5)
        return memo[key]

    def probability(context, node, bit, depth=0):
        here = context[:depth]
        if (here, node) not in counts:
            return 0.5
        zeros, ones = counts[here, node]
        kt = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        if depth == DEPTH:
            return kt
        own = math.exp(_kt(zeros, ones) + math.log(0.5) - weighted(here, node))
        return own * kt + (1 - own) * probability(context, node, bit, depth + 1)

    total = sum(tokens.values()) + ends
    under = total + len(tokens) + (ends > 0) + 1
    out = []
    for doc_id, text in rows:
        lower = _lower(text)
        words = lower.split()
        base = sum(math.log10((tokens[w] + 1) / under) for w in words) + math.log10((ends + 1) / under)
        score = sum(math.log10(probability(*e)) for e in _events(lower))
        out.append((doc_id, _held(doc_id), len(words) + 1, sum(tokens[w] > 0 for w in words) + (ends > 0), total, base, score))
    return out


def frame(spark, rows):
    common.ship_package(spark)
    return spark.createDataFrame([(i, t, True, 1.0, 2, 3, "k") for i, t in rows], SCHEMA)


def check(spark, rows, **options):
    got = sorted((tuple(r) for r in score_texts(frame(spark, rows), **options).collect()), key=repr)
    want = sorted(brute_force(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    return got


def test_scores_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "cat", "The", "sat", "Ünder", "日本", "a\tb", "\x0bx", "mat."]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(40)]
    rows += [(None, "the cat"), (50, None), (51, ""), (3, rows[3][1]), (3, "same id"), (53, " \n "), (54, "\x1cnot blank\x00")]
    got = check(spark, rows, parts=5)
    assert {g[1] for g in got} == {True, False}


def test_only_held_out_texts_and_no_texts(spark):
    alone = [i for i in range(60) if _held(i)][:3]
    got = check(spark, [(i, "some text") for i in alone])
    assert {g[4] for g in got} == {0} and {g[5] for g in got} == {0.0}
    assert [g[6] for g in got] == pytest.approx([10 * 8 * math.log10(0.5)] * 3)
    assert score_texts(frame(spark, [])).collect() == []


def test_a_long_text(spark):
    learnt = next(i for i in range(9) if not _held(i))
    rows = [(learnt, "one long text goes on " * 200_000)] + [(i, f"short text {i}") for i in range(10, 38)]
    got = {r["doc_id"]: r for r in score_texts(frame(spark, rows)).collect()}
    assert len(got) == 29 and got[learnt]["n_tokens"] == 1_000_001
    # Much of it repeats, so that a byte costs far less than eight bits.
    assert -got[learnt]["score"] * math.log2(10) / (22 * 200_000) < 0.01


def test_training_texts_cost_less_than_strange_ones(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog") for i in range(200)]
    rows += [(i, "xqzv jkwp bvxz qqkj") for i in range(200, 300) if _held(i)]
    got = score_texts(frame(spark, rows)).collect()
    per_byte = {r["doc_id"]: r["score"] / (44 if r["doc_id"] < 200 else 20) for r in got}
    known = [v for i, v in per_byte.items() if i < 200]
    strange = [v for i, v in per_byte.items() if i >= 200]
    assert strange and min(known) > 5 * max(strange)
    assert all(r["score"] > r["base_score"] for r in got if r["doc_id"] < 200)


def test_parts_of_the_method():
    text = np.frombuffer(b"abz", np.uint8)
    made = grams(text, np.array([2, 0, 1]))
    pads = [0xFF] * DEPTH
    want = [[*pads, 97], [97, *pads[1:], 98], [98, 97, *pads[2:], 0xFE], [*pads, 0xFE], [*pads, 122], [122, *pads[1:], 0xFE]]
    assert made.tolist() == [int.from_bytes(bytes(w), "big") for w in want]
    assert len(grams(text[:0], np.zeros(0, np.int64))) == 0
    n = np.array([0, 1, 70_000, 5])
    assert log_kt(n, n[::-1]) == pytest.approx([_kt(a, b) for a, b in zip(n, n[::-1])], rel=1e-9)
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 5000).astype(np.uint64))
    order = np.random.default_rng(1).permutation(len(keys))
    assert Lookup(keys).find(keys[order]).tolist() == order.tolist()
    seen = GramCounts()
    for _ in range(3):
        seen.add(keys, np.ones(len(keys), np.int64))
    assert seen.total()[1].tolist() == [3] * len(keys)
