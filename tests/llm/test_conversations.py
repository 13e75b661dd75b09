"""The repair against a plain search over all edits, also in chunks of a few rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from daylake.llm import common
from daylake.llm.conversations import repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string, conv string, audit string, pos int, kind int, digest string"


def _damaged(rows):
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = "user" if fate == 4 else show(role), show(text)
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        yield from [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)


def _repaired(rows):
    """Cost, audit and repaired turns: the least (cost, audit), by the course of roles."""

    ways = {0: (0, "", ()), 3: (0, "", ())}
    for i in range(len(rows), -1, -1):
        found = defaultdict(list)
        for q in range(4):
            then, role = (3, "assistant") if q == 2 else (2, "user")
            if i == len(rows):
                found[q] += [ways[q]] if q in ways else []
                continue
            own, text, fault = rows[i]
            edits = [(2, "D", (), q)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                edits.append((1 + more, "R", ((role, text),), then))
                if own[:1] == role[0]:
                    edits.append((more, "K", ((own, text),), then))
                if own[:1] == "s" and q == 0:
                    edits.append((more, "K", ((own, text),), 1))
            for cost, letter, said, after in edits:
                c, audit, turns = ways[after]
                found[q].append((cost + c, letter + audit, (*said, *turns)))
        for _ in range(3):  # inserts before the row
            for q in range(4):
                then, role = (3, "assistant") if q == 2 else (2, "user")
                if found[then]:
                    c, audit, turns = min(found[then], key=lambda f: f[:2])
                    found[q].append((5 + c, "I" + audit, ((role, ""), *turns)))
        ways = {q: min(f, key=lambda x: x[:2]) for q, f in found.items()}
    return ways[0]


def brute_force(rows):
    by = {r[0]: [] for r in rows}
    for r in _damaged(rows):
        by[r[0]].append(r)
    out = []
    for conv, found in by.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in found:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        turns = [r[1] for r in found if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(found, found[1:])]
        cost, audit, said = _repaired(tuple((r[2], r[3], f) for r, f in zip(found, faults)))
        text = "\n".join(f"{role}:{t}" for role, t in said)
        counts = [sum(f == x for f in faults) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    common.ship_package(spark)
    return spark.createDataFrame([(*r, "c", "a", 1, 2, "d") for r in rows], SCHEMA)


def _random_rows(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", "why", " \n", "Tell me more. ", "é?\t", None, f"Turn {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]) if seed % 2 else turn, role, text))
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, 4096), (2, 2)])
def test_repairs_equal_brute_force(spark, seed, chunk):
    rows = _random_rows(seed) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (900, None, "user", "x.")]
    got = sorted((tuple(r) for r in repair_conversations(frame(spark, rows), chunk=chunk).collect()), key=repr)
    assert got == brute_force(rows)


def test_a_long_conversation_and_repeated_texts(spark):
    turns = ["user", "assistant", "assistant", "user", "system"]
    rows = [(7, i, turns[i * i % 5], f"Text {i % 300}." if i % 4 else "cut") for i in range(900)]
    rows += [(8, i, "user", "Same.") for i in range(500)] + [(9, 0, "user", "Long " * 100_000 + ".")]
    got = sorted((tuple(r) for r in repair_conversations(frame(spark, rows), chunk=16).collect()), key=repr)
    assert got == brute_force(rows)
    assert max(len(r[7]) for r in got) >= 900


def test_a_dropped_conversation_and_no_conversations(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair_conversations(frame(spark, [(gone, 0, "user", "Hi.")])).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair_conversations(frame(spark, [])).collect() == []
