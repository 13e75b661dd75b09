"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pattern packing by non-negative least squares: the lengths of all pieces form a
histogram of at most ``capacity`` bars, whatever the size of the data.  Patterns of
up to three lengths that fill a sequence (nearly) are enumerated, repeat counts are
fitted to the histogram, rounded with carried remainders, and what stays over is
packed best-fit, longest first, on counts of equal lengths.  Where those patterns do not
come near the lower bound, patterns of up to eight lengths are enumerated by what the
fit still misses.  Only the histogram goes to the driver; the plan that comes back has
a size bounded by the patterns.

Pieces find their place by their rank among pieces of equal length.  The rank is the
sum of a task-local number and an offset of the task, so a length that a third of all
pieces have is never sorted or gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from daylake.llm.common import text_blocks
from daylake.llm.tokens import ENCODE_BYTES, loaded

PIECE_SCHEMA = (
    "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
)


def tokenized_pieces(
    docs: DataFrame,
    capacity: int = 2048,
    *,
    tokenizer: str | None = None,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids; only longer documents are cut.

    A document's ids are those of its text (null: empty), then ``end_id``.  Columns:
    the document, piece number, ids of the document before the piece, length, the ids
    as little-endian unsigned 32-bit integers, and ``part``/``nth``: the task and the
    piece's number among the task's pieces of that length.  Repeated rows and null
    ids give pieces like any other row.  One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, texts in text_blocks(batches, text, ENCODE_BYTES):
            ids, counts = encoder.encode(texts)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4", copy=False)
            counts = counts + 1
            starts = np.cumsum(counts) - counts
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            nth = np.empty(len(row), np.int64)
            order = np.argsort(length, kind="stable")
            bars = np.bincount(length, minlength=capacity + 1)
            nth[order] = np.arange(len(row)) - np.repeat(np.cumsum(bars) - bars, bars)
            nth += seen[length]
            seen += bars
            begin = (starts[row] + start) * 4
            raw = ids.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(rows.schema.get_field_index(doc_id)).cast(pa.int64()).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array([raw[b : b + 4 * n] for b, n in zip(begin.tolist(), length.tolist())], pa.binary()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(nth),
                ],
                names=["doc_id", "piece", "start", "length", "ids", "part", "nth"],
            )

    return docs.select(doc_id, text).mapInArrow(run, PIECE_SCHEMA)


# --- the plan, from the histogram alone ------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Places by length and rank: entry i serves ``ranks`` pieces from ``rank[i]`` on,
    ``copies[i]`` to a sequence, the first at ``offset[i]`` of sequence ``first[i]``."""

    key: np.ndarray  # length << 40 | first rank, ascending
    first: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length.astype(np.int64) << 40) | rank
        i = np.searchsorted(self.key, wanted, side="right") - 1
        q = wanted - self.key[i]
        return (
            self.first[i] + q // self.copies[i],
            self.offset[i] + q % self.copies[i] * length,
        )


def patterns(lengths: np.ndarray, capacity: int, waste: int) -> np.ndarray:
    """Index triples (``len(lengths)`` for none) of lengths, longest first, whose sum
    misses ``capacity`` by at most ``waste``."""
    none = len(lengths)
    of = np.full(capacity + 1, -1, np.int64)  # greatest index with a length <= x
    of[lengths] = np.arange(none)
    of = np.maximum.accumulate(of)
    found = []
    alone = np.flatnonzero(lengths >= capacity - waste)
    found.append(np.stack([alone, np.full_like(alone, none), np.full_like(alone, none)], 1))
    for a in range(none):
        rest = capacity - lengths[a]
        b = np.arange(0, min(a, of[rest]) + 1)
        left = rest - lengths[b]
        two = b[left <= waste]
        found.append(np.stack([np.full_like(two, a), two, np.full_like(two, none)], 1))
        c = np.minimum(of[left], b)
        good = (c >= 0) & (left - lengths[c] <= waste) & (left - lengths[c] >= 0)
        found.append(np.stack([np.full(good.sum(), a), b[good], c[good]], 1))
    return np.concatenate(found)


def fit_counts(
    found: np.ndarray,
    bars: np.ndarray,
    steps: int = 120,
    start: np.ndarray | None = None,
) -> np.ndarray:
    """Non-negative least squares: how often each pattern is used, so that the lengths
    used come nearest to the histogram (accelerated projected gradient).

    A pattern is a row of indices of lengths (``len(bars)`` for none); ``start`` are counts
    to begin with.
    """
    if not len(found):
        return np.zeros(0)
    n = len(bars)
    scale = float(bars.max()) or 1.0
    target = np.append(bars / scale, 0.0)
    columns = [np.ascontiguousarray(c) for c in found.T if (c < n).any()]

    def used(x):
        total = sum(np.bincount(c, x, minlength=n + 1) for c in columns)
        total[n] = 0.0
        return total

    def back(r):
        return sum(r[c] for c in columns)

    v = np.ones(len(found))
    for _ in range(12):  # the largest curvature, by power iteration
        w = back(used(v))
        norm = float(np.linalg.norm(w)) or 1.0
        v = w / norm
    x = y = np.zeros(len(found)) if start is None else start / scale
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - back(used(y) - target) / (1.05 * norm), 0.0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x * scale


def valued_patterns(lengths: np.ndarray, values: np.ndarray, capacity: int, parts: int) -> np.ndarray:
    """For each length, the pattern of at most ``parts`` lengths that holds it and is worth
    most by ``values``: rows of ascending indices (``len(lengths)`` for none)."""
    n = len(lengths)
    rooms = np.arange(capacity + 1)
    rest = rooms[None, :] - lengths[:, None]
    rest[rest < 0] = capacity + 1
    best, choices = np.zeros(capacity + 2), []
    best[-1] = -np.inf
    for _ in range(parts - 1):  # the most that k more lengths add to a room
        worth = best[rest] + values[:, None]
        choice = worth.argmax(axis=0)
        gain = worth[choice, rooms]
        choice[gain <= best[:-1]] = n
        best[:-1] = np.maximum(gain, best[:-1])
        choices.append(choice)
    found = np.full((n, parts), n)
    found[:, 0] = np.arange(n)
    sizes = np.append(lengths, 0)
    room = capacity - lengths
    for k, choice in enumerate(reversed(choices), 1):
        found[:, k] = choice[room]
        room = room - sizes[found[:, k]]
    return np.sort(found, axis=1)


def priced_patterns(
    lengths: np.ndarray, bars: np.ndarray, capacity: int, parts: int = 8, rounds: int = 24
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of up to ``parts`` lengths with their counts.

    Each round adds, for every length, the pattern worth most that holds it, and fits
    again.  A length is worth its share of a sequence and, beside that, what the fit
    still misses of it, so that patterns fill sequences and come to hold what others
    leave.  Patterns that several fits did not use are left out.
    """
    n = len(lengths)
    scale = float(bars.max())
    rng = np.random.default_rng(0)
    found = np.zeros((0, parts), np.int64)
    counts, idle = np.zeros(0), np.zeros(0, np.int64)
    missed = np.zeros(n)
    for step in range(rounds):
        weight = max(0.5 * 0.85**step, 0.01)
        values = lengths / capacity + weight * missed / scale
        # Noise parts patterns that are worth (nearly) the same.
        new = [
            valued_patterns(lengths, values + rng.uniform(0, noise, n), capacity, parts)
            for noise in (1e-4, 2e-3, 1e-2)
        ]
        new = np.unique(np.concatenate(new), axis=0)
        found, first = np.unique(np.concatenate([found, new]), axis=0, return_index=True)
        counts = np.append(counts, np.zeros(len(new)))[first]
        idle = np.append(idle, np.zeros(len(new), np.int64))[first]
        counts = fit_counts(found, bars, 150, start=counts)
        idle = np.where(counts > 0, 0, idle + 1)
        stay = idle < 4
        found, counts, idle = found[stay], counts[stay], idle[stay]
        missed = bars - sum(np.bincount(c, counts, minlength=n + 1)[:n] for c in found.T)
    return found, counts


def _rounded(x: np.ndarray) -> np.ndarray:
    """Whole numbers with the same running total, to within one."""
    total = np.floor(np.cumsum(x) + 1e-9)
    return np.diff(np.concatenate([[0], total])).astype(np.int64)


def _best_fit(left: dict[int, int], open_bins: list[list], capacity: int) -> list[list]:
    """Pack counts of equal lengths, longest first, each into the fullest sequence that
    has room.  A bin is [room, how many, [(length, copies), ...]]."""
    done: list[list] = []
    by_room: dict[int, list[list]] = {}
    for bin_ in open_bins:
        by_room.setdefault(bin_[0], []).append(bin_)
    for length in sorted(left, reverse=True):
        count = left[length]
        for room in sorted(r for r in by_room if r >= length):
            copies = room // length
            waiting = by_room[room]
            while count and waiting:
                bin_ = waiting.pop()
                whole = min(bin_[1], count // copies)
                odd = 1 if whole < bin_[1] and count > whole * copies else 0
                for many, k in ((whole, copies), (odd, count - whole * copies)):
                    if many:
                        k = min(k, copies)
                        by_room.setdefault(room - k * length, []).append(
                            [room - k * length, many, bin_[2] + [(length, k)]]
                        )
                        count -= many * k
                if bin_[1] > whole + odd:
                    waiting.append([room, bin_[1] - whole - odd, bin_[2]])
            if not count:
                break
        copies = capacity // length
        for many, k in ((count // copies, copies), (1, count % copies)):
            if many and k:
                by_room.setdefault(capacity - k * length, []).append(
                    [capacity - k * length, many, [(length, k)]]
                )
    for bins in by_room.values():
        done += bins
    return done


def least_sequences(histogram: dict[int, int], capacity: int) -> int:
    """A lower bound: by the sum of lengths, and as no two pieces over half the capacity
    share a sequence."""
    ids = sum(n * c for n, c in histogram.items())
    return max(-(-ids // capacity), sum(c for n, c in histogram.items() if 2 * n > capacity))


def packing_plan(histogram: dict[int, int], capacity: int, waste: int | None = None) -> Plan:
    """Places for all pieces of a histogram {length: count}.

    Patterns miss the capacity by at most ``waste``.  Without one, exactly filled patterns
    are tried, where those come out over a thousandth above the lower bound slightly
    wasteful ones (a 256th) too, and where these are still more than that and a sequence
    above it, patterns of more lengths; the plan with the fewest sequences is taken.
    """
    if waste is not None:
        return _fitted_plan(histogram, capacity, waste)
    least = least_sequences(histogram, capacity)
    plan = _fitted_plan(histogram, capacity, 0)
    if 1000 * plan.sequences > 1001 * least:
        plan = min(plan, _fitted_plan(histogram, capacity, capacity // 256), key=lambda p: p.sequences)
    if 1000 * (plan.sequences - 1) > 1001 * least:
        plan = min(plan, _priced_plan(histogram, capacity), key=lambda p: p.sequences)
    return plan


def _bars(histogram: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array(sorted(histogram), np.int64)
    return lengths, np.array([histogram[int(n)] for n in lengths], np.int64)


def _fitted_plan(histogram: dict[int, int], capacity: int, waste: int) -> Plan:
    lengths, bars = _bars(histogram)
    if not len(lengths):
        return _placed_plan(lengths, bars, np.zeros((0, 3), np.int64), np.zeros(0), capacity)
    triples = patterns(lengths, capacity, waste)
    return _placed_plan(lengths, bars, triples, fit_counts(triples, bars.astype(float)), capacity)


def _priced_plan(histogram: dict[int, int], capacity: int) -> Plan:
    lengths, bars = _bars(histogram)
    return _placed_plan(lengths, bars, *priced_patterns(lengths, bars, capacity), capacity)


def _placed_plan(
    lengths: np.ndarray, bars: np.ndarray, found: np.ndarray, counts: np.ndarray, capacity: int
) -> Plan:
    """Counts of patterns rounded, and the pieces that these leave packed best-fit."""
    bins: list[list] = []
    if len(lengths):
        wanted = _rounded(counts)
        sizes = np.append(lengths, 0)
        left = np.append(bars, 0)
        for pattern, many in zip(found[wanted > 0].tolist(), wanted[wanted > 0].tolist()):
            parts: dict[int, int] = {}
            for k in pattern:
                if k < len(lengths):
                    parts[k] = parts.get(k, 0) + 1
            many = min([many, *(int(left[k]) // m for k, m in parts.items())])
            if many > 0:
                for k, m in parts.items():
                    left[k] -= many * m
                content = [(int(sizes[k]), m) for k, m in parts.items()]
                room = capacity - sum(n * m for n, m in content)
                bins.append([room, many, content])
        rest = {int(n): int(c) for n, c in zip(lengths, left) if c > 0}
        bins = _best_fit(rest, bins, capacity)
    rows = []
    ranks: dict[int, int] = {}
    sequence = 0
    for _, many, content in bins:
        offset = 0
        for length, copies in content:
            rank = ranks.get(length, 0)
            rows.append(((length << 40) | rank, sequence, copies, offset))
            ranks[length] = rank + many * copies
            offset += length * copies
        sequence += many
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(*(np.ascontiguousarray(table[:, k]) for k in range(4)), sequences=sequence)


def assign_sequences(
    pieces: DataFrame, capacity: int = 2048, *, waste: int | None = None
) -> DataFrame:
    """``pieces`` (a stored table with length, part and nth) with ``sequence_id`` and
    ``offset`` in place of part and nth.

    Reads the pieces twice: once for the counts by length and task, once to place
    them.  Every sequence is filled without gaps from 0.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("_n"))
    # At most ``capacity`` rows.
    bars = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    plan = spark.sparkContext.broadcast(
        packing_plan({r["length"]: r["n"] for r in bars}, capacity, waste)
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    ranked = pieces.join(offsets, ["length", "part"]).withColumn(
        "rank", F.col("nth") + F.col("_before")
    )
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    source = ranked.select(*kept, "rank")
    schema = source.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            sequence, offset = plan.value.place(
                column("length").to_numpy(), column("rank").to_numpy()
            )
            yield pa.RecordBatch.from_arrays(
                [*(column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    return source.mapInArrow(run, schema)


def packed_sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: its ids in order (needs the ``ids`` of the pieces).

    Shuffles every id once, by sequence; a sequence has ``capacity`` ids at most.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_p")).select(
        "sequence_id",
        F.expr("aggregate(_p, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"),
        F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"),
        F.transform("_p", lambda p: p["offset"]).alias("offsets"),
    )
