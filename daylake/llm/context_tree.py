"""Scores of texts by context-tree weighting.

A byte is eight binary decisions, and each decision has a tree over the bytes before it,
the last byte first.  A node counts the zeros and ones that followed its context in the
training texts.  Its Krichevsky-Trofimov estimate is weighed against what its children
(longer contexts) make of the same decisions, half and half by evidence, so that every
depth from 0 to ``DEPTH`` has its share in a probability.

Nothing that grows with the corpus is held whole anywhere.  Texts are cut into blocks; a
block lists its distinct grams (a context and the byte after it) and words, with their
training counts, by part.  A part holds all contexts that end in some two bytes, that is
whole subtrees, and adds up the counts of all blocks.  The tree above them (contexts of
no or one byte) has at most 256 * 255 nodes and goes through the driver.  Parts then
answer each block with the log-probabilities of its grams and the counts of its words,
and the block's texts are scored with these.  Lists travel as compressed arrays.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from daylake.llm.common import held_out, text_blocks
from daylake.session import stage, working_dir

#: Bytes of context; a gram is DEPTH + 1 bytes of a 64-bit number.
DEPTH = 5
#: Bytes that no UTF-8 text has: before a text's start, and at its end.
_START, _END = 0xFF, 0xFE
#: A block ends when it lists so many grams or words (one slice of texts may pass it).
BLOCK_ENTRIES = 2_000_000
#: Text of one row of a block.
SLICE_BYTES = 2_000_000

_ROW = "kind string, block long, part int, n long, a binary, b binary"
_UPPER = bytes(range(65, 91))
_LOWERING = bytes.maketrans(_UPPER, _UPPER.lower())


# ------------------------------------------------------------------ packed arrays


def _pack(values: np.ndarray) -> bytes:
    """The array's bytes, equal places together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _pack_words(words: list[bytes]) -> bytes:
    """Words have no line ends."""
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def _unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


# ------------------------------------------------------------------ grams


def grams(text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The grams of some texts (their bytes one after the other), each text's end
    included: from the highest byte the context, last byte first, then the byte itself."""
    n, total = len(lengths), len(text)
    gap = DEPTH + 1
    padded = np.full(total + n * gap + DEPTH, _START, np.uint8)
    shift = np.repeat(np.arange(n) * gap + DEPTH, lengths)
    padded[np.arange(total) + shift] = text
    ends = np.cumsum(lengths) + np.arange(n) * gap + DEPTH
    padded[ends] = _END
    stop = len(padded) - DEPTH
    wide = padded.astype(np.uint64)
    made = wide[DEPTH - 1 : stop - 1].copy()
    for back in range(2, DEPTH + 1):
        made <<= np.uint64(8)
        made |= wide[DEPTH - back : stop - back]
    made <<= np.uint64(8)
    made |= wide[DEPTH:stop]
    return made[padded[DEPTH:stop] != _START]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


class GramCounts:
    """A growing sum of gram counts, compacted now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.loose += len(keys)
        if len(self.parts) > 1 and self.loose > 2 * len(self.parts[0][0]) + 200_000:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = [_summed(keys, counts)]
        self.loose = 0
        return self.parts[0]


def _part_of_gram(keys: np.ndarray, parts: int) -> np.ndarray:
    """By the last two bytes of the context."""
    near = keys >> np.uint64(8 * (DEPTH - 1))
    return ((near * np.uint64(2654435761)) >> np.uint64(12)) % np.uint64(parts)


def _blocks(parts: int):
    """Texts to blocks: rows of text, and rows of grams and words by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        seen, words = GramCounts(), Counter()

        def rows(made: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "block", "part", "n", "a", "b"])

        def lists() -> Iterator[pa.RecordBatch]:
            keys, counts = seen.total()
            by = _part_of_gram(keys, parts)
            made = []
            for part in np.unique(by).tolist():
                mine = by == part
                made.append(("gram", number, part, int(mine.sum()), _pack_sorted(keys[mine]), _pack(counts[mine])))
            dealt: dict[int, list[bytes]] = {}
            for word in words:
                dealt.setdefault(zlib.crc32(word) % parts, []).append(word)
            for part, mine in dealt.items():
                mine.sort()
                counts = np.array([words[w] for w in mine], np.int64)
                made.append(("word", number, part, len(mine), _pack_words(mine), _pack(counts)))
            for i in range(0, len(made), 64):
                yield rows(made[i : i + 64])

        for batch, texts in text_blocks(batches, "text", SLICE_BYTES):
            held = batch.column(batch.schema.get_field_index("held")).to_numpy(zero_copy_only=False).astype(bool)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            lower = [(t or b"").translate(_LOWERING) for t in texts.to_pylist()]
            lengths = np.array([len(t) for t in lower], np.int64)
            text = b"".join(lower)
            made = grams(np.frombuffer(text, np.uint8), lengths)
            learns = np.repeat(~held, lengths + 1)
            for mine, one in ((learns, 1), (~learns, 0)):
                keys, counts = np.unique(made[mine], return_counts=True)
                seen.add(keys, counts * one)
            for t, out in zip(lower, held.tolist()):
                if out:
                    for w in t.split():
                        words.setdefault(w, 0)
                else:
                    words.update(t.split())
            head = [ids.fill_null(0).to_numpy().astype(np.int64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), held.astype(np.int64), lengths]
            packed = zstandard.ZstdCompressor(level=3).compress(text)
            yield rows([("text", number, -1, int((~held).sum()), packed, _pack(np.concatenate(head)))])
            if len(words) > BLOCK_ENTRIES or (seen.loose > BLOCK_ENTRIES and len(seen.total()[0]) > BLOCK_ENTRIES):
                yield from lists()
                number, seen, words = number + 1, GramCounts(), Counter()
        if seen.parts:
            yield from lists()

    return run


# ------------------------------------------------------------------ the tree


_TABLE = 1 << 16
_LOG_HALF = math.log(0.5)


def _log_gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """log of Gamma(n + 1/2) and of Gamma(n + 1) for small n."""
    n = np.arange(1, _TABLE)
    half = np.concatenate([[0.5 * math.log(math.pi)], 0.5 * math.log(math.pi) + np.cumsum(np.log(n - 0.5))])
    return half, np.concatenate([[0.0], np.cumsum(np.log(n))])


_GAMMA: list[np.ndarray] = []


def _log_gamma(n: np.ndarray, half: bool) -> np.ndarray:
    """log Gamma(n + 1/2) or log Gamma(n + 1), by Stirling's series for large n."""
    if not _GAMMA:
        _GAMMA.extend(_log_gamma_tables())
    out = _GAMMA[0 if half else 1][np.minimum(n, _TABLE - 1)]
    large = n >= _TABLE
    if large.any():
        x = n[large] + (0.5 if half else 1.0)
        out[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov estimate of so many zeros and ones."""
    return _log_gamma(zeros, True) + _log_gamma(ones, True) - _log_gamma(zeros + ones, False) - math.log(math.pi)


class Nodes:
    """The nodes of one depth, by decision: counts, estimate and weighted estimate.

    ``keys`` are (context, byte) in order, so the bytes below a decision stand together.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.group, self.first = keys, [], []
        self.zeros, self.ones, self.kt, self.weighted = [], [], [], []
        for j in range(8):
            above = keys >> np.uint64(8 - j)
            new = np.diff(above, prepend=~above[:1]) != 0
            first = np.flatnonzero(new)
            bit = (keys >> np.uint64(7 - j)) & np.uint64(1)
            total = np.add.reduceat(counts, first)
            ones = np.add.reduceat(counts * bit.astype(np.int64), first)
            self.group.append(np.cumsum(new) - 1)
            self.first.append(first)
            self.zeros.append(total - ones)
            self.ones.append(ones)
            self.kt.append(log_kt(total - ones, ones))


def subtrees(keys: np.ndarray, counts: np.ndarray, least: int) -> tuple[dict[int, Nodes], dict[int, np.ndarray]]:
    """The depths from ``DEPTH`` up to ``least``, and for each depth below the place of
    its (context, byte) in the depth above."""
    nodes, up = {DEPTH: Nodes(keys, counts)}, {}
    for depth in range(DEPTH - 1, least - 1, -1):
        shorter = (keys >> np.uint64(16) << np.uint64(8)) | (keys & np.uint64(255))
        keys, up[depth + 1] = np.unique(shorter, return_inverse=True)
        counts = np.bincount(up[depth + 1], counts, len(keys)).astype(np.int64)
        nodes[depth] = Nodes(keys, counts)
    nodes[DEPTH].weighted = nodes[DEPTH].kt
    for depth in range(DEPTH - 1, least - 1, -1):
        here, below = nodes[depth], nodes[depth + 1]
        for j in range(8):
            parent = here.group[j][up[depth + 1][below.first[j]]]
            children = np.bincount(parent, below.weighted[j], len(here.kt[j]))
            here.weighted.append(np.logaddexp(here.kt[j], children) + _LOG_HALF)
    return nodes, up


def _node_number(keys: np.ndarray, j: int) -> np.ndarray:
    """Bits before decision ``j`` of the byte, with a leading one: 1 to 255."""
    byte = (keys & np.uint64(255)).astype(np.int64)
    return (1 << j) | (byte >> (8 - j))


def near_root(keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """(last byte, decision, zeros, ones, weighted) summed over a part's contexts of two
    bytes."""
    nodes = subtrees(keys, counts, 2)[0][2]
    columns = []
    for j in range(8):
        at = nodes.keys[nodes.first[j]]
        last = (at >> np.uint64(16)).astype(np.int64)
        columns.append((last << 8 | _node_number(at, j), nodes.zeros[j], nodes.ones[j], nodes.weighted[j]))
    key, zeros, ones, weighted = (np.concatenate(x) for x in zip(*columns))
    kept, at = np.unique(key, return_inverse=True)
    sums = [np.bincount(at, x) for x in (zeros, ones, weighted)]
    return [(int(k) >> 8, int(k) & 255, int(z), int(o), float(w)) for k, z, o, w in zip(kept, *sums)]


def top_weights(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """From the sums of all parts, by last byte and decision: the share of a one that the
    contexts of no and of one byte give, and the weight that is left for longer ones; and
    likewise of a zero (first index)."""
    zeros, ones, children = (np.zeros((256, 256)) for _ in range(3))
    for last, node, z, o, w in rows:
        zeros[last, node], ones[last, node], children[last, node] = z, o, w
    zeros, ones = zeros.astype(np.int64), ones.astype(np.int64)
    kt = log_kt(zeros, ones)
    weighted = np.logaddexp(kt, children) + _LOG_HALF
    own = np.exp(kt + _LOG_HALF - weighted)
    z0, o0 = zeros.sum(axis=0), ones.sum(axis=0)
    kt0 = log_kt(z0, o0)
    own0 = np.exp(kt0 + _LOG_HALF - (np.logaddexp(kt0, weighted.sum(axis=0)) + _LOG_HALF))
    share = np.empty((2, 256, 256))
    for bit, (c, c0) in enumerate(((zeros, z0), (ones, o0))):
        share[bit] = own0 * (c0 + 0.5) / (z0 + o0 + 1) + (1 - own0) * own * (c + 0.5) / (zeros + ones + 1)
    return share, (1 - own0) * (1 - own)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, share: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each gram's last byte after its context, for all
    grams of some contexts of two bytes."""
    nodes, up = subtrees(keys, counts, 2)
    byte = (keys & np.uint64(255)).astype(np.int64)
    last = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)
    place = {DEPTH: np.arange(len(keys))}
    for depth in range(DEPTH, 2, -1):
        place[depth - 1] = up[depth][place[depth]]
    out = np.zeros(len(keys))
    for j in range(8):
        bit = (byte >> (7 - j)) & 1
        number = (1 << j) | (byte >> (8 - j))
        p, rest = share[bit, last, number], left[last, number]
        for depth in range(2, DEPTH + 1):
            here = nodes[depth]
            at = here.group[j][place[depth]]
            zeros, ones = here.zeros[j][at], here.ones[j][at]
            kt = (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)
            if depth == DEPTH:
                p = p + rest * kt
            else:
                own = np.exp(here.kt[j][at] + _LOG_HALF - here.weighted[j][at])
                p, rest = p + rest * own * kt, rest * (1 - own)
        out += np.log(p)
    return out


# ------------------------------------------------------------------ parts and blocks


def _columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _totals_of_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their part: the part's grams with the counts of all blocks."""
    part, seen = None, GramCounts()

    def row() -> pa.RecordBatch:
        keys, counts = seen.total()
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([_pack_sorted(keys)]), pa.array([_pack(counts)])],
            names=["part", "a", "b"],
        )

    for batch in batches:
        for p, a, b in _columns(batch, "part", "a", "b"):
            if p != part and part is not None:
                yield row()
                seen = GramCounts()
            part = p
            seen.add(_unpack_sorted(a), _unpack(b, np.int64))
    if part is not None:
        yield row()


def _totals_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Likewise for words, with the number and the sum of those that training texts have."""
    part, seen = None, Counter()

    def row() -> pa.RecordBatch:
        words = sorted(w for w, c in seen.items() if c)
        counts = np.array([seen[w] for w in words], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([_pack_words(words)]),
                pa.array([_pack(counts)]),
                pa.array([len(words)], pa.int64()),
                pa.array([int(counts.sum())], pa.int64()),
            ],
            names=["part", "a", "b", "distinct", "total"],
        )

    for batch in batches:
        for p, a, b in _columns(batch, "part", "a", "b"):
            if p != part and part is not None:
                yield row()
                seen = Counter()
            part = p
            for word, count in zip(_unpack_words(a), _unpack(b, np.int64).tolist()):
                seen[word] += count
    if part is not None:
        yield row()


def _near_root_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["last", "node", "zeros", "ones", "weighted"]
    for batch in batches:
        for a, b in _columns(batch, "a", "b"):
            rows = near_root(_unpack_sorted(a), _unpack(b, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def _answers(share: np.ndarray, left: np.ndarray):
    """Rows in order of part, a part's totals first: what each block asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, words = None, None, {}
        for batch in batches:
            for kind, block, asks, a, b in _columns(batch, "kind", "block", "asks", "a", "b"):
                if not asks and kind == "gram":
                    keys = _unpack_sorted(a)
                    values = log_probabilities(keys, _unpack(b, np.int64), share, left)
                elif not asks:
                    words = dict(zip(_unpack_words(a), _unpack(b, np.int64).tolist()))
                else:
                    if kind == "gram":
                        found = values[np.searchsorted(keys, _unpack_sorted(a))]
                    else:
                        found = np.array([words.get(w, 0) for w in _unpack_words(a)], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind]), pa.array([block]), pa.array([a], pa.binary()), pa.array([_pack(found)], pa.binary())],
                        names=["kind", "block", "a", "b"],
                    )

    return run


class Lookup:
    """Places of 64-bit keys, by open addressing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys, self.bits = keys, max(4, int(4 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.table[slot] < 0
            self.table[slot[free]] = todo[free]
            lost = self.table[slot] != todo
            todo, slot = todo[lost], (slot[lost] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Every one of ``keys`` must be there."""
        out = np.empty(len(keys), np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            at = self.table[slot]
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = at[hit]
            todo, slot = todo[~hit], (slot[~hit] + 1) & (len(self.table) - 1)
        return out


def _scores(tokens: int, distinct: int, ends: int):
    """Rows in order of block, its answers before its texts: the scores of the texts."""
    below = tokens + distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, values, words, lookup = None, [], [], {}, None
        end = math.log10((ends + 1) / below)
        for batch in batches:
            for kind, number, a, b in _columns(batch, "kind", "block", "a", "b"):
                if number != block:
                    block, keys, values, words, lookup = number, [], [], {}, None
                if kind == "gram":
                    keys.append(_unpack_sorted(a))
                    values.append(_unpack(b, np.float64))
                elif kind == "word":
                    words.update(zip(_unpack_words(a), _unpack(b, np.int64).tolist()))
                else:
                    if lookup is None:
                        lookup, value = Lookup(np.concatenate(keys)), np.concatenate(values) / math.log(10)
                        keys, values = [], []
                    text = zstandard.ZstdDecompressor().decompress(a)
                    ids, null, held, lengths = _unpack(b, np.int64).reshape(4, -1)
                    logs = value[lookup.find(grams(np.frombuffer(text, np.uint8), lengths))]
                    starts = np.cumsum(lengths + 1) - lengths - 1
                    stops = np.cumsum(lengths)
                    rows = []
                    for start, stop in zip((stops - lengths).tolist(), stops.tolist()):
                        counts = np.array([words[w] for w in text[start:stop].split()], np.float64)
                        rows.append((len(counts) + 1, int((counts > 0).sum()) + (ends > 0), float(np.log10((counts + 1) / below).sum()) + end))
                    columns = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, mask=null == 1),
                            pa.array(held == 1),
                            *(pa.array(c) for c in columns),
                            pa.array(np.add.reduceat(logs, starts)),
                        ],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                    )

    return run


def score_texts(docs: DataFrame, *, modulus: int = 7, remainder: int = 2, parts: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learns from whole texts whose id is not held out (crc32 of the id modulo ``modulus``
    is not ``remainder``; a null id is not held out).  A-Z count in lower case, a null text
    as empty.  ``score`` is the log10 probability of the text's bytes and its end, each
    byte given the ``DEPTH`` before it; without training texts every bit counts a half.
    ``base_score`` is the add-one estimate of the tokens: blank-separated words and one
    end, which is known as soon as there is a training text.  Rows are kept as they are,
    equal ones too; an empty table gives no rows.  ``parts`` (the session's number of
    shuffle partitions) is how many groups the statistics are dealt to.
    """
    spark = docs.sparkSession
    parts = parts or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(modulus, remainder).alias("held")
    )
    path = working_dir(spark, "context-blocks")
    wanted.mapInArrow(_blocks(parts), _ROW).write.partitionBy("kind").option("compression", "none").parquet(path)
    rows = spark.read.schema(_ROW).parquet(path)
    asked = {kind: rows.where(F.col("kind") == kind) for kind in ("gram", "word", "text")}

    def by_part(df: DataFrame, *then: str) -> DataFrame:
        return df.repartition(parts, "part").sortWithinPartitions("part", *then)

    totals = {
        "gram": stage(
            by_part(asked["gram"].select("part", "a", "b")).mapInArrow(_totals_of_grams, "part int, a binary, b binary"),
            "context-grams",
        ),
        "word": stage(
            by_part(asked["word"].select("part", "a", "b")).mapInArrow(
                _totals_of_words, "part int, a binary, b binary, distinct long, total long"
            ),
            "context-words",
        ),
    }
    ends = asked["text"].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known, total = totals["word"].agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    # At most 256 * 255 rows; a row sums at most 256 values, in a fixed order.
    near = (
        totals["gram"]
        .mapInArrow(_near_root_rows, "last long, node long, zeros long, ones long, weighted double")
        .groupBy("last", "node")
        .agg(F.sum("zeros"), F.sum("ones"), F.array_sort(F.collect_list("weighted")).alias("weighted"))
        .collect()
    )
    share, left = top_weights([(*r[:4], math.fsum(r[4])) for r in near])

    def answered(kind: str) -> DataFrame:
        heads = totals[kind].select(F.lit(kind).alias("kind"), F.lit(-1).cast("long").alias("block"), "part", F.lit(0).alias("asks"), "a", "b")
        asks = asked[kind].select("kind", "block", "part", F.lit(1).alias("asks"), "a", F.lit(None).cast("binary").alias("b"))
        return by_part(heads.union(asks), "asks").mapInArrow(
            _answers(share, left), "kind string, block long, a binary, b binary"
        )

    texts = asked["text"].select("kind", "block", "a", "b", F.lit(1).alias("last"))
    found = answered("gram").union(answered("word")).select("kind", "block", "a", "b", F.lit(0).alias("last"))
    tokens, distinct = int(total) + int(ends), int(known) + (ends > 0)
    scored = (
        found.union(texts)
        .repartition("block")
        .sortWithinPartitions("block", "last")
        .mapInArrow(
            _scores(tokens, distinct, int(ends)),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
