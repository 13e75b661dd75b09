"""Benchmark decontamination over a distributed positional inverted index.

The index is document-sharded, as in a search cluster: every segment holds, for a few
thousand documents, its words and their posting lists (word positions).  It holds every
word and knows no test set, so it is built once and serves any number of them.  A test
window is looked up from its rarest term: the positions of that term, shifted by its
place in the window, are intersected with the shifted lists of the next rarest terms and
so on, which leaves exact phrase matches.  Windows that are not exact but have every term
within ``slack`` words of its place are proximity matches.  Segments are independent, so
a lookup shuffles nothing, and a passage that a third of all documents share is only a
longer posting list in every segment.

The test set is taken in blocks of items with a bounded number of words; a block's
vocabulary and windows are what is sent to the executors.  Each block reads the index,
never the documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daylake.llm.common import SENT_ROWS, free_name, text_blocks, sent_if_small
from daylake.session import stage

#: ASCII letters to lower case, other ASCII that is no digit to blanks; words are what
#: lies between blanks (bytes above 127 belong to words).
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

SEGMENT = (
    "rows array<long>, doc_ids array<long>, n_words array<int>, words binary,"
    " counts binary, postings binary"
)
MATCHES = (
    "row long, doc_id long, n_words long, spans array<struct<start:int,stop:int>>,"
    " items array<long>, near_items array<long>"
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text; none for null."""
    return text.translate(_FOLD).split() if text else []


def build_index(docs: DataFrame) -> DataFrame:
    """Index segments of the documents, as a stored table that any test set can use.

    ``docs`` has row, doc_id and text.  A segment has the documents of a block of text
    (or one longer document), its words (blanks between), how often each occurs, and the
    words' posting lists one after the other.  Positions count words through the segment
    and are stored as differences, which the file compression shrinks well.  Numbers are
    little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            numbers: dict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__  # a new word gets the next number
            found, sizes = [np.zeros(0, np.int32)], []
            for raw in texts.to_pylist():
                words = words_of(raw)
                sizes.append(len(words))
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            stream = np.concatenate(found)
            # Number and place in one integer sort faster than a stable order of numbers.
            positions = np.sort((stream.astype(np.int64) << 32) | np.arange(len(stream))) & 0xFFFFFFFF
            counts = np.bincount(stream, minlength=len(numbers))
            firsts = np.cumsum(counts) - counts
            steps = np.diff(positions, prepend=0)
            steps[firsts] = positions[firsts]
            index = lambda name: part.schema.get_field_index(name)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column(index("row")).to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column(index("doc_id")).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([b" ".join(numbers)], pa.binary()),
                    pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([steps.astype("<u4").tobytes()], pa.binary()),
                ],
                names=["rows", "doc_ids", "n_words", "words", "counts", "postings"],
            )

    segments = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stage(segments.mapInArrow(run, SEGMENT), "contamination-index", compression="zstd")


def _known(words: bytes, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of a segment's words that the test block has, by the block's word numbers."""
    split = words.split()
    own = np.fromiter(map(vocabulary.get, split, repeat(-1)), np.int32, len(split))
    places = np.flatnonzero(own >= 0)
    places = places[np.argsort(own[places])]
    return places, own[places]


class Windows:
    """The windows of a block of test items, ``offset`` being the places of a window's
    terms from the rarest on (a window of fewer words repeats its rarest)."""

    def __init__(self, items: list[tuple[int | None, list[int]]], size: int, frequency: np.ndarray):
        self.items = [item for item, _ in items]
        sizes = np.array([len(words) for _, words in items], np.int64)
        self.words = np.array([w for _, words in items for w in words], np.int32)
        many = np.where(sizes > size, sizes - size + 1, np.minimum(sizes, 1))
        item = np.repeat(np.arange(len(items)), many)
        length = np.minimum(sizes, size)[item]
        begin = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
        begin += (np.cumsum(sizes) - sizes)[item]
        place = np.arange(size)
        inside = place < length[:, None]
        rarity = np.full(inside.shape, np.iinfo(np.int64).max)
        rarity[inside] = frequency[self.words[(begin[:, None] + place)[inside]]]
        offset = np.argsort(rarity, axis=1, kind="stable")
        offset = np.where(inside, offset, offset[:, :1])
        # Windows by rarest term, for the merge with a segment's words.
        order = np.argsort(self.words[begin + offset[:, 0]], kind="stable")
        self.item = item[order].astype(np.int32)
        self.length = length[order]
        self.offset = offset[order].astype(np.int16 if size < 1 << 15 else np.int64)
        self.begin = begin[order]
        self.rarest = self.term(np.arange(len(order)), 0)

    def term(self, window: np.ndarray, k: int) -> np.ndarray:
        return self.words[self.begin[window] + self.offset[window, k]]


def _candidates(
    windows: Windows, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, start) from the posting lists of the windows' rarest terms, a bounded
    number at a time."""
    at = np.searchsorted(terms, windows.rarest)
    here = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == windows.rarest)
    firsts = (np.cumsum(counts) - counts)[at[here]]
    many = counts[at[here]].astype(np.int64)
    total = np.cumsum(many)
    begin = 0
    while begin < len(here):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + 2_000_000, side="right")))
        n = many[begin:end]
        window = np.repeat(here[begin:end], n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield window, positions[np.repeat(firsts[begin:end], n) + inner] - windows.offset[window, 0]
        begin = end


def _look_up(segment: dict, vocabulary: dict[bytes, int], windows: Windows, slack: int) -> Iterator[tuple]:
    """Exact spans, items and proximity items of each document of a segment."""
    sizes = np.array(segment["n_words"], np.int64)
    # A gap between documents that no window or proximity match can bridge.
    gap = 2 * slack + 1
    starts = np.cumsum(sizes + gap) - (sizes + gap)
    length = int((sizes + gap).sum())
    places, terms = _known(segment["words"], vocabulary)
    every = np.frombuffer(segment["counts"], "<u4").astype(np.int64)
    counts = every[places]
    firsts = np.cumsum(counts) - counts
    lists = np.repeat((np.cumsum(every) - every)[places] - firsts, counts) + np.arange(int(counts.sum()))
    steps = np.frombuffer(segment["postings"], "<u4")[lists].astype(np.int64)
    run = np.cumsum(steps)
    positions = run - np.repeat(run[firsts] - steps[firsts], counts) if len(terms) else run
    positions += gap * np.repeat(np.arange(len(sizes)), sizes)[positions]
    # Which list, if any, holds a position; a window may begin ``slack`` places before
    # the first word and its terms be as many away from their places.
    pad = 2 * slack
    stream = np.full(length + 2 * pad, -1, np.int32)
    stream[positions + pad] = np.repeat(terms, counts)
    edge = np.zeros(length + 1, np.int32)
    exact: list[np.ndarray] = []
    near: list[np.ndarray] = []
    n_items = max(1, len(windows.items))
    size = windows.offset.shape[1]
    for window, start in _candidates(windows, terms, counts, positions) if len(terms) else ():
        inside = (start >= -slack) & (start + windows.length[window] <= length + slack)
        window, start = window[inside], start[inside]
        w, s, missed = window, start, np.zeros(len(window), bool)
        for k in range(1, size):
            place = s + windows.offset[w, k]
            term = windows.term(w, k)
            hit = stream[place + pad] == term
            if slack:
                close = hit.copy()
                for d in range(2 * slack + 1):
                    close |= stream[place + slack + d] == term
                missed, w, s = (missed | ~hit)[close], w[close], s[close]
            else:
                w, s, missed = w[hit], s[hit], missed[hit]
        # The rarest term is at its place, so it tells the document.
        doc = np.searchsorted(starts, s + windows.offset[w, 0], side="right") - 1
        near.append((doc * n_items + windows.item[w])[missed])
        doc, w, s = doc[~missed], w[~missed], s[~missed]
        np.add.at(edge, s, 1)
        np.add.at(edge, s + windows.length[w], -1)
        exact.append(doc * n_items + windows.item[w])
    covered = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    turns = np.diff(covered)
    begins, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    span_doc = np.searchsorted(starts, begins, side="right") - 1
    spans: dict[int, list] = {}
    for d, a, b in zip(span_doc.tolist(), begins.tolist(), ends.tolist()):
        spans.setdefault(d, []).append({"start": a - int(starts[d]), "stop": b - int(starts[d])})

    def by_doc(pairs: list[np.ndarray]) -> dict[int, list[int]]:
        out: dict[int, set[int]] = {}
        for pair in np.unique(np.concatenate(pairs)).tolist() if pairs else ():
            item = windows.items[pair % n_items]
            if item is not None:
                out.setdefault(pair // n_items, set()).add(item)
        return {d: sorted(found) for d, found in out.items()}

    items, near_items = by_doc(exact), by_doc(near)
    for d, (row, doc_id, n) in enumerate(zip(segment["rows"], segment["doc_ids"], segment["n_words"])):
        own = items.get(d, [])
        others = sorted(set(near_items.get(d, ())) - set(own))
        yield row, doc_id, n, spans.get(d, []), own, others


def _item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Test items with words, in blocks; the driver holds one block at a time."""
    block, total = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        words = words_of(row["text"].encode() if row["text"] else None)
        if words:
            if block and total + len(words) > block_words:
                yield block
                block, total = [], 0
            block.append((row["item_id"], words))
            total += len(words)
    if block:
        yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, row: Column | None = None, **options
) -> DataFrame:
    """:func:`find_in_index` of an index of ``docs``, whose ``row`` is ``row``, or a number
    of the scan.  The documents are read once, whatever the size of the test set."""
    key = F.monotonically_increasing_id() if row is None else row
    return find_in_index(build_index(docs.select(key.alias("row"), "doc_id", "text")), benchmark, **options)


def find_in_index(
    index: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 13,
    slack: int = 1,
    block_words: int = 500_000,
) -> DataFrame:
    """One row per document of an index: ``row``, doc_id, n_words, ``spans`` (disjoint
    ranges of hit words), ``items`` and ``near_items`` (ascending ids).

    A window is ``window`` consecutive words of an item, or the whole of a shorter one.
    Null and empty texts have no words and match nothing; an item without words has no
    window.  Items of one id count as one; those with a null id mark words but are not
    listed.  Repeated documents get a row each.  With several blocks of items the
    blocks' rows are merged by ``row`` and doc_id.
    """
    found = None
    merged = False
    for block in _item_blocks(benchmark, block_words):
        one = _one_block(index, block, window, slack)
        merged, found = found is not None, one if found is None else found.unionByName(one)
    if found is None:
        found = _one_block(index, [], window, slack)
    if not merged:
        return found
    # Rows of one key and id have equal texts, so a set holds a list for each block at most.
    together = found.groupBy("row", "doc_id").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_set("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_set("near_items"))).alias("near_items"),
    )
    return together.select(
        "row",
        "doc_id",
        "n_words",
        _merged(F.array_sort("spans")).alias("spans"),
        F.array_sort("items").alias("items"),
        F.array_sort(F.array_except("near_items", "items")).alias("near_items"),
    )


def _merged(spans: Column) -> Column:
    """Sorted spans with touching ones joined."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"])
        return F.when(
            joins,
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))),
            ),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.slice(spans, 1, 0), add)


def _one_block(index: DataFrame, block: list, size: int, slack: int) -> DataFrame:
    spark = index.sparkSession
    numbers = {w: i for i, w in enumerate(sorted({w for _, words in block for w in words}))}
    vocabulary = spark.sparkContext.broadcast(numbers)
    frequency = np.zeros(max(1, len(numbers)), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1)):
                places, terms = _known(words.as_py(), vocabulary.value)
                many = np.frombuffer(counts.as_py(), "<u4")[places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms), pa.array(many.astype(np.int64))],
                    names=["term", "n"],
                )

    if numbers:
        seen = index.select("words", "counts").mapInArrow(count, "term int, n long")
        for row in seen.groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequency[row["term"]] = row["n"]  # one row per word of the block at most
    windows = spark.sparkContext.broadcast(
        Windows([(item, [numbers[w] for w in words]) for item, words in block], size, frequency)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["row", "doc_id", "n_words", "spans", "items", "near_items"]
        for batch in batches:
            for at in range(batch.num_rows):
                segment = batch.slice(at, 1).to_pylist()[0]
                columns = list(zip(*_look_up(segment, vocabulary.value, windows.value, slack)))
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names
                    )

    return index.mapInArrow(run, MATCHES)


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts and verdict per document from :func:`contamination`: contaminated where
    at least a twentieth of the words (and one) are hit."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.withColumns({"n_hit": hit}).select(
        "row",
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, sent_rows: int = SENT_ROWS, **options
) -> DataFrame:
    """``docs`` without contaminated ones; all columns stay.

    Verdicts are matched by doc_id and the text's hash (null-safe), so copies of a row
    share a verdict and rows that share an id do not.
    """
    text_hash = free_name(docs.columns, "_text_hash")
    bad_hash, bad_id = free_name(docs.columns, "_bad_hash"), free_name(docs.columns, "_bad_id")
    found = contamination(docs, benchmark, row=F.xxhash64("text"), **options)
    bad = (
        contamination_report(found)
        .where("contaminated")
        .select(F.col("row").alias(bad_hash), F.col("doc_id").alias(bad_id))
        .distinct()
    )
    match = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.col(text_hash) == F.col(bad_hash))
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    return hashed.join(sent_if_small(bad, "contaminated", sent_rows), match, "left_anti").drop(text_hash)
