"""Quality scores: boosted trees over statistics of whole documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daylake.llm.boosting import BoostedTrees, fit_trees
from daylake.llm.common import add_from_text
from daylake.llm.labelled import labelled_sample

FEATURES = (
    "bytes_log",
    "words_log",
    "word_bytes",
    "long_words",
    "short_words",
    "lower",
    "upper",
    "digits",
    "blanks",
    "non_ascii",
    "punctuation",
    "symbols",
    "bars",
    "sentence_ends",
    "commas",
    "distinct_words",
    "repeated_neighbours",
    "commonest_word",
    "lines_log",
    "distinct_lines",
    "line_words",
    "words_with_symbols",
)


def _class_of(byte: int) -> int:
    c = chr(byte)
    if byte > 127:
        return 4
    for i, members in ((7, "|"), (8, ".?!"), (9, ",;:")):
        if c in members:
            return i
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c.isspace():
        return 3
    if c in "'\"()-":
        return 5
    return 6


_CLASS = np.array([_class_of(b) for b in range(256)], np.uint8)
#: Words that are no letters but signs would be found by these.
_SYMBOLS = bytes.maketrans(
    bytes(range(256)), bytes(1 if _class_of(b) in (6, 7) else 0 for b in range(256))
)


def statistics(text: bytes | None) -> list[float]:
    """Features of a text in the order of :data:`FEATURES`; zeros for null or empty."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=10) / n
    words = text.split()
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    lines = text.split(b"\n")
    flagged = text.translate(_SYMBOLS)
    marked = sum(1 in w for w in _cut(flagged, text)) if 1 in flagged else 0
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(sizes.mean()) if len(words) else 0.0,
        float((sizes > 12).sum() / m),
        float((sizes < 3).sum() / m),
        *(float(kinds[k]) for k in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9)),
        len(counts) / m,
        repeated / m,
        max(counts.values(), default=0) / m,
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        m / len(lines),
        marked / m,
    ]


def _cut(flags: bytes, text: bytes):
    """The flags of each word."""
    at = 0
    for word in text.split():
        at = text.index(word, at)
        yield flags[at : at + len(word)]
        at += len(word)


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [statistics(t) for t in texts.to_pylist()]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = 20_000,
    modulus: int = 4,
    remainder: int = 2,
    **options,
) -> BoostedTrees:
    """Trees from a bounded sample (``rows``) of labelled documents; ids whose crc32 has
    the remainder are never learnt from.  Only features reach the driver."""
    sample = labelled_sample(docs, labels, "quality", rows=rows, modulus=modulus, remainder=remainder)

    def make():
        return lambda texts: (pa.array(list(_matrix(texts)), pa.list_(pa.float64())),)

    featured = add_from_text(sample, [("x", "array<double>", pa.list_(pa.float64()))], make)
    table = featured.select("doc_id", "x", "y").orderBy("doc_id").toArrow()
    y = table.column("y").to_numpy().astype(np.float64)
    x = np.array(table.column("x").to_pylist(), np.float64).reshape(len(y), len(FEATURES))
    return fit_trees(x, y, **options)


def score_quality(docs: DataFrame, model: BoostedTrees, *, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: better).  Null and empty texts have the
    statistics zero and are scored like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: (shared.value.score(_matrix(texts)),)

    return add_from_text(docs, [(column, "double", pa.float64())], make)
