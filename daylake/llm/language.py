"""Language identification by cross-parsing against suffix automata.

For every language a suffix automaton of labelled text is built.  A text is parsed
into the longest phrases that occur in that text; the fewer phrases it takes, weighed
by the bits that a phrase of letters drawn at random has (it grows with the logarithm of
the training text's length), the nearer the language (an estimate of the cross entropy).
So training texts of any lengths compare: on random letters all cost the same.  A letter
that a training text has not costs the bits of a symbol more.  Only the automaton's transitions are needed for parsing, so a
worker steps many blocks of text through a table of next states at once.

A block has ``BLOCK`` symbols and phrases end with a block: whole texts of any length
are parsed, in bounded memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daylake.llm.common import add_from_text, free_name
from daylake.session import stage

BLOCK = 512
UNKNOWN = "und"


class SuffixAutomaton:
    """The states and transitions that accept exactly the substrings of a text."""

    def __init__(self, symbols: list[int]) -> None:
        link, length, after = [-1], [0], [{}]
        last = 0
        for c in symbols:
            new = len(after)
            link.append(0)
            length.append(length[last] + 1)
            after.append({})
            p = last
            while p >= 0 and c not in after[p]:
                after[p][c] = new
                p = link[p]
            if p >= 0:
                q = after[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(after)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    after.append(dict(after[q]))
                    while p >= 0 and after[p].get(c) == q:
                        after[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.after = after

    def table(self, n_symbols: int) -> np.ndarray:
        """Next states by state and symbol.  Without a transition a new phrase begins:
        that is stored as -1 - (the state after the symbol from the start)."""
        start = self.after[0]
        fresh = np.array([-1 - start.get(c, 0) for c in range(n_symbols)], np.int32)
        table = np.tile(fresh, (len(self.after), 1))
        for state, moves in enumerate(self.after):
            for c, to in moves.items():
                if c < n_symbols:
                    table[state, c] = to
        return table

    def phrases(self, symbols: list[int]) -> int:
        """How many new phrases begin when the symbols are parsed."""
        state, count = 0, 0
        for c in symbols:
            to = self.after[state].get(c)
            if to is None:
                count += 1
                to = self.after[0].get(c, 0)
            state = to
        return count


class Rare:
    """Transitions of letters that have no column in a table, by state and symbol."""

    def __init__(self, automaton: SuffixAutomaton, width: int, n_symbols: int) -> None:
        moves = sorted(
            (state * n_symbols + c, to)
            for state, after in enumerate(automaton.after)
            for c, to in after.items()
            if c >= width
        )
        self.n_symbols, self.width = n_symbols, width
        self.keys = np.array([k for k, _ in moves], np.int64)
        self.to = np.array([to for _, to in moves], np.int32)
        self.fresh = np.array([-1 - automaton.after[0].get(c, 0) for c in range(width, n_symbols)], np.int32)

    def moved(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * self.n_symbols + symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], self.fresh[symbol - self.width])


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the symbol of each code point (0: no letter; the last
    symbol: a letter never seen in training).  By language: the symbols' columns in its
    table, the table, transitions of letters beyond its columns (None if there are none),
    the expected length of a phrase and its bits."""

    languages: list[str]
    columns: list[np.ndarray]
    tables: list[np.ndarray]
    rare: list[Rare | None]
    phrase_length: np.ndarray
    phrase_bits: np.ndarray
    symbol: np.ndarray


def _letter_symbols(alphabet: list[str]) -> np.ndarray:
    symbol = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    symbol = np.where(symbol, len(alphabet) + 1, 0).astype(np.int32)
    for i, letter in enumerate(alphabet):
        symbol[ord(letter)] = i + 1
    return symbol


def _symbols(texts: list[str], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of lower-cased texts, runs of other characters being one blank, and the
    number of symbols of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    codes = symbol[points]
    keep = codes > 0
    keep[1:] |= codes[:-1] > 0
    ends = np.concatenate([[0], np.cumsum(keep)])[np.cumsum(lengths)]
    return codes[keep], np.diff(np.concatenate([[0], ends]))


def fit_language_model(
    docs: DataFrame,
    *,
    rows_per_language: int = 128,
    chars_per_row: int = 150,
    max_languages: int = 256,
    dense_letters: int = 200,
) -> LanguageModel:
    """A model from labelled rows (columns lang and text; a null in either is skipped).

    Bounded sample: of each text with letters a span of ``chars_per_row`` characters, for
    each language the ``rows_per_language`` distinct spans with least hashes.  A span
    begins anywhere in its text, by the text's hash; so headers that many texts share
    have their share only, and equal spans count once.  More than ``max_languages``
    labels are an error.  All letters of the sample have symbols of their own; the
    ``dense_letters`` most frequent ones of a language are kept in a dense table.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", _span(F.col("text"), chars_per_row).alias("text")
    )
    hashed = labelled.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.lit(1).alias("one"))
    # First within parts of a language, so that a language with most of the rows is
    # never ranked in one task.
    part = F.pmod("h", F.lit(128))
    for keys in (["lang", part], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("h")
        ranked = hashed.withColumn("n", F.row_number().over(order))
        hashed = ranked.where(F.col("n") <= rows_per_language).drop("n")
    picked = stage(hashed, "language-sample")
    n_languages = len(picked.select("lang").distinct().take(max_languages + 1))
    if n_languages > max_languages:
        raise ValueError(f"more than {max_languages} language labels")
    # At most rows_per_language * max_languages rows: small enough to send everywhere.
    wanted = F.broadcast(picked.select(F.col("lang").alias("_lang"), F.col("h").alias("_h")))
    same = (F.col("lang") == F.col("_lang")) & (F.xxhash64("text") == F.col("_h"))
    rows = (
        labelled.join(wanted, same)
        .groupBy("_lang", "_h")
        .agg(F.min("text").alias("text"))
        .orderBy("_lang", "_h")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row["_lang"], []).append(row["text"].lower())
    return language_model(texts, dense_letters)


def _span(text: Column, size: int) -> Column:
    """``size`` characters of a text with letters, from a place given by its hash; from
    its first letter if there is none among them."""
    places = F.greatest(F.length(text) - size + 1, F.lit(1))
    span = F.substring(text, (F.pmod(F.xxhash64(text, F.lit(1)), places) + 1).cast("int"), F.lit(size))
    lettered = F.substring(F.regexp_extract(text, r"\p{L}[\s\S]*", 0), 1, size)
    return F.when(span.rlike(r"\p{L}"), span).otherwise(lettered)


def language_model(texts: dict[str, list[str]], dense_letters: int = 200) -> LanguageModel:
    """A model from lower-case texts by language, of any total lengths."""
    alphabet = sorted({c for some in texts.values() for t in some for c in t if c.isalpha()})
    symbol = _letter_symbols(alphabet)
    parts = {
        lang: _symbols([" ".join(texts[lang]) + " "], symbol)[0] for lang in sorted(texts)
    }
    # The last symbol is of letters that no training text has: they never match.
    n_symbols = len(alphabet) + 2
    columns, tables, rare, own = [], [], [], []
    probe = _drawn(parts, PROBE, seed=1)
    for codes in parts.values():
        letters, times = np.unique(codes[codes > 0], return_counts=True)
        letters = letters[np.argsort(-times, kind="stable")]
        width = min(len(letters), dense_letters) + 2
        column = np.full(n_symbols, width - 1, np.int32)  # of letters this language has not
        column[0] = 0
        column[letters[: width - 2]] = np.arange(1, width - 1)
        column[letters[width - 2 :]] = np.arange(width, len(letters) + 2)
        automaton = SuffixAutomaton(column[codes].tolist())
        columns.append(column)
        tables.append(automaton.table(width))
        rare.append(Rare(automaton, width, len(letters) + 2) if len(letters) + 2 > width else None)
        own.append(len(probe) / max(1, automaton.phrases(column[probe].tolist())))
    length, bits = _phrase_measures(parts, probe, np.array(own))
    return LanguageModel(list(parts), columns, tables, rare, length, bits, symbol)


#: Symbols drawn at random to see how long phrases of them get.
PROBE = 4096


def _drawn(parts: dict[str, np.ndarray], n: int, seed: int) -> np.ndarray:
    """Symbols drawn at random from all training texts."""
    pool = np.concatenate([*parts.values(), np.zeros(0, np.int32)])
    return np.random.default_rng(seed).choice(pool, n) if len(pool) else pool


def _phrase_measures(parts: dict[str, np.ndarray], probe: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length and bits by language of the phrases of random symbols.

    The length is that for a random training text as long as the language's, or that
    for its own (``own``), if longer: a few frequent letters match more than others.
    """
    if not parts:
        return np.zeros(0), np.zeros(0)
    lengths = np.array([max(2, len(c)) for c in parts.values()])
    sizes = 2 ** np.arange(1, int(np.ceil(np.log2(lengths.max()))) + 1)
    source = _drawn(parts, int(sizes[-1]), seed=0).tolist()
    usual = [len(probe) / max(1, SuffixAutomaton(source[:n]).phrases(probe.tolist())) for n in sizes.tolist()]
    length = np.maximum(np.interp(np.log2(lengths), np.log2(sizes), np.maximum.accumulate(usual)), own)
    share = np.unique(np.concatenate(list(parts.values())), return_counts=True)[1]
    share = share / share.sum()
    return length, length * max(1.0, float(-(share * np.log2(share)).sum()))


def predict(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; see :func:`identify_language`."""
    lowered = [t.lower() if t else "" for t in texts]
    codes, lengths = _symbols(lowered, model.symbol)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    letters = np.concatenate([[0], np.cumsum(codes > 0)])
    has_letters = letters[ends] > letters[starts]
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    # Blocks of all texts as columns, longest first, so that ended ones drop off.
    per_text = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = starts[owner] + nth * BLOCK
    size = np.minimum(ends[owner] - begin, BLOCK)
    order = np.argsort(-size, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    cost = np.zeros((len(model.languages), len(texts)))
    for at in range(0, len(owner), 4096):
        o, b, s = owner[at : at + 4096], begin[at : at + 4096], size[at : at + 4096]
        places = b[None, :] + np.arange(int(s[0]))[:, None]
        inside = np.arange(int(s[0]))[:, None] < s[None, :]
        lanes = codes.take(np.where(inside, places, 0)).astype(np.int32)
        alive = inside.sum(axis=1)
        for k, table in enumerate(model.tables):
            flat, width, rare = table.ravel(), table.shape[1], model.rare[k]
            local = model.columns[k].take(lanes)
            state = np.zeros(len(s), np.int32)
            count = np.zeros(len(s), np.int32)
            strange = np.zeros(len(s), np.int32)
            last = np.zeros(len(s), np.int32)  # where the last phrase begins
            for t, (row, n) in enumerate(zip(local, alive.tolist())):
                if rare is None:
                    moved = flat.take(state[:n] * width + row[:n])
                else:
                    moved = flat.take(state[:n] * width + np.minimum(row[:n], width - 1))
                    beyond = np.flatnonzero(row[:n] >= width)
                    if len(beyond):
                        moved[beyond] = rare.moved(state[beyond], row[beyond])
                new = moved < 0
                count[:n] += new
                strange[:n] += moved == -1
                last[:n][new] = t
                state[:n] = np.maximum(moved, -1 - moved)
            # The last phrase is cut by the end: it counts by its length.
            rest = np.minimum(1.0, (s - last) / model.phrase_length[k])
            bits = (count + rest) * model.phrase_bits[k] + strange * np.log2(len(model.columns[k]))
            cost[k] += np.bincount(o, bits, minlength=len(texts))
    best = np.argmin(cost, axis=0)
    least = cost[best, np.arange(len(texts))]
    others = cost.copy()
    others[best, np.arange(len(texts))] = np.inf
    second = others.min(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        score = np.where(np.isinf(second), 1.0, 1.0 - least / (least + second))
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letters)]
    return names, np.where(has_letters, score, 0.0)


def identify_language(
    docs: DataFrame, model: LanguageModel, *, lang_column: str = "lang_pred", score_column: str = "score"
) -> DataFrame:
    """``docs`` with the predicted language and a score.

    ``und`` with score 0 for null texts and texts without a letter.  The score is the
    share of the runner-up's cost in the two least costs: 0.5 for a tie (the first
    language by name wins), towards 1 the clearer the case, 1 with a single language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(texts: pa.Array):
            return predict(shared.value, texts.cast(pa.large_string()).to_pylist())

        return work

    return add_from_text(
        docs,
        [(lang_column, "string", pa.string()), (score_column, "double", pa.float64())],
        make,
    )


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without null texts and texts without a letter, the ones whose language is
    ``und`` where any language was learnt, and with what was identified as their ``lang``.

    Other columns stay as they are; a frame without ``lang`` gets none.  Where no language
    was learnt, labels stay as they are, too.
    """
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang = free_name(docs.columns, "_lang_pred")
    score = free_name(docs.columns, "_lang_score")
    named = identify_language(docs, model, lang_column=lang, score_column=score)
    kept = named.where(F.col(lang) != UNKNOWN)
    if "lang" in docs.columns:
        kept = kept.withColumn("lang", F.col(lang))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
