"""Toxicity: a lexicon trie met by Levenshtein automata, and the words around a hit.

The lexicon is learnt: words and word stems with a higher text share in toxic than in
other labelled texts, chosen so that each explains texts that no other one does.  Those
that other texts hold as well are kept apart and count by their evidence.  The trie
of the lexicon and the Levenshtein automata of its terms are intersected once into one
deterministic automaton, which reads a word letter by letter and accepts it if it is a
term, begins with a stem, or is a long enough term with one letter replaced, left out
or added.  Workers step all words of a block through its table at once; most words
leave it after three letters.

Hits in quotation marks or among reporting words ("said", "called") count separately,
so that quoting and abusing can weigh differently; the weights come from a logistic
regression on the sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daylake.llm.common import add_from_text, text_blocks
from daylake.llm.labelled import labelled_sample
from daylake.session import stage

#: A term may have one wrong letter if it is at least so long.
FUZZY_LENGTH = 5
STEMS = range(4, 9)
CONTEXT = 4
# Words that report speech (fixed values).
REPORTING = "said says say called calls wrote quote quoted word term phrase dijo dit sagte wort mot palabra".split()
#: Digits and signs that stand for letters (fixed values).
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_LETTERS = str.maketrans(_LOOKALIKE)


def _word_table() -> np.ndarray:
    """For every code point whether it can be part of a word."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    for c in _LOOKALIKE:
        table[ord(c)] = True
    return table


def words_of(points: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words in an array of code points."""
    inside = is_word[points]
    turn = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


# --- the automaton ------------------------------------------------------------------


@dataclass(frozen=True)
class WordAutomaton:
    """``table`` has the next state by state and symbol (0: dead, 1: start); ``verdict``
    says by state what a word ending there is: 0 nothing, 1 a term, 2 it began with a
    stem (also on the way), 3 one letter off a term."""

    symbols: str
    table: np.ndarray
    verdict: np.ndarray


def build_automaton(
    terms: list[str],
    stems: list[str],
    fuzzy_length: int = FUZZY_LENGTH,
    exact: frozenset[str] = frozenset(),
) -> WordAutomaton:
    """Subset construction over (trie node, errors so far) of terms and stems; terms that
    are ``exact`` have no errors."""
    children: list[dict[str, int]] = [{}]
    kind = [0]
    fuzzy_below = [False]
    for words, is_stem in ((terms, False), (stems, True)):
        for word in words:
            may = not is_stem and len(word) >= fuzzy_length and word not in exact
            node = 0
            fuzzy_below[0] |= may
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    kind.append(0)
                    fuzzy_below.append(False)
                node = children[node][c]
                fuzzy_below[node] |= may
            kind[node] |= (2 if is_stem else 1) | (4 if may else 0)
    alphabet = sorted({c for node in children for c in node})

    def closed(states: set[tuple[int, int]]) -> frozenset:
        """With the letters that the word may have left out."""
        found = set(states)
        for node, errors in states:
            if errors == 0:
                found |= {(child, 1) for child in children[node].values() if fuzzy_below[child]}
        return frozenset((n, e) for n, e in found if e == 0 or (n, 0) not in found)

    def step(states: frozenset, c: str | None) -> frozenset:
        moved = set()
        for node, errors in states:
            if c in children[node]:
                child = children[node][c]
                if errors == 0 or fuzzy_below[child]:
                    moved.add((child, errors))
            if errors == 0:
                if fuzzy_below[node]:
                    moved.add((node, 1))  # a letter too many
                moved |= {(n, 1) for n in children[node].values() if fuzzy_below[n]}
        return closed(moved)

    found_stem = frozenset([(-1, 0)])
    start = closed({(0, 0)})
    numbers = {frozenset(): 0, start: 1}
    order = [frozenset(), start]
    rows: list[list[int]] = []
    at = 0
    while at < len(order):
        states = order[at]
        at += 1
        row = []
        for c in [None, *alphabet]:
            if states == found_stem:
                new = states
            elif not states:
                new = frozenset()
            else:
                new = step(states, c)
                if any(e == 0 and kind[n] & 2 for n, e in new):
                    new = found_stem
            if new not in numbers:
                numbers[new] = len(order)
                order.append(new)
            row.append(numbers[new])
        rows.append(row)
    verdict = []
    for states in order:
        if states == found_stem:
            verdict.append(2)
        elif any(e == 0 and kind[n] & 1 for n, e in states):
            verdict.append(1)
        elif any(e == 1 and kind[n] & 4 for n, e in states):
            verdict.append(3)
        else:
            verdict.append(0)
    return WordAutomaton("".join(alphabet), np.array(rows, np.int32), np.array(verdict, np.int8))


def match_words(
    automaton: WordAutomaton, symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray
) -> np.ndarray:
    """Verdict of each word; ``symbols`` are the automaton's, 0 for other letters."""
    verdict = np.zeros(len(begins), np.int8)
    alive = np.arange(len(begins))
    state = np.ones(len(begins), np.int32)
    place, stop = begins.copy(), ends
    width = automaton.table.shape[1]
    flat = automaton.table.ravel()
    while len(alive):
        state = flat[state * width + symbols[place]]
        place = place + 1
        # A found stem needs no further letters.
        over = (place == stop[alive]) | (automaton.verdict[state] == 2)
        verdict[alive[over]] = automaton.verdict[state[over]]
        go = ~over & (state > 0)
        alive, state, place = alive[go], state[go], place[go]
    return verdict


# --- features and the model -----------------------------------------------------------

#: Shared hits are of terms and stems that non-toxic texts hold, too.
KINDS = (
    "terms", "stems", "off_by_one", "quoted_terms", "quoted_stems", "quoted_off_by_one", "shared", "quoted_shared",
)
#: How much one hit of each kind is taken to say before anything is learnt about it; a
#: quoted one says nothing until quoting texts turn out to be toxic.
PRIOR = np.array([1.0, 1.0, 0.8, 0.0, 0.0, 0.0, 0.8, 0.0])
#: ``many``: how many different words beyond the first are hits outside quotations.
FEATURES = ("any", "many", *KINDS)


@dataclass(frozen=True)
class ToxicityModel:
    automaton: WordAutomaton
    ordinary: frozenset[str]  # words one letter off a term that are no misspelling
    weights: np.ndarray  # the constant, then one by feature
    terms: tuple[str, ...] = ()
    stems: tuple[str, ...] = ()
    shared: dict[str, float] = field(default_factory=dict)  # how much a shared term or stem* says


class Scanner:
    """Hits in blocks of texts.  ``shared`` has the evidence, up to 1, of those terms and
    stems (with a final star) that are not toxic alone."""

    def __init__(
        self,
        automaton: WordAutomaton,
        ordinary: frozenset[str],
        shared: dict[str, float] | None = None,
        stems: tuple[str, ...] = (),
        terms: tuple[str, ...] = (),
    ) -> None:
        self.automaton, self.ordinary = automaton, ordinary
        #: A stem is evidence as the beginning of a longer word, which is how it is learnt.
        self.alone = frozenset(stems).difference(terms)
        self.shared, self.stems = shared or {}, frozenset(stems)
        self.is_word = _word_table()
        self.symbol = np.zeros(0x110000, np.uint8)
        for i, c in enumerate(automaton.symbols):
            self.symbol[ord(c)] = i + 1
        for sign, letter in _LOOKALIKE.items():
            self.symbol[ord(sign)] = self.symbol[ord(letter)] if self.symbol[ord(sign)] == 0 else self.symbol[ord(sign)]

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, str, int, bool]]:
        """(text, word, verdict, quoted) of every hit."""
        lowered = [t.lower() if t else "" for t in texts]
        text = "\n".join(lowered)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        begins, ends = words_of(points, self.is_word)
        verdict = match_words(self.automaton, self.symbol[points], begins, ends)
        found = np.flatnonzero(verdict)
        if not len(found):
            return
        bounds = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
        owner = np.searchsorted(bounds, begins[found], side="right")
        for i, doc in zip(found.tolist(), owner.tolist()):
            word = text[begins[i] : ends[i]]
            kind = int(verdict[i])
            if kind == 3 and word in self.ordinary:
                continue
            if kind == 2 and word.translate(_LETTERS) in self.alone:
                continue
            low = bounds[doc - 1] if doc else 0
            first, last = max(0, i - CONTEXT), min(len(begins) - 1, i + CONTEXT)
            before = text[max(int(begins[first]), int(low)) : begins[i]]
            after = text[ends[i] : min(int(ends[last]), int(bounds[doc]) - 1)]
            yield doc, word, kind, _quoted(before, after)

    def evidence(self, word: str, kind: int) -> float | None:
        """That of the shared term or stem that was hit; None for one that is not shared."""
        if not self.shared or kind == 3:
            return None
        word = word.translate(_LETTERS)
        if kind == 1:
            return self.shared.get(word)
        hit = [word[:n] for n in STEMS if word[:n] in self.stems]
        said = [self.shared.get(stem + "*") for stem in dict.fromkeys(hit)]
        return None if not said or None in said else max(said)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """The strongest hit by prior that is not quoted, then for each kind whether there is
        a hit; for shared ones the most evidence of any."""
        found = np.zeros((len(texts), len(KINDS)))
        different: dict[int, set[str]] = {}
        for doc, word, kind, quoted in self.hits(texts):
            if not quoted:
                different.setdefault(doc, set()).add(word)
            said = self.evidence(word, kind)
            if said is None:
                found[doc, kind - 1 + 3 * quoted] = 1.0
            else:
                at = 7 if quoted else 6
                found[doc, at] = max(found[doc, at], said)
        # A misspelt term is a term, as far as the prior goes.
        found[:, 0] = np.maximum(found[:, 0], PRIOR[2] * found[:, 2])
        many = np.array([np.log(max(1, len(different.get(i, ())))) for i in range(len(texts))])
        return np.column_stack([(found * PRIOR).max(axis=1, initial=0.0), many, found])


def _quoted(before: str, after: str) -> bool:
    """Whether a mark opens before and closes after the word, or a reporting word is near."""
    for a, b in (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»")):
        if b not in after:
            continue
        open_ = before.count(a) % 2 == 1 if a == b else before.rfind(a) > before.rfind(b)
        if open_:
            return True
    near = (before + " " + after).replace(",", " ").replace(":", " ").split()
    return any(w in REPORTING for w in near)


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 40, penalty: float = 1e-5) -> np.ndarray:
    """Logistic regression by Newton steps, halved while they lead uphill; constant first.

    What is known about single kinds of hits is learnt with a stronger penalty than
    the weights of any hit and of many, so a kind that the sample does not show keeps its prior.
    """
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    w[0] = -2.0
    hold = np.array([1.0, 1.0, 1.0, *[20.0] * (a.shape[1] - 3)]) * penalty * max(1, len(x))

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (hold * w * w).sum() / 2)

    at = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(hold)
        move = np.linalg.solve(h, a.T @ (y - p) - hold * w)
        share = 1.0
        while share > 1e-6 and loss(w + share * move) > at:
            share /= 2
        w = w + share * move
        at = loss(w)
        if np.abs(move).max() < 1e-8:
            break
    return w


def _units(text: str, find) -> set[str]:
    """Distinct words of a text, and their stems marked by a final star."""
    words = set(find(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def fit_toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    *,
    rows: int = 12_000,
    modulus: int = 5,
    remainder: int = 0,
    max_candidates: int = 20_000,
    min_texts: int = 2,
    min_odds: float = 8.0,
    sure_odds: float = 50.0,
) -> ToxicityModel:
    """A model from a bounded sample (``rows``) of labelled documents.

    Candidates (``max_candidates`` with the most evidence) are units with a text share
    ``min_odds`` times as high in toxic texts, by smoothed shares, however many texts
    of either class there are; :func:`_cover` picks terms among them.  A unit that
    non-toxic texts hold is shared unless its odds are over ``sure_odds`` also at the
    lower bound (:func:`_evidence`): the weights of shared hits, plain and quoted, are
    learnt apart.  Equal texts count once.  Words one letter off a term that non-toxic
    texts of the sample hold are ordinary.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", rows=rows, modulus=modulus, remainder=remainder)
    once = stage(
        sample.groupBy(F.xxhash64("text").alias("h"), "y").agg(F.first("text").alias("text")),
        "toxicity-sample",
    )
    totals = {r["y"]: r["n"] for r in once.groupBy("y").agg(F.count("*").alias("n")).collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(r"\p{L}+").findall
        for part, texts in text_blocks(batches):
            tallies = (Counter(), Counter())
            for y, raw in zip(part.column(part.schema.get_field_index("y")).to_pylist(), texts.to_pylist()):
                tallies[1 if y else 0].update(_units(raw.decode(), find) if raw else ())
            units = list(tallies[0].keys() | tallies[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(units, pa.string()), *(pa.array([t[u] for u in units], pa.int64()) for t in (tallies[1], tallies[0]))],
                names=["unit", "toxic", "other"],
            )

    toxic, other = totals.get(1, 0), totals.get(0, 0)
    odds = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    evidence = F.log(odds) - spread
    candidates = {
        r["unit"]: (r["evidence"], r["other"])
        for r in once.select("y", "text")
        .mapInArrow(count, "unit string, toxic long, other long")
        .groupBy("unit")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= min_texts) & (odds >= min_odds))
        .select("unit", "toxic", "other", evidence.alias("evidence"))
        .orderBy(F.desc(F.col("toxic") * F.col("evidence")), "unit")
        .limit(max_candidates)
        .collect()
    }
    wanted = spark.sparkContext.broadcast(frozenset(candidates))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(r"\p{L}+").findall
        for part, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("h")),
                    pa.array([sorted(_units(t.decode(), find) & wanted.value) if t else [] for t in texts.to_pylist()], pa.list_(pa.string())),
                ],
                names=["h", "units"],
            )

    held = (
        once.where("y = 1").select("h", "text").mapInArrow(contents, "h long, units array<string>").orderBy("h").collect()
    )
    # Whether a unit belongs to toxic speech can be doubted where other texts hold it.
    doubtful = {u for u, (said, n) in candidates.items() if n and said < np.log(min_odds)}
    chosen = _cover(
        [r["units"] for r in held], min_texts, evidence={u: said for u, (said, _) in candidates.items()}, doubtful=doubtful
    )
    stems = tuple(sorted(u[:-1] for u in chosen if u.endswith("*")))
    # A stem has no errors, as it would be in too many words; so the words it stands for
    # are terms beside it, and their misspellings are found.
    begins = set(stems)
    clear = float(np.log(min_odds))
    inflected = {
        u for u, (said, _) in candidates.items()
        if not u.endswith("*") and said >= clear and any(u[:n] in begins for n in STEMS)
    }
    terms = tuple(sorted(inflected.union(u for u in chosen if not u.endswith("*"))))
    sure = float(np.log(sure_odds))
    shared_units = {
        u: min(1.0, candidates[u][0] / sure)
        for u in {*chosen, *inflected}
        if candidates[u][1] and candidates[u][0] < sure
    }
    automaton = build_automaton(list(terms), list(stems))
    shared = spark.sparkContext.broadcast(automaton)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value, frozenset())
        for part, texts in text_blocks(batches):
            found = {w for _, w, kind, _ in scanner.hits(texts.cast(pa.large_string()).to_pylist()) if kind == 3}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["word"])

    ordinary = frozenset(
        r["word"]
        for r in once.where("y = 0").select("text").mapInArrow(near, "word string").distinct().collect()
    )
    # Where other texts use a word beside a term, more such words are to be expected: what
    # is one letter off that term is no misspelling of it.
    automaton = build_automaton(list(terms), list(stems), exact=beside(terms, ordinary))
    untrained = ToxicityModel(automaton, ordinary, np.zeros(len(FEATURES) + 1), terms, stems, shared_units)
    featured = _add_features(once, untrained).select("h", "x", "y").orderBy("h").toArrow()
    y = featured.column("y").to_numpy().astype(np.float64)
    x = np.array(featured.column("x").to_pylist(), np.float64).reshape(len(y), len(FEATURES))
    return ToxicityModel(automaton, ordinary, fit_weights(x, y), terms, stems, shared_units)


def beside(terms: Iterable[str], words: Iterable[str]) -> frozenset[str]:
    """The terms that one of ``words`` is one letter off."""

    def shapes(word: str) -> Iterator[tuple[str, int | None]]:
        yield word, None
        for i in range(len(word)):
            yield word[:i] + word[i + 1 :], i  # one letter replaced: equal without it
            yield word[:i] + word[i + 1 :], None  # one letter more

    owners: dict[tuple[str, int | None], set[str]] = {}
    for term in terms:
        for shape in shapes(term):
            owners.setdefault(shape, set()).add(term)
    found: set[str] = set()
    for word in words:
        word = word.translate(_LETTERS)
        for shape, i in shapes(word):
            for term in owners.get((shape, i), ()):
                # Two words that lack one letter each elsewhere are two letters apart.
                if i is not None or shape in (word, term):
                    found.add(term)
    return frozenset(found)


def _cover(
    texts: list[list[str]],
    min_texts: int,
    min_company: int = 5,
    *,
    evidence: dict[str, float],
    doubtful: set[str],
) -> list[str]:
    """Units that explain the texts, then further ones that belong to toxic speech.

    First, one by one, the unit with the most evidence over the texts not yet explained;
    among equals whole words, then longer stems.  That leaves out units that always
    stand beside others, and ``doubtful`` ones are chosen in no other way.
    So then each unit is added whose texts hold at least ``min_company`` different
    selections of the units found first: the words of one text and its near copies
    have the same company everywhere, those of a lexicon have not.
    """
    whole: dict[str, set[int]] = {}
    for i, units in enumerate(texts):
        for u in units:
            whole.setdefault(u, set()).add(i)
    rank = lambda u, own: (len(own) * evidence[u], not u.endswith("*"), len(u), u)
    inside = {u: set(own) for u, own in whole.items() if len(own) >= min_texts}
    chosen: list[str] = []
    while inside:
        best = max(inside, key=lambda u: rank(u, inside[u]))
        done = inside.pop(best)
        chosen.append(best)
        for u in [u for u, own in inside.items() if own & done]:
            inside[u] = inside[u] - done
            if len(inside[u]) < min_texts:
                del inside[u]
    first = set(chosen)
    company = [frozenset(first.intersection(units)) for units in texts]
    for u in sorted(whole, key=lambda u: rank(u, whole[u]), reverse=True):
        own = whole[u]
        said = any(
            (c.endswith("*") and u.startswith(c[:-1])) or (u[:-1] == c[: len(u) - 1] and own <= whole[c])
            for c in chosen
        )
        if u not in first and u not in doubtful and not said and len({company[i] for i in own}) >= min_company:
            chosen.append(u)
    return chosen


def _scanner(model: ToxicityModel) -> Scanner:
    return Scanner(model.automaton, model.ordinary, model.shared, model.stems, model.terms)


def _add_features(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scanner = _scanner(shared.value)
        return lambda texts: (
            pa.array(list(scanner.features(texts.cast(pa.large_string()).to_pylist())), pa.list_(pa.float64())),
        )

    return add_from_text(docs, [("x", "array<double>", pa.list_(pa.float64()))], make)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 (higher: more likely toxic).

    A text without hits, an empty and a null text have the score of no evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scanner = _scanner(shared.value)
        weights = shared.value.weights

        def work(texts: pa.Array):
            x = scanner.features(texts.cast(pa.large_string()).to_pylist())
            return (1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30))),)

        return work

    return add_from_text(docs, [(column, "double", pa.float64())], make)
