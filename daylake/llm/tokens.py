"""Token ids through the ``tokenizers`` library, fast for texts with recurring words.

A text is cut at blanks; the ids of each word are remembered, so that the library
sees a word once per worker and not once per occurrence.  Texts with characters for
which that might differ from encoding the whole text go to the library as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Anything but blanks, ASCII and composed Latin letters: for those, normalisation
#: changes nothing, lower-casing is per character, and a blank always ends a word.
_OTHER = "[^\t\n\r -~¡-įı-ɏ]"
# The word pattern of the tokenizer file (fixed value).
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Bytes of text that are encoded at once; the larger, the fewer repeated look-ups.
ENCODE_BYTES = 12_000_000

_LOADED: dict[tuple[str, int], "WordTokenizer"] = {}


def default_tokenizer() -> str:
    """Where the installed public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def loaded(path: str | None, max_words: int = 800_000) -> "WordTokenizer":
    """The worker's tokenizer for a vocabulary file (None: the installed one)."""
    path = path or default_tokenizer()
    if (path, max_words) not in _LOADED:
        _LOADED[path, max_words] = WordTokenizer(path, max_words)
    return _LOADED[path, max_words]


class WordTokenizer:
    """Same ids as ``Tokenizer.encode(text, add_special_tokens=False)``.

    At most about ``max_words`` words are remembered; then memory is emptied and
    filled anew, which costs time and changes no result.
    """

    def __init__(self, path: str, max_words: int = 800_000) -> None:
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = None
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(_PIECE), "removed", invert=True),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.max_words = max_words
        self._forget()

    def _forget(self) -> None:
        self.word_no: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, words: list[str]) -> None:
        """Remember new words; the library gets a few hundred of them a call."""
        flat: list[int] = []
        lengths: list[np.ndarray] = []
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            done = self.model.encode(" ".join(some), add_special_tokens=False)
            flat += done.ids
            ends = np.cumsum([len(w) + 1 for w in some])
            of_word = np.searchsorted(ends, [start for start, _ in done.offsets], side="right")
            lengths.append(np.bincount(of_word, minlength=len(some)))
        first = len(self.word_no)
        self.word_no.update(zip(words, range(first, first + len(words))))
        ends = np.cumsum(np.concatenate(lengths)) + len(self.flat)
        self.starts = np.concatenate([self.starts, ends])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` of texts without unusual characters."""
        parts = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        words = parts.flatten().dictionary_encode()
        offsets = parts.offsets.to_numpy()
        distinct = words.dictionary.to_pylist()
        numbers = list(map(self.word_no.get, distinct))
        fresh = [w for w, no in zip(distinct, numbers) if no is None and w]
        if fresh:
            self._learn(fresh)
            numbers = list(map(self.word_no.get, distinct))
        # The empty word (of an empty text) has no ids.
        known = np.array([-1 if no is None else no for no in numbers], np.int64)
        if not len(known):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        counts = np.where(known < 0, 0, self.starts[known + 1] - self.starts[known])
        index = words.indices.to_numpy()
        lengths = counts[index]
        ends = np.cumsum(lengths)
        shift = np.where(known < 0, 0, self.starts[known])[index] - (ends - lengths)
        ids = self.flat[np.arange(int(ends[-1])) + np.repeat(shift, lengths)]
        return ids, np.diff(np.concatenate([[0], ends])[offsets - offsets[0]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of UTF-8 texts (null: empty), and the number of each text."""
        if len(self.word_no) > self.max_words:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(
            pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, _OTHER)
        ).to_numpy(zero_copy_only=False)
        ids, counts = self._plain(pc.if_else(pa.array(odd), "", texts))
        if not odd.any():
            return ids, counts
        whole = np.flatnonzero(odd)
        done = self.full.encode_batch(texts.take(pa.array(whole)).to_pylist(), add_special_tokens=False)
        places = np.cumsum(counts)[whole]
        parts, last = [], 0
        for i, at, text in zip(whole, places, done):
            parts += [ids[last:at], np.array(text.ids, np.uint32)]
            counts[i], last = len(text.ids), at
        return np.concatenate([*parts, ids[last:]]), counts
