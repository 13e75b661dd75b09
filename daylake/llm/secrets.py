"""Secrets in texts: known shapes, and strings of high entropy.

Candidate strings are long runs of key characters.  A window slides over a candidate;
the counts of its characters are kept up to date by one in, one out, and with them its
Shannon entropy.  A candidate whose best window reaches the limit of its character
class (hexadecimal, alphanumeric, base64) is reported, unless an allow-list rule says
that it is something else: words of one case or a name written together, a number, an
identifier of known form, a path.  A placeholder suppresses its neighbourhood only.
"""

from __future__ import annotations

import re
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from daylake.llm.common import add_from_text, free_name

KINDS = ("assign", "access", "hex", "entropy")
# Shapes and least lengths of the base kinds (fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of hexadecimal digits counts from its first digit on.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_LENGTH)
#: Runs of key characters that are long enough for a window.
WINDOW = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
#: Least entropy (bits a character) of a window of :data:`WINDOW` characters by class.
LIMITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
_X_LOG_X = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]

ALLOWED = tuple(
    re.compile(p)
    for p in (
        r"(?:[a-z]+|[A-Z]+)(?:[_-]+(?:[a-z]+|[A-Z]+))*[_-]*|[_-]+",  # words of one case, also joined
        r"[0-9_+=/-]+",  # numbers and rules
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
        r"(.)\1+",
        r"[A-Za-z]{2,}[0-9]{1,4}",  # a word with a number
        r"[A-Za-z_.-]*(?:/[A-Za-z_.-]+)+/?",  # paths
    )
)
#: A placeholder suppresses what is around it, a window's length to either side.
PLACEHOLDER = re.compile(r"EXAMPLE|example|XXXX|xxxx|0000000|1234567")
#: Words of mixed case and their parts: these are names if the parts are long enough.
_MIXED = re.compile(r"[A-Za-z_-]+")
_CASE_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LEAST_CASE_PART = 3.4


def is_name(candidate: str) -> bool:
    """Whether letters of mixed case look like words written together (``someLongName``);
    random letters change case every other letter."""
    if not _MIXED.fullmatch(candidate):
        return False
    parts = _CASE_PART.findall(candidate)
    return sum(map(len, parts)) >= LEAST_CASE_PART * len(parts)


def unsuppressed(candidate: str) -> list[str]:
    """What placeholders leave of a candidate, in pieces of a window's length at least."""
    pieces, start = [], 0
    for m in PLACEHOLDER.finditer(candidate):
        pieces.append(candidate[start : max(start, m.start() - WINDOW)])
        start = m.end() + WINDOW
    if not start:
        return [candidate]
    return [p for p in [*pieces, candidate[start:]] if len(p) >= WINDOW]


def character_class(candidate: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", candidate):
        return "hex"
    return "alnum" if candidate.isalnum() else "base64"


def best_entropy(candidate: str, window: int = WINDOW) -> float:
    """The greatest entropy of any window of the string (of all of a shorter one)."""
    n = min(window, len(candidate))
    if not n:
        return 0.0
    counts: dict[str, int] = {}
    for c in candidate[:n]:
        counts[c] = counts.get(c, 0) + 1
    total = sum(_X_LOG_X[k] for k in counts.values())
    least = total
    for gone, new in zip(candidate, candidate[n:]):
        if gone != new:
            k = counts[gone]
            total += _X_LOG_X[k - 1] - _X_LOG_X[k]
            counts[gone] = k - 1
            k = counts.get(new, 0)
            total += _X_LOG_X[k + 1] - _X_LOG_X[k]
            counts[new] = k + 1
            least = min(least, total)
    return log2(n) - least / n


def is_secret(candidate: str) -> bool:
    """Whether a candidate string is reported."""
    if is_name(candidate) or any(rule.fullmatch(candidate) for rule in ALLOWED):
        return False
    return any(best_entropy(p) >= LIMITS[character_class(p)] for p in unsuppressed(candidate))


def _is_rest_secret(rest: str, whole: bool) -> bool:
    """Whether a candidate, or what is left of one, is reported.  The signs that join a
    rest to its neighbours do not decide about its class, if it is long enough without."""
    core = rest if whole else rest.strip("+/_=-")
    return is_secret(core if len(core) >= WINDOW else rest)


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind.

    Entropy candidates are what spans of other kinds leave of a run of key characters:
    all of it, or the parts before, between and behind them that are long enough.
    """
    found = [
        ("assign", m.start(), m.end())
        for m in ASSIGN.finditer(text)
        if len(m.group(2)) >= ASSIGN_VALUE
    ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b in found)
    at = reach = 0  # base spans that start before the candidate's end; where the furthest ends
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        free = max(a, reach)
        rests = []
        while at < len(base) and base[at][0] < b:
            rests.append((free, base[at][0]))
            reach = max(reach, base[at][1])
            free = max(free, reach)
            at += 1
        rests.append((free, b))
        found += [
            ("entropy", c, d) for c, d in rests if d - c >= WINDOW and _is_rest_secret(text[c:d], (c, d) == (a, b))
        ]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def scan_secrets(docs: DataFrame, *, column: str = "spans") -> DataFrame:
    """``docs`` with ``spans``, an array of (kind, start, stop); empty for a null, empty
    or clean text."""

    def make():
        def work(texts: pa.Array):
            out = []
            for text in texts.cast(pa.large_string()).to_pylist():
                spans = find_secrets(text) if text else []
                out.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
            return (pa.array(out, SPANS),)

        return work

    return add_from_text(
        docs, [(column, "array<struct<kind:string,start:int,stop:int>>", SPANS)], make
    )


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every (merged) span replaced by ``mark``."""
    parts, at = [], 0
    for _, start, stop in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, stop)
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in the text; ``n_chars``, if there, follows the text.
    No row is dropped; null texts stay null."""
    name = free_name(docs.columns, "_redacted")

    def make():
        def work(texts: pa.Array):
            out = []
            for text in texts.cast(pa.large_string()).to_pylist():
                out.append(redact(text, find_secrets(text), mark) if text else text)
            return (pa.array(out, pa.string()),)

        return work

    done = add_from_text(docs, [(name, "string", pa.string())], make)
    changed = ~F.col(name).eqNullSafe(F.col("text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col(name).alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            columns.append(F.when(changed, F.length(name).cast(kind)).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            columns.append(F.col(f"`{c}`"))
    return done.select(*columns)


def base_spans(spans: str = "spans") -> Column:
    return F.filter(spans, lambda s: s["kind"] != "entropy")


def span_text(spans) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
    )
