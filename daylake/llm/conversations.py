"""Repair of conversations: the cheapest edits that give a well-formed course of roles.

Prefix-doubling path ranking.  A conversation's rows and the four states of the form
``(s?(ua)+)?`` make a graph whose arcs are edits; a backward cost programme leaves the
arcs that lie on a cheapest way.  Their nodes are then ranked by the least audit of
1, 2, 4, 8, ... letters that begins at them: the rank for a doubled length is that of
the pair (own rank, rank of the node where the first half ends).  The ranks select each
node's arc of the least audit, and the doubled pointers visit the nodes of that way.

Rows are cut into chunks of bounded size, so that a conversation may be of any length:
a chunk gives the cheapest cost from each state before it to each state after it,
costs are joined from the last chunk backwards and states from the first forwards, both
through layers of chunks.  Only the digest of a repaired conversation needs its texts in
one stream, which is sorted on disk and hashed as it passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from daylake.llm.ordering import numbered, unit_of
from daylake.session import stage

#: Rows of a group of chunks, on average.
ROWS_PER_UNIT = 4096

#: States: nothing yet, system seen, user's turn seen, assistant's turn seen.
STATES = 4
_ENDS = np.array([0, 10, 5, 0])  # cheapest end from each state, by inserting
_NEVER = 1 << 40

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Letters in ASCII order; the rank of a letter is its place (0: the end).
_LETTERS = np.array(["", DELETE, INSERT, KEEP, REROLE])
#: The state after a user's or an assistant's turn that stands next in the form.
_NEXT = np.array([2, 2, 3, 2])
_DELETE, _INSERT, _REROLE, _TRUNCATED = 2, 5, 1, 5


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after damage by crc32(``conv_id:turn``) % 20.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4
    sets its role to user.  A null role or text, and a null in the digest, is one space.
    """
    space = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text, role = part("text"), part("role")
    changed = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        fate.alias("_fate"),
    ).where("_fate <> 0")
    copies = F.when(F.col("_fate") == 3, F.array_repeat(F.lit(0), 2)).otherwise(F.array(F.lit(0)))
    return changed.withColumn("_copy", F.explode(copies)).drop("_fate", "_copy")


def _initial(role: str) -> Column:
    """s, u, a, or a dash for any other first letter (an empty role has none)."""
    letter = F.substring(role, 1, 1)
    return F.when(letter.isin("s", "u", "a"), letter).otherwise("-")


# ------------------------------------------------------------------ one unit of chunks


class Rows:
    """The rows of some chunks: each row's costs and, by state, where keeping it leads."""

    def __init__(self, initial: np.ndarray, must_go: np.ndarray, truncated: np.ndarray) -> None:
        self.extra = np.where(truncated, _TRUNCATED, 0)
        self.must_go = must_go
        kept = np.full((len(initial), STATES), -1)
        kept[initial == "s", 0] = 1
        for q in (0, 1, 3):
            kept[initial == "u", q] = 2
        kept[initial == "a", 2] = 3
        self.kept = np.where(must_go[:, None], -1, kept)

    def step(self, row: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """For some rows (one of each chunk) and the costs after them by state: the cost
        of deleting, inserting, keeping and reroling, by state before them."""
        extra, gone = self.extra[row, None], self.must_go[row, None]
        delete = after + _DELETE
        rerole = np.where(gone, _NEVER, after[:, _NEXT] + _REROLE + extra)
        kept = self.kept[row]
        keep = np.where(kept < 0, _NEVER, np.take_along_axis(after, np.maximum(kept, 0), 1) + extra)
        best = np.minimum(np.minimum(delete, rerole), keep)
        # Inserts before the row: one or two of them, as costs are positive.
        for _ in range(2):
            insert = best[:, _NEXT] + _INSERT
            best = np.minimum(best, insert)
        return delete, best[:, _NEXT] + _INSERT, keep, rerole, best


def chunk_costs(rows: Rows, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each chunk the cheapest cost from each state before it to each after it."""
    out = np.full((len(start), STATES, STATES), _NEVER)
    for q in range(STATES):
        cost = np.full((len(start), STATES), _NEVER)
        cost[:, q] = 0
        for back in range(1, int(size.max(initial=0)) + 1):
            live = np.flatnonzero(size >= back)
            cost[live] = np.minimum(rows.step((start + size - back)[live], cost[live])[4], _NEVER)
        out[:, :, q] = cost
    return out


def ranked_paths(
    rows: Rows, start: np.ndarray, size: np.ndarray, ends: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, list[list[str]]]:
    """For each chunk and state before it: the state after it, and the least audit.

    ``ends`` has the cheapest cost after each chunk by state; a chunk that is the ``last``
    of its conversation may also insert after its rows.
    """
    # Nodes: (size + 1) * STATES a chunk, rows in order.  A node at the end of a chunk
    # leads to itself with the empty letter.
    first = np.concatenate([[0], np.cumsum(size + 1)])
    total = int(first[-1]) * STATES
    letter, pointer = np.zeros(total, np.int64), np.arange(total)
    state = np.arange(STATES)
    cost = ends.copy()

    def arcs(at, options, best, targets):
        """The least letter among the arcs that keep to the cheapest cost."""
        nodes = at[:, None] * STATES + state
        for k in (4, 3, 2, 1):  # the least is written last
            good = options[k - 1] == best
            letter[nodes[good]] = k
            pointer[nodes[good]] = targets[k - 1][good]

    tail = np.flatnonzero(last)
    if len(tail):
        at = first[tail] + size[tail]
        for q in (1, 2):
            node = at * STATES + q
            letter[node], pointer[node] = 2, at * STATES + _NEXT[q]
    for back in range(1, int(size.max(initial=0)) + 1):
        live = np.flatnonzero(size >= back)
        row = (start + size - back)[live]
        delete, insert, keep, rerole, best = rows.step(row, cost[live])
        cost[live] = best
        at = (first[live] + size[live] - back)
        after = (at + 1)[:, None] * STATES
        own = at[:, None] * STATES
        targets = (after + state, own + _NEXT, after + np.maximum(rows.kept[row], 0), after + _NEXT)
        arcs(at, (delete, insert, keep, rerole), best, targets)

    # Ranks by audits of 1, 2, 4, ... letters.  No two arcs of a node share a letter, so
    # the rank for one letter selects its arc, and the way of its least audit goes through
    # the node that the pointer names.
    rank, reach, doubled = letter, pointer, [pointer]
    while (rank[reach] > 0).any():
        pairs = rank * (int(rank.max()) + 1) + rank[reach]
        rank = np.unique(pairs, return_inverse=True)[1]
        # The empty audit stays rank 0: an end leads to itself.
        reach = reach[reach]
        doubled.append(reach)
    begin = first[:-1, None] * STATES + state
    on_way, owner = begin.ravel(), np.arange(begin.size)
    order = np.zeros(begin.size, np.int64)
    exits = reach[on_way] % STATES
    for power in reversed(range(len(doubled))):
        further = doubled[power][on_way]
        on = letter[further] > 0  # ends are not visited again
        on_way = np.concatenate([on_way, further[on]])
        order = np.concatenate([order, order[on] + (1 << power)])
        owner = np.concatenate([owner, owner[on]])
    real = letter[on_way] > 0
    on_way, order, owner = on_way[real], order[real], owner[real]
    by = np.lexsort((order, owner))
    text = "".join(_LETTERS[letter[on_way[by]]])
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=begin.size))])
    audits = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    return exits.reshape(-1, STATES), [audits[i : i + STATES] for i in range(0, len(audits), STATES)]


_COSTS = [f"c{p}{q}" for p in range(STATES) for q in range(STATES)]
_END = [f"e{q}" for q in range(STATES)]
_EXIT = [f"x{q}" for q in range(STATES)]
_AUDIT = [f"audit{q}" for q in range(STATES)]


def _chunked(frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, Rows, np.ndarray, np.ndarray]:
    """Rows of a unit in order, their chunks, and where these begin."""
    ordered = frame.sort_values(["conv", "chunk", "pos"], kind="stable").reset_index(drop=True)
    new = (ordered[["conv", "chunk"]] != ordered[["conv", "chunk"]].shift()).any(axis=1)
    start = np.flatnonzero(new.to_numpy())
    size = np.diff(np.append(start, len(ordered)))
    flags = ordered["flags"].to_numpy()
    rows = Rows(ordered["initial"].to_numpy(str), (flags & 3) > 0, (flags & 4) > 0)
    return ordered, ordered.loc[start, ["conv", "chunk"]], rows, start, size


def _costs_of_chunks(frame: pd.DataFrame) -> pd.DataFrame:
    ordered, keys, rows, start, size = _chunked(frame)
    initial = ordered["initial"].to_numpy(str)
    pair = np.char.add(initial[:-1], initial[1:])
    odd = np.append(~np.isin(pair, ["su", "ua", "au"]), False)
    odd[start + size - 1] = False  # pairs within a chunk
    costs = chunk_costs(rows, start, size).reshape(len(start), -1)
    out = pd.DataFrame(costs, columns=_COSTS)
    out.insert(0, "conv", keys["conv"].to_numpy())
    out.insert(1, "idx", keys["chunk"].to_numpy())
    sums = np.add.reduceat(odd.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    return out.assign(illegal=sums, first=initial[start], last=initial[start + size - 1])


def _paths_of_chunks(frame: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    _, keys, rows, start, size = _chunked(frame)
    found = keys.merge(ends, left_on=["conv", "chunk"], right_on=["conv", "idx"], how="left")
    exits, audits = ranked_paths(
        rows, start, size, found[_END].to_numpy(np.int64), found["is_last"].to_numpy(bool)
    )
    out = pd.DataFrame(exits, columns=_EXIT)
    out.insert(0, "conv", keys["conv"].to_numpy())
    out.insert(1, "idx", keys["chunk"].to_numpy())
    out["cost"] = found["e_start"].to_numpy(np.int64)
    for q, name in enumerate(_AUDIT):
        out[name] = [a[q] for a in audits]
    return out


# ------------------------------------------------------------------ layers of chunks


def _product(frame: pd.DataFrame, names: list[str], combine, chunk: int) -> pd.DataFrame:
    """One row for each run of ``chunk`` chunks: their values combined from left to right."""
    out = []
    for (conv, block), part in frame.assign(block=frame["idx"] // chunk).groupby(["conv", "block"]):
        values = part.sort_values("idx")[names].to_numpy(np.int64)
        total = values[0]
        for value in values[1:]:
            total = combine(total, value)
        out.append((conv, block, *total))
    return pd.DataFrame(out, columns=["conv", "idx", *names])


def _then_costs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = a.reshape(STATES, STATES)[:, :, None] + b.reshape(STATES, STATES)[None]
    return np.minimum(both.min(axis=1), _NEVER).ravel()


def _then_states(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return b[a]


def _layers(chunks: DataFrame, names: list[str], combine, chunk: int, label: str) -> list[DataFrame]:
    """Chunks of long conversations and, above them, what runs of chunks come to, up to
    whole conversations."""
    layers = [chunks.select("conv", "idx", *names)]
    schema = ", ".join(["conv string", "idx long", *(f"{n} long" for n in names)])
    while (layers[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        grouped = layers[-1].groupBy("conv", F.floor(F.col("idx") / chunk))
        made = grouped.applyInPandas(lambda frame: _product(frame, names, combine, chunk), schema)
        layers.append(stage(made, label))
    return layers


def _ends_of_whole(conversations: DataFrame) -> DataFrame:
    """For chunks that are whole conversations, as :func:`_ends_of_chunks`."""
    start = F.least(*[F.col(f"c0{q}") + int(_ENDS[q]) for q in range(STATES)])
    ends = [F.lit(int(c)).cast("long").alias(n) for n, c in zip(_END, _ENDS)]
    return conversations.select("conv", "idx", *ends, start.alias("e_start"))


def _ends_of_chunks(chunks: DataFrame, chunk: int) -> DataFrame:
    """The cheapest cost after each chunk by state, and from nothing at its conversation's
    start: ``conv, idx, e0..e3, e_start``."""
    layers = _layers(chunks, _COSTS, _then_costs, chunk, "repair-costs")
    ends = _ends_of_whole(layers[-1])
    schema = ", ".join(["conv string", "idx long", *(f"{n} long" for n in _END), "e_start long"])

    def spread(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if below.empty:
            return pd.DataFrame(columns=["conv", "idx", *_END, "e_start"])
        part = below.sort_values("idx", ascending=False)
        cost, start, out = above[_END].to_numpy(np.int64)[0], above["e_start"].iloc[0], []
        for conv, idx, *values in part[["conv", "idx", *_COSTS]].itertuples(index=False):
            out.append((conv, idx, *cost, start))
            cost = (np.array(values).reshape(STATES, STATES) + cost).min(axis=1)
        return pd.DataFrame(out, columns=["conv", "idx", *_END, "e_start"])

    for layer in reversed(layers[:-1]):
        left = layer.groupBy("conv", F.floor(F.col("idx") / chunk).alias("block"))
        right = ends.withColumnRenamed("idx", "block").groupBy("conv", "block")
        ends = stage(left.cogroup(right).applyInPandas(lambda key, a, b: spread(a, b), schema), "repair-ends")
    return ends


def _starts_of_chunks(chunks: DataFrame, chunk: int) -> DataFrame:
    """The state before each chunk: ``conv, idx, state``."""
    layers = _layers(chunks, _EXIT, _then_states, chunk, "repair-exits")
    states = layers[-1].select("conv", "idx", F.lit(0).cast("long").alias("state"))

    def spread(below: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        state, out = int(above["state"].iloc[0]) if len(above) else 0, []
        for conv, idx, *values in below.sort_values("idx")[["conv", "idx", *_EXIT]].itertuples(index=False):
            out.append((conv, idx, state))
            state = int(values[state])
        return pd.DataFrame(out, columns=["conv", "idx", "state"])

    for layer in reversed(layers[:-1]):
        left = layer.groupBy("conv", F.floor(F.col("idx") / chunk).alias("block"))
        right = states.withColumnRenamed("idx", "block").groupBy("conv", "block")
        states = stage(
            left.cogroup(right).applyInPandas(lambda key, a, b: spread(a, b), "conv string, idx long, state long"),
            "repair-states",
        )
    return states


# ------------------------------------------------------------------ digests


def _repaired_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of conversations in order, the audit of each before its texts: the digest of
    each repaired conversation.  Holds one audit and one hash."""
    conv, letters, at, turn, begun, hashed = None, "", 0, "user", False, sha256()

    def say(role: str, text: str) -> None:
        nonlocal begun
        hashed.update((f"\n{role}:{text}" if begun else f"{role}:{text}").encode())
        begun = True

    def insert() -> None:
        nonlocal at, turn
        while at < len(letters) and letters[at] == INSERT:
            say(turn, "")
            turn, at = "assistant" if turn == "user" else "user", at + 1

    for batch in batches:
        done = []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "role", "text", "audit")]
        for key, role, text, audit in zip(*columns):
            if audit is not None:
                if conv is not None:
                    insert()
                    done.append((conv, hashed.hexdigest()))
                conv, letters, at, turn, begun, hashed = key, audit, 0, "user", False, sha256()
                continue
            insert()
            edit, at = letters[at], at + 1
            if edit == DELETE:
                continue
            said = role if edit == KEEP else turn
            say(said, text)
            turn = "assistant" if said[:1] == "u" else "user"
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["conv", "sha"])
    if conv is not None:
        insert()
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([hashed.hexdigest()])], names=["conv", "sha"])


def repair_conversations(conversations: DataFrame, *, chunk: int = 4096) -> DataFrame:
    """One row for every conv_id: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256.

    Rows are damaged as in :func:`damaged` and then taken by turn (null first), and by
    role and the text's digest among rows of one turn.  A row's first fault counts: blank,
    duplicate (role and text seen earlier in the conversation) or truncated (no ``.!?`` at
    its end).  ``gaps`` counts turns that are missing between the least and the greatest,
    ``illegal`` neighbours whose initials are not su, ua or au.  Edits: keep (K, 0),
    rerole to user or assistant (R, 1), delete (D, 2; blank and duplicate rows must go),
    insert an empty turn (I, 5); a truncated row that stays costs 5 more.  The cheapest
    edits that give ``(s?(ua)+)?`` count, of equally cheap ones those with the least audit.
    An empty role, or one of another initial, can only be reroled or deleted.  Where no row
    is left, counts are 0 and audit and text empty.  A null conv_id is a conversation.
    ``chunk`` bounds the rows, and the chunks of a layer, that one group works on.  An empty
    table gives no rows; columns other than conv_id, turn, role and text are ignored.
    """
    rows = damaged(conversations).withColumn(
        "conv", F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-"))
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    light = stage(
        rows.select(
            "conv",
            "turn",
            "role",
            "digest",
            _initial("role").alias("initial"),
            (shown == "").alias("blank"),
            (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "repair-rows",
    )
    placed = numbered(light, "conv", ["turn", "role", "digest", "_row"], "repair-order")
    # Of equal rows the first stays; a hot text is combined before the shuffle.
    firsts = placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos"))
    seen = placed.join(firsts.select("conv", "pos", F.lit(True).alias("_first")), ["conv", "pos"], "left")
    again = F.col("_first").isNull()
    fault = F.when(F.col("blank"), 1).when(again, 2).when(F.col("truncated"), 4).otherwise(0)
    flagged = stage(
        seen.select("conv", "turn", "pos", "initial", fault.alias("flags"), F.floor(F.col("pos") / chunk).alias("chunk")),
        "repair-faults",
    )
    total = flagged.count()
    count = lambda flag: F.count_if(F.col("flags") == flag)
    counts = flagged.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        count(1).alias("blank"),
        count(2).alias("duplicate"),
        count(4).alias("truncated"),
    )
    units = flagged.select("conv", "chunk", "pos", "initial", "flags").withColumn(
        "unit", unit_of(total, ROWS_PER_UNIT, "conv", "chunk")
    )
    cost_type = ", ".join(["conv string", "idx long", *(f"{n} long" for n in _COSTS)])
    chunks = units.groupBy("unit").applyInPandas(
        _costs_of_chunks, f"{cost_type}, illegal long, first string, last string"
    )
    chunks = stage(chunks, "repair-chunks")
    sizes = chunks.groupBy("conv").agg(F.max("idx").alias("last_idx"))
    chunks = stage(chunks.join(sizes, "conv"), "repair-sized")
    whole, long = chunks.where("last_idx = 0"), chunks.where("last_idx > 0")
    several = not long.isEmpty()
    ends = _ends_of_whole(whole)
    if several:
        ends = ends.union(_ends_of_chunks(long, chunk))
    ends = ends.join(chunks.select("conv", "idx", (F.col("idx") == F.col("last_idx")).alias("is_last")), ["conv", "idx"])
    path_type = ", ".join(
        ["conv string", "idx long", *(f"{n} long" for n in _EXIT), "cost long", *(f"{n} string" for n in _AUDIT)]
    )
    left = units.groupBy("unit")
    right = ends.withColumn("unit", unit_of(total, ROWS_PER_UNIT, "conv", "idx")).groupBy("unit")
    paths = stage(left.cogroup(right).applyInPandas(_paths_of_chunks, path_type), "repair-paths")
    # Between chunks only the states before them are to be found; a first chunk has state 0.
    inside = chunks.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    if several:
        states = _starts_of_chunks(paths.join(long.select("conv", "idx"), ["conv", "idx"], "left_semi"), chunk)
        taken = paths.join(states, ["conv", "idx"], "left")
        by_chunk = Window.partitionBy("conv").orderBy("idx")
        border = F.concat(F.lag("last").over(by_chunk), F.col("first"))
        borders = long.select("conv", border.alias("pair")).where(~F.col("pair").isin("su", "ua", "au"))
        across = borders.groupBy("conv").agg(F.count("*").alias("_across"))
        inside = inside.join(across, "conv", "left").select(
            "conv", (F.col("illegal") + F.coalesce("_across", F.lit(0))).alias("illegal")
        )
    else:
        taken = paths.withColumn("state", F.lit(0).cast("long"))
    piece = F.get(F.array(*_AUDIT), F.coalesce("state", F.lit(0)).cast("int"))
    pieces = F.array_sort(F.collect_list(F.struct("idx", piece.alias("audit"))))
    audits = stage(
        taken.groupBy("conv").agg(
            F.max("cost").alias("cost"), F.array_join(F.transform(pieces, lambda x: x["audit"]), "").alias("audit")
        ),
        "repair-audits",
    )
    none = lambda kind: F.lit(None).cast(kind)
    texts = rows.select("conv", "turn", "role", "digest", "text", none("string").alias("audit"), F.lit(1).alias("kind"))
    heads = audits.select(
        "conv", none("long").alias("turn"), none("string").alias("role"), none("string").alias("digest"),
        none("string").alias("text"), "audit", F.lit(0).alias("kind"),
    )
    streamed = (
        texts.union(heads)
        .repartition("conv")
        .sortWithinPartitions("conv", "kind", "turn", "role", "digest")
        .select("conv", "role", "text", "audit")
    )
    digests = streamed.mapInArrow(_repaired_digests, "conv string, sha string")
    named = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn(
        "conv", F.coalesce(F.concat(F.lit("+"), F.col("conv_id").cast("string")), F.lit("-"))
    )
    joined = named
    for found in (counts, inside, audits, digests):
        joined = joined.join(found, "conv", "left")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        "conv_id",
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
