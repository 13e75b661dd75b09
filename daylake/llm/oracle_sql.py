"""SQL (DuckDB dialect) of the manifest and of the repair of conversations."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit (the generator is a fixed value)."""
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
        string_split({text}, ''),
        lambda c: [CAST(ord(c) + 256 AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 256 THEN xor(a, x - 256)
            WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_FIELDS = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE leaf AS (
    SELECT row_number() OVER () AS row, doc_id, source, sha256({_FIELDS} || {_field('text')}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0
            THEN sha256({_FIELDS} || {_field(_LOWERED)}) END AS tampered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
    FROM leaf
), node AS (
    SELECT 0 AS level, source, idx, leaf AS d, count(*) OVER (PARTITION BY source) AS n FROM placed
    UNION ALL
    SELECT any_value(level) + 1, source, idx // 16, sha256(string_agg(d, '' ORDER BY idx)),
        any_value((n + 15) // 16)
    FROM node WHERE n > 1 GROUP BY source, idx // 16
), sub AS (
    SELECT source, d AS subroot, level AS depth,
        row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
    FROM node WHERE n = 1
), upper_node AS (
    SELECT 0 AS level, place AS idx, subroot AS d, count(*) OVER () AS n FROM sub
    UNION ALL
    SELECT any_value(level) + 1, idx // 16, sha256(string_agg(d, '' ORDER BY idx)), any_value((n + 15) // 16)
    FROM upper_node WHERE n > 1 GROUP BY idx // 16
), top AS (
    SELECT d AS root, level AS depth FROM upper_node WHERE n = 1
), step AS (
    SELECT row, level, idx // CAST(pow(16, level) AS BIGINT) AS spot, p.source
    FROM placed p JOIN sub s ON p.source IS NOT DISTINCT FROM s.source, unnest(range(s.depth)) AS u(level)
), upper_step AS (
    SELECT row, level, place // CAST(pow(16, level) AS BIGINT) AS spot
    FROM placed p JOIN sub s ON p.source IS NOT DISTINCT FROM s.source, top, unnest(range(top.depth)) AS u(level)
), path AS (
    SELECT row, s.level AS level,
        coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (WHERE n.idx < spot), '') AS left_side,
        coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (WHERE n.idx > spot), '') AS right_side
    FROM step s JOIN node n
        ON n.level = s.level AND n.source IS NOT DISTINCT FROM s.source AND n.idx // 16 = spot // 16
    GROUP BY row, s.level
    UNION ALL
    SELECT row, 1000 + s.level,
        coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (WHERE n.idx < spot), ''),
        coalesce(string_agg(n.d, '' ORDER BY n.idx) FILTER (WHERE n.idx > spot), '')
    FROM upper_step s JOIN upper_node n ON n.level = s.level AND n.idx // 16 = spot // 16
    GROUP BY row, s.level
), numbered_path AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY level) AS nth FROM path
), folded AS (
    SELECT row, 0 AS nth, coalesce(tampered, leaf) AS d FROM placed
    UNION ALL
    SELECT f.row, f.nth + 1, sha256(left_side || f.d || right_side)
    FROM folded f JOIN numbered_path p ON p.row = f.row AND p.nth = f.nth + 1
), last_fold AS (
    SELECT row, arg_max(d, nth) AS folded_root FROM folded GROUP BY row
), proof AS (
    SELECT row, string_agg(left_side || right_side, '' ORDER BY nth) AS siblings
    FROM numbered_path GROUP BY row
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
    folded_root = root AS verified
FROM placed p JOIN sub s ON p.source IS NOT DISTINCT FROM s.source JOIN last_fold USING (row)
    LEFT JOIN proof USING (row), top
"""


def _plus(way: str, cost: str, letter: str) -> str:
    """A way (nine digits of cost, then the audit) with one more edit."""
    return f"lpad(CAST(CAST(left({way}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({way}, 10) || '{letter}'"


def _inserted() -> str:
    """Ways to each state, also by inserts before the next row."""
    second = f"least(s2, {', '.join(_plus(f's{q}', '5', 'I') for q in (0, 1, 3))})"
    return f"s0 AS t0, s1 AS t1, {second} AS t2, least(s3, {_plus(second, '5', 'I')}) AS t3"


def _row_step() -> str:
    """Ways after a row: deleted, kept or given the role that stands next."""
    ways = {q: [_plus(f"t{q}", "2", "D")] for q in range(4)}
    for q in range(4):
        stays = "CASE WHEN fault NOT IN (1, 2){} THEN {} END"
        to, initial = (3, "a") if q == 2 else (2, "u")
        extra = "CASE WHEN fault = 4 THEN 5 ELSE 0 END"
        ways[to].append(stays.format("", _plus(f"t{q}", f"1 + {extra}", "R")))
        ways[to].append(stays.format(f" AND initial = '{initial}'", _plus(f"t{q}", extra, "K")))
        if q == 0:
            ways[1].append(stays.format(" AND initial = 's'", _plus("t0", extra, "K")))
    return ", ".join(f"least({', '.join(ways[q])})" if len(ways[q]) > 1 else ways[q][0] for q in range(4))


REPAIR = rf"""
WITH RECURSIVE fated AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM fated, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS u(copy) WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS i,
        CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE '-' END AS initial
    FROM damaged
), faulty AS (
    SELECT *, CASE
            WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 4
            ELSE 0 END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
        count(*) FILTER (WHERE fault = 4) AS truncated,
        count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), way AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1,
        CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3
    FROM counted
    UNION ALL
    SELECT w.conv_id, w.i + 1, {_row_step()}
    FROM (SELECT conv_id, i, {_inserted()} FROM way) w
        JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i
), ended AS (
    SELECT conv_id, least(t0, t3) AS way
    FROM (SELECT w.conv_id, {_inserted()} FROM way w
        JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n)
), letter AS (
    SELECT conv_id, j, substr(way, 9 + j, 1) AS edit
    FROM ended, unnest(range(1, length(way) - 8)) AS u(j)
), edited AS (
    SELECT l.conv_id, j, edit, role, text, initial,
        row_number() OVER (PARTITION BY l.conv_id ORDER BY j) - 1 AS nth,
        first_value(coalesce(edit = 'K' AND initial = 's', false)) OVER (PARTITION BY l.conv_id ORDER BY j) AS with_system
    FROM (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) - 1 AS i FROM letter) l
        LEFT JOIN faulty f ON edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i
    WHERE edit <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(
        CASE WHEN edit = 'K' THEN role
            WHEN (nth - CAST(with_system AS INTEGER)) % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS text
    FROM edited GROUP BY conv_id
), original AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
    coalesce(CAST(left(way, 9) AS BIGINT), 0) AS cost, coalesce(substr(way, 10), '') AS audit,
    sha256(coalesce(r.text, '')) AS repaired_sha256
FROM original o
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
