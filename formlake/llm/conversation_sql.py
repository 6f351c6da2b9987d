"""The damage and repair of conversations as one SQL statement, for tables that SQL can hold.

The cheapest audit up to a turn is kept for each state as text: nine digits of cost, then
the edits, so that the least text is the cheapest and of those the ASCII-least.
"""

from __future__ import annotations


def _with(before: str, cost: int | str, edit: str) -> str:
    return f"(lpad(CAST(CAST({before}[:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {before}[10:] || '{edit}')"


_INSERTED_USER = f"least(u, {_with('o', 2, 'I')}, {_with('s', 2, 'I')}, {_with('a', 2, 'I')})"
_INSERTED_ASSISTANT = f"least(a, {_with('u1', 2, 'I')})"


def _case(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _taken(initial: str, before: str) -> str:
    """Keep or rename a turn, whichever costs less."""
    kept = _case(f"NOT gone AND initial = '{initial}'", _with(before, "unfinished", "K"))
    renamed = _case("NOT gone", _with(before, "2 + unfinished", "R"))
    return f"least({kept}, {renamed})"


ORACLE = rf"""
WITH RECURSIVE checksum_steps(n, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM checksum_steps WHERE k < 8
), checksum AS (
    SELECT list(c ORDER BY n) AS t FROM checksum_steps WHERE k = 8
), named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id
    FROM conversations
), fated AS (
    SELECT named.*, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(id[i:i]) AS BIGINT))),
        lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS fate
    FROM named, checksum
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM fated WHERE fate <> 0
), ordered AS (
    SELECT *, sha256(length(role) || ':' || role || text) AS tie,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body, role[1:1] AS initial
    FROM damaged
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy) AS n,
           row_number() OVER (PARTITION BY conv_id, tie ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM ordered
), faults AS (
    SELECT *, body = '' AS is_blank, body <> '' AND again AS is_duplicate,
           body <> '' AND NOT again AND body[-1:] NOT IN ('.', '!', '?') AS is_truncated,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
    FROM numbered
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_duplicate) AS duplicate,
           count(*) FILTER (is_truncated) AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS turns
    FROM faults GROUP BY conv_id
), walk(conv_id, n, o, s, u, a) AS (
    SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
    FROM counted
    UNION ALL
    SELECT w.conv_id, w.n + 1,
           {_with("o", 3, "D")},
           least({_with("s", 3, "D")}, {_case("NOT gone AND initial = 's'", _with("o", "unfinished", "K"))}),
           least({_with("u1", 3, "D")}, {_taken("u", "o")}, {_taken("u", "s")}, {_taken("u", "a1")}),
           least({_with("a1", 3, "D")}, {_taken("a", "u1")})
    FROM (SELECT *, {_INSERTED_ASSISTANT} AS a1 FROM (SELECT *, {_INSERTED_USER} AS u1 FROM walk)) w
    JOIN (SELECT conv_id, n, initial, is_blank OR is_duplicate AS gone, CAST(is_truncated AS INT) AS unfinished
          FROM faults) f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.n = w.n + 1
), ends AS (
    SELECT c.conv_id, least(o, {_INSERTED_ASSISTANT}) AS best
    FROM (SELECT *, {_INSERTED_USER} AS u1 FROM walk) w
    JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = c.turns
), edits AS (
    SELECT conv_id, best[10:] AS audit, unnest(range(1, length(best) - 8)) AS p FROM ends
), placed AS (
    SELECT *, length(regexp_replace(audit[1:p], 'I', '', 'g')) AS n,
           length(regexp_replace(audit[1:p], 'D', '', 'g')) AS place, audit[p:p] AS edit
    FROM edits
), put AS (
    SELECT p.conv_id, p.p, p.place, p.edit, f.role, CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text,
           max(CASE WHEN p.place = 1 AND edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END)
               OVER (PARTITION BY p.conv_id) AS led
    FROM placed p LEFT JOIN faults f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.n = f.n AND edit <> 'I'
    WHERE edit <> 'D'
), repaired AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
        chr(10) ORDER BY p)) AS digest
    FROM put GROUP BY conv_id
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(best[:9] AS BIGINT), 0) AS cost, coalesce(best[10:], '') AS audit,
       coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counted c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON k.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON k.conv_id IS NOT DISTINCT FROM r.conv_id
"""
