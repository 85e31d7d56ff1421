"""DuckDB SQL of the queries that SQL can express, written without looking at how the operators work."""

from __future__ import annotations

#: The CRC-32 table, from its polynomial; the CRC-32 (unsigned) of an ASCII text needs it beside the row.
_CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i)))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    folded = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: xor(c // 256, crc.t[xor(c % 256, b) + 1]))"
    return f"xor({folded}, CAST(4294967295 AS BIGINT))"


# -- op11 -------------------------------------------------------------------------


def _leaf(text: str) -> str:
    parts = [f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, base: str) -> str:
    """``name`` (l, g, idx, n, h): all levels; ``name``_sides also the hashes to the left and right of each node in its run."""
    return f"""
{name} AS (
  SELECT 0 AS l, g, idx, n, h FROM {base}
  UNION ALL
  SELECT l + 1, g, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY l, g, idx // 8, n
), {name}_sides AS (
  SELECT l, g, idx, n, h,
         coalesce(string_agg(h, '' ) OVER (PARTITION BY l, g, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
         coalesce(string_agg(h, '' ) OVER (PARTITION BY l, g, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {name}
)"""


def _walk(name: str, tree: str, base: str) -> str:
    """``name`` (r, l, g, idx, h, proof, top): from each row of ``base`` (r, g, idx, h, proof) up to the last node of its group."""
    return f"""
{name} AS (
  SELECT r, 0 AS l, g, idx, h, proof FROM {base}
  UNION ALL
  SELECT w.r, w.l + 1, w.g, w.idx // 8, sha256(s.lft || w.h || s.rgt), w.proof || s.lft || s.rgt
  FROM {name} w JOIN {tree}_sides s ON s.l = w.l AND s.g IS NOT DISTINCT FROM w.g AND s.idx = w.idx AND s.n > 1
), {name}_top AS (
  SELECT w.r, w.g, w.h, w.proof, s.h AS top FROM {name} w JOIN {tree} s ON s.l = w.l AND s.g IS NOT DISTINCT FROM w.g AND s.idx = w.idx AND s.n = 1
)"""


_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang AS g, {_leaf('text')} AS h,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(_AZ)} ELSE {_leaf('text')} END AS start
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaves
), {_tree('low', 'placed')},
subroots AS (
  SELECT g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, 0 AS g FROM low WHERE n = 1
), {_tree('high', 'subroots')},
started AS (SELECT r, g, idx, start AS h, '' AS proof FROM placed),
{_walk('up', 'low', 'started')},
between_trees AS (SELECT u.r, 0 AS g, s.idx, u.h, u.proof, u.top AS subroot FROM up_top u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.g),
{_walk('upper', 'high', 'between_trees')}
SELECT p.doc_id, p.h AS leaf, b.subroot, t.top AS root, sha256(t.proof) AS proof_sha256, t.h AS folded_root, t.h = t.top AS verified
FROM placed p JOIN between_trees b USING (r) JOIN upper_top t USING (r)"""


# -- op13 -------------------------------------------------------------------------

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: The grammar's state (0 nothing, 1 after s, 2 after u, 3 after a) after one more u or a, and the role that this is.
_THEN = "CASE WHEN {0} = 2 THEN 3 ELSE 2 END"
_ROLE = "CASE WHEN {0} = 2 THEN 'assistant' ELSE 'user' END"
_ADD = "CASE WHEN {0} IS NULL THEN {1} ELSE {0} || chr(10) || {1} END"


def _inserted(states: str) -> str:
    """(c, i, st, cost, audit, txt) of ``states`` after none, one or two inserts; three lead nowhere."""
    one, two = _THEN.format("st"), _THEN.format(f"({_THEN.format('st')})")
    first = _ADD.format("txt", f"({_ROLE.format('st')} || ':')")
    second = _ADD.format(f"({first})", f"({_ROLE.format('(' + one + ')')} || ':')")
    return f"""(
    SELECT c, i, st, cost, audit, txt FROM {states}
    UNION ALL SELECT c, i, {one}, cost + 3, audit || 'I', {first} FROM {states}
    UNION ALL SELECT c, i, {two}, cost + 6, audit || 'II', {second} FROM {states})"""


def _edited() -> str:
    wanted = "CASE WHEN x.st = 2 THEN 'a' ELSE 'u' END"
    cut = "CASE WHEN d.fault = 'truncated' THEN 3 ELSE 0 END"
    stays = "d.fault IS NULL OR d.fault = 'truncated'"
    here = "JOIN numbered d ON d.c IS NOT DISTINCT FROM x.c AND d.pos = x.i + 1"
    kept = _ADD.format("x.txt", "(d.role || ':' || d.text)")
    reroled = _ADD.format("x.txt", f"({_ROLE.format('x.st')} || ':' || d.text)")
    return f"""
    SELECT x.c, x.i, x.st, x.cost + 4 AS cost, x.audit || 'D' AS audit, x.txt FROM opened x {here}
    UNION ALL SELECT x.c, x.i, {_THEN.format('x.st')}, x.cost + {cut}, x.audit || 'K', {kept} FROM opened x {here} WHERE ({stays}) AND d.ini = {wanted}
    UNION ALL SELECT x.c, x.i, {_THEN.format('x.st')}, x.cost + 3 + {cut}, x.audit || 'R', {reroled} FROM opened x {here} WHERE ({stays}) AND d.ini <> {wanted}
    UNION ALL SELECT x.c, x.i, 1, x.cost + {cut}, x.audit || 'K', {kept} FROM opened x {here} WHERE ({stays}) AND d.ini = 's' AND x.st = 0"""


CONVERSATIONS = f"""
WITH RECURSIVE {_CRC_TABLE},
drawn AS (
  SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS d
  FROM conversations, crc
), damaged AS (
  SELECT c, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE d <> 0 AND (copy = 1 OR d = 3)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos, substr(role, 1, 1) AS ini, right(rtrim(text, {_BLANK}), 1) AS last FROM damaged
), numbered AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(ini) OVER (PARTITION BY c ORDER BY pos) || ini AS pair FROM ordered
), sizes AS (
  SELECT o.c, count(n.pos) AS n, coalesce(max(n.turn) - min(n.turn) + 1 - count(DISTINCT n.turn), 0) AS gaps, count(*) FILTER (n.fault = 'blank') AS blank,
         count(*) FILTER (n.fault = 'duplicate') AS duplicate, count(*) FILTER (n.fault = 'truncated') AS truncated,
         count(*) FILTER (n.pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT c FROM drawn) o LEFT JOIN numbered n ON n.c IS NOT DISTINCT FROM o.c GROUP BY o.c
), states AS (
  SELECT c, CAST(0 AS BIGINT) AS i, 0 AS st, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'txt': CAST(NULL AS VARCHAR)}} AS best FROM sizes
  UNION ALL
  SELECT c, i + 1, st, min({{'cost': CAST(cost AS BIGINT), 'audit': audit, 'txt': txt}}) FROM (
    WITH flat AS (SELECT c, i, st, best.cost AS cost, best.audit AS audit, best.txt AS txt FROM states),
    opened AS (SELECT * FROM {_inserted('flat')})
    {_edited()}
  ) GROUP BY c, i, st
), ends AS (SELECT s.c, s.i, s.st, s.best.cost AS cost, s.best.audit AS audit, s.best.txt AS txt FROM states s JOIN sizes z ON z.c IS NOT DISTINCT FROM s.c AND z.n = s.i),
done AS (SELECT c, min({{'cost': CAST(cost AS BIGINT), 'audit': audit, 'txt': txt}}) AS best FROM {_inserted('ends')} WHERE st IN (0, 3) GROUP BY c)
SELECT z.c AS conv_id, z.gaps, z.blank, z.duplicate, z.truncated, z.illegal, d.best.cost AS cost, d.best.audit AS audit, sha256(coalesce(d.best.txt, '')) AS repaired_sha256
FROM sizes z JOIN done d ON d.c IS NOT DISTINCT FROM z.c"""
