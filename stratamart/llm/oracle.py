"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

# Keys are lines without [\x20\x09-\x0D] at both ends, A-Z lower-cased.
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINES = rf"""
numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, i, part[i] AS line,
    translate(trim(part[i], {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, part, unnest(range(1, len(part) + 1)) AS i
        FROM (SELECT r, doc_id, string_split(text, chr(10)) AS part FROM numbered))
)"""

LINE_DEDUP = rf"""
WITH {_LINES},
repeated AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
marked AS (SELECT l.*, g.key IS NOT NULL AS gone FROM lines l LEFT JOIN repeated g ON l.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

# Sets of 5-word shingles, pairs that share a shingle, and the smallest id reachable.
MINHASH = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS common
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 85 * (nx + ny - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS root FROM sets
  UNION
  SELECT e.y AS id, r.root FROM reach r JOIN edges e ON r.id = e.x WHERE r.root < e.y
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, root AS component_id, doc_id = root AS kept
FROM sets JOIN (SELECT id, min(root) AS root FROM reach GROUP BY id) ON id = doc_id
"""

# Windows of 50 bytes are 100 digits of the text in hexadecimal.
SUBSTRING_DEDUP = r"""
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, q, substr(h, 2 * q + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS q FROM coded WHERE length(h) >= 100)
),
least AS (SELECT hash(w) AS k, w, min(doc_id) AS first FROM windows GROUP BY w),
found AS (SELECT a.doc_id, a.q FROM windows a JOIN least b ON a.w = b.w WHERE b.first < a.doc_id),
runs AS (
  SELECT doc_id, min(q) AS low, max(q) + 50 AS high FROM (
    SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY q) AS run FROM (
      SELECT *, CASE WHEN q <= 50 + lag(q) OVER (PARTITION BY doc_id ORDER BY q) THEN 0 ELSE 1 END AS new FROM found))
  GROUP BY doc_id, run
),
pieces AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS tail,
    string_agg(kept, '' ORDER BY low) AS before
  FROM (
    SELECT r.doc_id, low, high, substr(h, 2 * last + 1, 2 * (low - last)) AS kept
    FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS last FROM runs) r
    JOIN coded c ON c.doc_id = r.doc_id)
  GROUP BY doc_id
)
SELECT c.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN p.doc_id IS NULL THEN h ELSE before || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM coded c LEFT JOIN pieces p ON p.doc_id = c.doc_id
"""

# Codebooks of 8 x 16 entries, refined six times by exact integer distances.
_FLOORED = "list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT))"


def _vector_codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    steps = [rf"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, {_FLOORED} AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cut AS MATERIALIZED (
  SELECT r, vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS a
  FROM kept, range({parts}) AS places(p)
),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, a FROM cut WHERE r <= {entries})"""]
    for at in range(rounds + 1):
        steps.append(rf"""
near{at} AS MATERIALIZED (
  SELECT r, p, min((d, e)) AS best FROM (
    SELECT c.r, c.p, b.e, list_sum(list_transform(range(1, len(c.a) + 1),
      lambda i: (c.a[i] - b.a[i]) * (c.a[i] - b.a[i]))) AS d
    FROM cut c JOIN book{at} b ON b.p = c.p)
  GROUP BY r, p
)""")
        if at < rounds:
            steps.append(rf"""
book{at + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.a, b.a) AS a FROM book{at} b LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS a FROM (
      SELECT p, e, i, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM (
        SELECT c.p, n.best[2] AS e, unnest(range(1, len(c.a) + 1)) AS i, unnest(c.a) AS x
        FROM cut c JOIN near{at} n ON n.r = c.r AND n.p = c.p)
      GROUP BY p, e, i)
    GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
)""")
    return "WITH" + ",".join(steps) + rf"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', n.best[2]), '' ORDER BY n.p) AS code,
    CAST(sum(n.best[1]) AS BIGINT) AS error
  FROM kept k JOIN near{rounds} n ON n.r = k.r GROUP BY k.r, k.vec_id, k.label),
  (SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY p, e)) AS sha FROM book{rounds})
"""


# Lightest edits, a turn at a time: s0 to s3 are the lightest (cost, audit) of every state
# of the grammar, insertions behind the turn included.
def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _plus(state: str, cost: str, letters: str) -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}'}} END"


def _when(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} END"


def _closed(states: list[str]) -> str:
    """Four states after up to two insertions."""
    none, s, u, pair = states
    user = [u, _plus(none, "2", "I"), _plus(s, "2", "I"), _plus(pair, "2", "I")]
    both = [pair, _plus(u, "2", "I"), _plus(none, "4", "II"), _plus(s, "4", "II")]
    return f"{none} AS s0, {s} AS s1, {_least(*user)} AS s2, {_least(*both)} AS s3"


def _turn_repair() -> str:
    def state(own: str, moves: list[tuple[str, str]]) -> str:
        """``own`` kept by deletion; (state, initial) moves by keeping or giving a role."""
        ways = [_plus(own, "3", "D")]
        for before, initial in moves:
            ways.append(_when(f"may AND initial = '{initial}'", _plus(before, "extra", "K")))
            if initial != "s":
                ways.append(_when("may", _plus(before, "2 + extra", "R")))
        return _least(*ways)

    moved = [
        state("s0", []), state("s1", [("s0", "s")]),
        state("s2", [("s0", "u"), ("s1", "u"), ("s3", "u")]), state("s3", [("s2", "a")])]
    start = ["{'c': CAST(0 AS BIGINT), 'a': ''}"] + ["CAST(NULL AS STRUCT(c BIGINT, a VARCHAR))"] * 3
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
    ORDER BY b) AS t FROM range(256) AS bytes(b)
),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) % 20 AS kind
  FROM conversations, crc
),
turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, {_SPACE}) AS stripped, role[1] AS initial FROM turns
),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN stripped = '' THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN stripped[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
),
derived AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {_closed(start)} FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_closed(["n0", "n1", "n2", "n3"])} FROM (
    SELECT conv_id, i, {", ".join(f"{m} AS n{k}" for k, m in enumerate(moved))} FROM (
      SELECT d.conv_id, j.i, s0, s1, s2, s3, j.initial, j.fault NOT IN ('b', 'd') AS may,
        CASE WHEN j.fault = 't' THEN 1 ELSE 0 END AS extra
      FROM derived d JOIN judged j ON j.conv_id IS NOT DISTINCT FROM d.conv_id AND j.i = d.i + 1))
),
best AS (
  SELECT conv_id, list_min([arg_max(s0, i), arg_max(s3, i)]) AS w FROM derived GROUP BY conv_id
),
edits AS (
  SELECT conv_id, k, w.a[k] AS edit, len(replace(w.a[:k], 'I', '')) AS i
  FROM (SELECT conv_id, w, unnest(range(1, len(w.a) + 1)) AS k FROM best)
),
rows AS (
  SELECT e.conv_id, e.k, CASE WHEN edit = 'I' THEN '' ELSE j.text END AS text,
    CASE WHEN edit = 'K' THEN j.role END AS role
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i AND e.edit <> 'I'
  WHERE edit <> 'D'
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k)
    - max(CASE WHEN role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS nth
  FROM rows
),
repaired AS (
  SELECT conv_id, string_agg(coalesce(role, CASE WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text,
    chr(10) ORDER BY k) AS text FROM numbered GROUP BY conv_id
)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, w.c AS cost, w.a AS audit,
  sha256(coalesce(text, '')) AS repaired_sha256
FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""


ORACLE_SQL = {
    "op4_line_dedup": LINE_DEDUP,
    "op8_substring_dedup": SUBSTRING_DEDUP,
    "op10_minhash": MINHASH,
    "op12_vector_codes": _vector_codes(),
    "op13_turn_repair": _turn_repair(),
}
