r"""DuckDB SQL for the queries that SQL can express, written from the contracts.

Not here: mixing (a bisection), byte-pair encoding (merges), lattice likelihoods
(a recursion over bytes with trained weights) and SimHash (XXH64 and
components); tests hold those against plain versions and the public libraries.
"""

from __future__ import annotations

from . import host_rules as H
from . import merkle, pii, repeats, secret_scan

TEXTS = "SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents"
#: fixed values: keywords in either case, spelt out
KEYWORDS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ("password", "passwd", "secret", "token", "api_?key"))


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def placed(patterns: dict[str, str]) -> str:
    """CTEs ``d`` (texts) and ``placed`` (rid, kind, ord, hit, start, stop, before, after): every match of each pattern."""
    parts = "\nUNION ALL\n".join(f"""
      SELECT rid, {q(k)} AS kind, {i} AS ord, unnest(generate_series(1, len(m))) AS i, unnest(m) AS hit,
             unnest(g[1:len(m)]) AS gap, unnest(g[2:len(m) + 1]) AS following
      FROM (SELECT rid, regexp_extract_all(t, {q(p)}) AS m, string_split_regex(t, {q(p)}) AS g FROM d)"""
                                 for i, (k, p) in enumerate(patterns.items()))
    return f"""
    d AS ({TEXTS}),
    found AS ({parts}),
    placed AS (
      SELECT rid, kind, ord, hit, stop - length(hit) AS start, stop, right(gap, {pii.CONTEXT}) AS before,
             left(following, {pii.CONTEXT}) AS after
      FROM (SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS stop FROM found))"""


def listed(order: str, where: str = "TRUE", what: str = "kind || ':' || start || ':' || stop") -> str:
    return f"coalesce(string_agg({what}, ',' ORDER BY {order}) FILTER (kind IS NOT NULL AND {where}), '')"


def count(kind: str) -> str:
    return f"count(*) FILTER (kind = '{kind}') AS n_{kind}"


SECRET_PATTERNS = secret_scan.RULES | {
    "assign": rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""}
SECRETS = f"""
WITH {placed(SECRET_PATTERNS)},
kept AS (SELECT * FROM placed
         WHERE kind <> 'assign' OR length(regexp_extract(hit, {q(SECRET_PATTERNS["assign"])}, 2)) >= {secret_scan.MIN_VALUE})
SELECT any_value(d.doc_id) AS doc_id, {", ".join(count(k) for k in secret_scan.RULES)},
       sha256({listed("start, ord", "kind IN ('assign', 'access', 'hex')")}) AS base_sha256,
       {listed("start, ord")} AS spans, sha256(any_value(d.t)) AS blob
FROM d LEFT JOIN kept USING (rid) GROUP BY rid
"""

PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b",
}


def near(kind: str) -> str:
    context = "before || ' ' || after"
    return (f"WHEN '{kind}' THEN {pii.PRIOR[kind]} + CASE WHEN regexp_matches({context}, {q(pii.NEAR[kind])}) THEN {pii.BOOST} ELSE 0 END"
            f" - CASE WHEN regexp_matches({context}, {q(pii.AGAINST)}) THEN {pii.CUT} ELSE 0 END")


PII = f"""
WITH {placed(PII_PATTERNS)},
digits AS (SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS n, replace(hit, ' ', '') AS account FROM placed),
checked AS (
  SELECT *, CASE kind
    WHEN 'email' THEN TRUE
    WHEN 'ip' THEN len([x FOR x IN string_split(hit, '.') IF coalesce(TRY_CAST(x AS HUGEINT), 256) > 255]) = 0
    WHEN 'card' THEN length(n) BETWEEN 16 AND 19 AND list_sum(
      [CASE WHEN (length(n) - i) % 2 = 0 THEN CAST(n[i] AS INTEGER)
            ELSE CAST(n[i] AS INTEGER) * 2 - 9 * CAST(CAST(n[i] AS INTEGER) > 4 AS INTEGER) END
       FOR i IN generate_series(1, length(n))]) % 10 = 0
    WHEN 'phone' THEN length(n) BETWEEN 8 AND 15
    ELSE list_reduce([CAST(c AS INTEGER) FOR c IN string_split(list_aggregate(
           [CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END
            FOR c IN string_split(account[5:] || account[:4], '')], 'string_agg', ''), '')],
           lambda a, b: (a * 10 + b) % 97) = 1 END AS good
  FROM digits),
scored AS (
  SELECT *, CAST(round(least(1.0, greatest(0.0, CAST(CASE kind {" ".join(near(k) for k in PII_PATTERNS)} END AS DOUBLE))), 2) AS VARCHAR) AS score
  FROM checked WHERE good)
SELECT any_value(d.doc_id) AS doc_id, {", ".join(count(k) for k in PII_PATTERNS)},
       sha256({listed("ord, start", "kind <> 'iban'")}) AS base_sha256, {listed("ord, start")} AS spans,
       {listed("ord, start", what="score")} AS scores
FROM d LEFT JOIN scored USING (rid) GROUP BY rid
"""

HOSTS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM d),
grams AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
m AS (SELECT w.rid, doc_id, host, len(ws) AS n_words, CAST(list_sum([length(x) FOR x IN ws]) AS BIGINT) AS chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(lines) AS n_lines
      FROM w LEFT JOIN covered ON covered.rid = w.rid),
r AS (SELECT *, coalesce(chars, 0) AS word_chars,
             n_words < {H.MIN_WORDS} OR 100 * n_repeat_words > {H.MAX_REPEAT} * n_words AS base_failed,
             n_symbols > {H.MAX_SYMBOLS} * n_words OR n_dup_lines > {H.MAX_DUP_LINES} * n_lines
             OR NOT coalesce(chars, 0) / greatest(n_words, 1) BETWEEN {H.MEAN_WORD[0]} AND {H.MEAN_WORD[1]} AS soft_failed
      FROM m),
hosts AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed OR soft_failed) AS DOUBLE) AS k FROM r GROUP BY host),
pooled AS (SELECT sum(n) AS n, sum(k) AS k, count(*) AS h, sum(k * k / n) AS kk, (sum(k) + 0.5) / (sum(n) + 1) AS mean FROM hosts),
spread AS (SELECT mean, mean * (1 - mean) AS per,
                  (greatest(0.0, kk - 2 * mean * k + mean * mean * n) - h * mean * (1 - mean)) / greatest(n - h, 1) AS between_
           FROM pooled),
prior AS (SELECT mean, CASE WHEN between_ <= 0 THEN {H.MOST_STRENGTH}
                       ELSE least({H.MOST_STRENGTH}, greatest({H.LEAST_STRENGTH}, per / between_ - 1)) END AS strength FROM spread),
rates AS (SELECT host, (k + mean * strength) / (n + strength) AS rate, n + strength AS weight FROM hosts, prior),
verdicts AS (SELECT host, round(rate, 6) AS host_rate, rate - 2 * sqrt(rate * (1 - rate) / (weight + 1)) > {H.HOST_LIMIT} AS host_bad FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (host_bad AND soft_failed) AS kept, soft_failed, r.host, host_rate, host_bad
FROM r JOIN verdicts v ON r.host IS NOT DISTINCT FROM v.host
"""

#: by the rows' order (doc_id, text checksum is not needed where ids are unique): starts of repeated windows,
#: then islands of starts at most a window apart
REPEATS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, {2 * repeats.LENGTH})) AS g
            FROM (SELECT doc_id, x, unnest(generate_series(0, length(x) // 2 - {repeats.LENGTH})) AS i FROM d)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
steps AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM later),
islands AS (SELECT doc_id, i, sum(CASE WHEN step <= {repeats.LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM steps),
gone AS (SELECT doc_id, k, min(i) AS a, max(i) + {repeats.LENGTH} AS b FROM islands GROUP BY doc_id, k),
pieces AS (
  SELECT d.doc_id, g.a, substr(d.x, 2 * coalesce(lag(g.b) OVER o, 0) + 1, 2 * (g.a - coalesce(lag(g.b) OVER o, 0))) AS piece,
         g.b, d.x
  FROM d JOIN gone g ON g.doc_id = d.doc_id WINDOW o AS (PARTITION BY g.doc_id ORDER BY g.k)),
cut AS (SELECT doc_id, sum(b - a) AS n, count(*) AS runs,
               string_agg(piece, '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept FROM pieces GROUP BY doc_id)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed, coalesce(cut.runs, 0) AS n_spans,
       sha256(unhex(coalesce(cut.kept, d.x))) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
                + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

TOP_K = """
WITH x AS (
  SELECT vec_id, [CAST(floor(CAST(c AS DOUBLE) * 256) AS BIGINT) FOR c IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, x.v)]) AS BIGINT) AS score
  FROM x q JOIN x ON q.vec_id <> x.vec_id
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""

#: a tree of up to 16 ** LEVELS nodes; DuckDB has no CRC32, so it is spelt out bit by bit
LEVELS = 8
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def climbed(t: str, p: str) -> str:
    """CTEs t1.. of nodes and p1.. of paths by level, from t0 (tree, i, n, d) and p0 (doc_id, ..., tree, i, proof, now)."""
    return ",\n".join(f"""
{t}{k + 1} AS (SELECT tree, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
               CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {t}{k} GROUP BY tree, i // 16),
{p}{k + 1} AS (
  SELECT p.* EXCLUDE (i, proof, now), p.i // 16 AS i,
         proof || CASE WHEN n = 1 THEN '' ELSE array_to_string(ds[1:p.i % 16] || ds[p.i % 16 + 2:], '') END AS proof,
         CASE WHEN n = 1 THEN now ELSE sha256(array_to_string(ds[1:p.i % 16] || [now] || ds[p.i % 16 + 2:], '')) END AS now
  FROM {p}{k} p JOIN (SELECT tree, i // 16 AS run, any_value(n) AS n, list(d ORDER BY i) AS ds FROM {t}{k} GROUP BY tree, i // 16) r
    ON p.tree = r.tree AND p.i // 16 = r.run)""" for k in range(LEVELS))


MERKLE = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({" || ".join(map(field, merkle.FIELDS))}) AS leaf,
         CASE WHEN {CRC32} % {merkle.TAMPERED} = 0 THEN sha256({" || ".join(
             field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if f == "text" else f) for f in merkle.FIELDS)}) END AS changed
  FROM documents),
p0 AS (SELECT doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, '' AS proof,
              coalesce(changed, leaf) AS now FROM leaves),
t0 AS (SELECT tree, i, count(*) OVER (PARTITION BY tree) AS n, leaf AS d FROM p0),
{climbed("t", "p")},
s0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, d, tree AS source FROM t{LEVELS}),
q0 AS (SELECT p.* EXCLUDE (tree, i), '' AS tree, s.i, s.d AS subroot FROM p{LEVELS} p JOIN s0 s ON p.tree = s.source),
{climbed("s", "q")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = d AS verified
FROM q{LEVELS} CROSS JOIN s{LEVELS}
"""

NEGATIVES = """
WITH x AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(CAST(c AS DOUBLE) * 256) AS BIGINT) FOR c IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, x.v)]) AS BIGINT) AS score
  FROM x a JOIN x ON a.vec_id <> x.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
  FROM pairs WHERE same QUALIFY positive_rank <= 5
)
SELECT anchor_id, CAST(positive_rank AS INTEGER) AS positive_rank, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SQL = {"op1_secret_scan": SECRETS, "op3_repeats": REPEATS, "op4_host_rules": HOSTS, "op6_pii": PII, "op7_topk": TOP_K,
       "op8_chat": CHAT, "op11_hard_negatives": NEGATIVES, "op12_merkle": MERKLE}
