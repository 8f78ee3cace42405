"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from .queries import MIX_SEED, MIX_WEIGHTS

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP2 = rf"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS pos, w FROM split WHERE len(w) >= 50),
keyed AS (SELECT doc_id, pos, sha256(array_to_string(w[pos : pos + 49], ' ')) AS k FROM windows),
first AS (SELECT k, min(doc_id) AS low FROM keyed GROUP BY k),
hits AS (SELECT doc_id, pos FROM keyed JOIN first USING (k) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM hits),
kept AS (SELECT words.*, gone.pos IS NOT NULL AS gone FROM words LEFT JOIN gone USING (doc_id, pos)),
sums AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM split LEFT JOIN sums USING (doc_id)
"""

_TOKENS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKENS}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TOKENS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + 12], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, dw.n, p FROM dw JOIN iw USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _weight_sql(weights: dict, column: str) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k[-1]}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _level_sql(name: str, path: list[str], weights: dict) -> str:
    """A level of the budget tree: nodes in order of saturation, then whole-number shares of what is left."""
    here, up = ", ".join(path), path[:-1]
    join = f"JOIN l{len(path) - 1} USING ({', '.join(up)})" if up else "CROSS JOIN l0"
    by = f"PARTITION BY {', '.join(up)}" if up else "PARTITION BY 1"
    order = f"{by} ORDER BY weight = 0, capacity / nullif(weight, 0)::DOUBLE, {path[-1]}"
    return f"""
n{len(path)} AS (SELECT {here}, sum(capacity)::BIGINT AS capacity, {_weight_sql(weights, path[-1])}::BIGINT AS weight FROM leaves GROUP BY {here}),
o{len(path)} AS (SELECT *, budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used,
       (sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open FROM n{len(path)} {join}),
s{len(path)} AS (SELECT *, weight > 0 AND capacity * open <= used * weight AS short FROM o{len(path)}),
l{len(path)} AS (SELECT {here}, (CASE WHEN short THEN capacity ELSE
       coalesce((max(used) FILTER (NOT short) OVER ({by})) * weight // nullif(max(open) FILTER (NOT short) OVER ({by}), 0), 0) END)::BIGINT AS budget FROM s{len(path)})"""


_PATH = ["domain", "lang", "source"]
OP4 = rf"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       CASE try_cast(regexp_extract(coalesce(source, ''), '^src([0-9]{{1,6}})$', 1) AS INT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forum' ELSE 'other' END AS domain,
       len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, 3 * sum(n_tokens)::BIGINT AS capacity FROM docs GROUP BY ALL),
l0 AS (SELECT least(sum(capacity), sum(tokens) * 3 // 4)::BIGINT AS budget FROM leaves),
{",".join(_level_sql("", _PATH[: i + 1], MIX_WEIGHTS[i]) for i in range(3))},
plans AS (SELECT domain, lang, source, tokens AS leaf_tokens, budget AS leaf_budget, coalesce(budget // nullif(tokens, 0), 0) AS epochs FROM leaves JOIN l3 USING (domain, lang, source)),
drawn AS (SELECT *, leaf_budget - epochs * leaf_tokens AS rest, md5('{MIX_SEED}:' || epochs || ':' || doc_id) AS ticket FROM docs JOIN plans USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ticket, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM drawn)
SELECT doc_id, domain, lang, source, n_tokens, leaf_tokens, leaf_budget, epochs + (rest > 0 AND upto <= rest)::BIGINT AS copies FROM summed
"""

OP9 = """
WITH turns AS (SELECT DISTINCT conv_id, coalesce(turn, 0) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
views AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
said AS (SELECT *, floor(turn / 64.0)::BIGINT AS part, role = perspective AS own, CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user:' || role || '|>' END || chr(10) AS head
         FROM views JOIN turns USING (conv_id)),
placed AS (SELECT *, coalesce(sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, perspective ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM said)
SELECT conv_id, part, perspective, count(*) AS n_turns, count(*) FILTER (own) AS n_masked,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered,
       coalesce(string_agg(start::BIGINT || ':' || (start + length(text) + 7)::BIGINT, ',' ORDER BY turn, role, text) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, part, perspective
"""

ORACLE_SQL = {"op1_line_dedup": OP1, "op2_substring_dedup": OP2, "op3_decontamination": OP3, "op4_source_mixing": OP4, "op9_chat_formatting": OP9}
