"""DuckDB SQL for the corpus queries that SQL can express on small tables."""

from __future__ import annotations

from .quality import BOILERPLATE, NAVIGATION

WARC = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM m"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
place AS (SELECT doc_id, m, s, array_to_string(w[s : s + m - 1], ' ') AS phrase FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT doc_id, s, m, item_id FROM place JOIN win USING (m, phrase)),
n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS pos FROM hit) GROUP BY 1),
k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""

_NEAR = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[s : s + {n} - 1], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n} + 1, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= {percent} * (x.n + y.n - o)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN least_of ON a = d.doc_id"""
JACCARD = _NEAR.replace("{n}", "5").replace("{percent}", "75")
MINHASH = f"SELECT *, doc_id = component_id AS kept FROM ({_NEAR.replace('{n}', '2').replace('{percent}', '80')})"


_QUOTED = lambda words: ", ".join("'" + w.replace("'", "''") + "'" for w in words)

QUALITY = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s : s + 7], ' ') AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS s FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, s FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, phrase) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + 8)) AS p FROM twice) GROUP BY 1),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
m AS (SELECT doc_id, i, line, len(regexp_split_to_array(trim(line, ' '), '[\x20\x09-\x0D]+')) AS words, len(regexp_extract_all(line, '[|›»·]')) AS bars, len(regexp_extract_all(line, '[#*$%&<>]+(?:\s|[.,;:!?]|$)')) AS marks, len(regexp_extract_all(line, '!!')) AS cries, lower(line) AS low FROM l),
f AS (SELECT doc_id, i, line, bars >= 3 AND bars * 4 >= words OR length(line) <= 30 AND trim(low, ' ') IN ({_QUOTED(NAVIGATION)}) OR words >= 8 AND (marks * 4 > words OR cries * 4 > words) OR {" OR ".join(f"contains(low, {_QUOTED([p])})" for p in BOILERPLATE)} AS bad FROM m),
c AS (SELECT doc_id, length(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '')) AS kept_chars FROM f GROUP BY 1),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
b AS (SELECT d.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, kept_chars
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN c USING (doc_id)),
x AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * kept_chars >= 50 * length(t) AS kept FROM x"""

_ESCAPED = r"\\|\[INST\]|\[/INST\]|\[REPLY\]|<s>|</s>"

CHAT = rf"""WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
f AS (SELECT *, CASE WHEN role = 'assistant' THEN 12 ELSE 14 END + length(role) + len(regexp_extract_all(role, '{_ESCAPED}|\n')) + length(text) + len(regexp_extract_all(text, '{_ESCAPED}')) AS n FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""


def _lloyd(points: str, first: str, rounds: int) -> str:
    """CTEs of Lloyd's rounds over p (row, slot, place, x): c0 to c{rounds} are the points (slot, entry, place, x), n{rounds} has the nearest (row, slot, entry, d) of the last."""
    steps = [f"p AS MATERIALIZED ({points}), c0 AS MATERIALIZED ({first})"]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS (SELECT row, p.slot, entry, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM p JOIN c{k} c ON p.slot = c.slot AND p.place = c.place GROUP BY ALL),
n{k} AS MATERIALIZED (SELECT row, slot, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{k} GROUP BY ALL)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT slot, entry, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM n{k} JOIN p USING (row, slot) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.slot, c.entry, c.place, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON m.slot = c.slot AND m.entry = c.entry AND m.place = c.place)""")
    return ",\n".join(steps)


_FINITE = "embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)"
_INTEGERS = "list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"

CLUSTERS = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, {_INTEGERS.format(scale=64)} AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
s AS (SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS entry, v FROM v WHERE vec_id IS NOT NULL QUALIFY entry < 16),
{_lloyd("SELECT row, 0 AS slot, unnest(range(64)) AS place, unnest(v) AS x FROM v", "SELECT 0 AS slot, entry, unnest(range(64)) AS place, unnest(v) AS x FROM s", 3)},
h AS (SELECT entry, sha256(string_agg(x, ',' ORDER BY place)) AS centroid_sha256 FROM c3 GROUP BY 1)
SELECT vec_id, CAST(n3.entry AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY n3.entry) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN n3 USING (row) JOIN h ON h.entry = n3.entry"""

CODES = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, {_INTEGERS.format(scale=4096)} AS v FROM embeddings WHERE {_FINITE}),
s AS (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS entry, v FROM v WHERE vec_id IS NOT NULL QUALIFY entry < 16),
{_lloyd("SELECT row, i // (len(v) // 8) AS slot, i % (len(v) // 8) AS place, v[i + 1] AS x FROM (SELECT row, v, unnest(range(len(v))) AS i FROM v)", "SELECT i // (len(v) // 8) AS slot, entry, i % (len(v) // 8) AS place, v[i + 1] AS x FROM (SELECT entry, v, unnest(range(len(v))) AS i FROM s)", 6)},
h AS (SELECT sha256(string_agg(x, ',' ORDER BY slot, entry, place)) AS codebooks_sha256 FROM c6),
r AS (SELECT row, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY slot) AS code, CAST(sum(d) AS BIGINT) AS error FROM n6 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN r USING (row), h"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": WARC, "op3_decontaminate": DECONTAMINATE, "op7_quality": QUALITY, "op8_chat": CHAT, "op10_jaccard": JACCARD, "op11_minhash": MINHASH, "op12_clusters": CLUSTERS, "op13_codes": CODES}
