"""The SQL of the queries that SQL can express, for DuckDB. The others are tested against brute force."""

from __future__ import annotations

import string

from lamina.llm import licenses, merkle, mixing, perspectives, warc
from lamina.llm.queries import QUERY_STEP, TOP


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _warc() -> str:
    eol = "chr(13) || chr(10)"
    text = "numbered"
    for name, char in warc.ENTITIES:
        text = f"replace({text}, {_q(name)}, {_q(char)})"

    def uuid(parts: str) -> str:
        h = f"md5(concat_ws('|', {parts}))"
        groups = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"'<urn:uuid:' || concat_ws('-', {groups}) || '>'"

    def lines(*fields: tuple[str, str]) -> str:
        return "concat_ws('', " + ", ".join(f"'{n}: ' || {v} || {eol}" for n, v in fields) + ")"

    facts = lines(
        ("source-record-id", "source_id"), ("source-target-uri", "url"), ("source-date", "warc_date"), ("source-block-digest", "sbd"),
        ("source-payload-digest", "spd"), ("title", "nullif(title, '')"), ("links", "len(links)::VARCHAR"),
    )
    header = f"'WARC/1.1' || {eol} || " + lines(
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "source_id"), ("WARC-Refers-To-Target-URI", "url"),
        ("WARC-Refers-To-Date", "warc_date"), ("WARC-Target-URI", "url"), ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"),
        ("WARC-Source-Payload-Digest", "spd"), ("WARC-Source-Block-Digest", "sbd"), ("Content-Type", "content_type"),
        ("Content-Length", "content_length::VARCHAR"),
    )
    code = (
        "CASE WHEN regexp_extract(x, '^[xX]([0-9a-fA-F]{1,6});', 1) <> '' THEN ('0x' || regexp_extract(x, '^[xX]([0-9a-fA-F]{1,6});', 1))::BIGINT "
        "ELSE try_cast(regexp_extract(x, '^([0-9]{1,7});', 1) AS BIGINT) END"
    )
    numbered = (
        f"array_to_string(list_transform(string_split(bare, '&#'), lambda x, i: CASE WHEN i = 1 THEN x "
        f"WHEN ({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111 "
        f"THEN chr(({code})::INTEGER) || regexp_replace(x, '^[xX]?[0-9a-fA-F]+;', '') ELSE '&#' || x END), '')"
    )
    return f"""
WITH response AS (
  SELECT page_id, url, coalesce(html, '') AS payload, '2024-01-01T00:00:00Z' AS warc_date,
         'HTTP/1.1 200 OK' || {eol} || 'Content-Type: text/html; charset=utf-8' || {eol} || 'Content-Length: ' || strlen(coalesce(html, '')) || {eol} AS http
  FROM pages),
bare AS (
  SELECT *, {uuid("'response', page_id::VARCHAR, url, md5(payload)")} AS source_id, 'sha256:' || sha256(payload) AS spd,
         'sha256:' || sha256(http || {eol} || payload) AS sbd,
         regexp_replace(regexp_extract(payload, {_q(warc.TITLE)}, 1), '[ \\t\\r\\n]+', ' ', 'g') AS title,
         list_transform(regexp_extract_all(payload, {_q(warc.LINKS)}, 1), lambda x: trim(x, {_q(warc.QUOTES)})) AS links,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(payload, {_q(warc.HIDDEN)}, '', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g'),
           {_q(warc.BREAKS)}, chr(10), 'g'), {_q(warc.TAGS)}, '', 'g') AS bare
  FROM response),
decoded AS (SELECT *, {numbered} AS numbered FROM bare),
blocks AS (
  SELECT page_id, url, warc_date, source_id, spd, sbd, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type,
         regexp_replace(regexp_replace({text}, ' *\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+\\z', '', 'g') AS block FROM decoded
  UNION ALL
  SELECT page_id, url, warc_date, source_id, spd, sbd, 'metadata', 'application/warc-fields', {facts}
         || array_to_string(list_transform(list_filter(string_split(http, {eol}), lambda h: h <> ''), lambda h: 'source-header: ' || h || {eol}), '')
         || coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || regexp_replace(x, '[\\r\\n]+', ' ', 'g') || {eol}), ''), '')
  FROM decoded),
sized AS (SELECT *, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length FROM blocks),
named AS (SELECT *, {uuid("warc_type, source_id, block_digest")} AS record_id FROM sized)
SELECT page_id, warc_type, record_id, source_id AS refers_to, url AS target_uri, content_type, content_length, block_digest,
       spd AS source_payload_digest, {header} AS header, block
FROM named"""


def _mixing() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH doc AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, md5(text))), 1, {mixing.BITS * mixing.LEVELS // 4}))::BIGINT AS position
  FROM documents),
sized AS (SELECT source, sum(size)::BIGINT AS source_size FROM doc GROUP BY source),
weighed AS (
  SELECT *, {mixing.MOST} * source_size AS bound, ([{weights}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INTEGER] AS weight,
         sum(source_size) OVER ()::DOUBLE * {mixing.SHARE} AS budget
  FROM sized),
filled AS (
  SELECT *, bound <= weight * ((budget - coalesce(sum(bound) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE) AS is_full
  FROM weighed WINDOW w AS (ORDER BY bound / weight, source NULLS LAST)),
aimed AS (
  SELECT *, CASE WHEN is_full THEN bound::DOUBLE ELSE weight * ((budget - coalesce(sum(bound) FILTER (is_full) OVER (), 0)::DOUBLE)
         / sum(weight) FILTER (NOT is_full) OVER ()::DOUBLE) END AS target
  FROM filled),
plan AS (
  SELECT *, CASE WHEN target >= 2 * source_size THEN 2 WHEN target >= source_size THEN 1 ELSE 0 END AS copies FROM aimed),
placed AS (
  SELECT doc_id, size, source_size, target, copies, target - copies * source_size AS rest,
         sum(size) OVER (PARTITION BY doc.source ORDER BY position RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS upto,
         sum(size) OVER (PARTITION BY doc.source, position)::DOUBLE AS here
  FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target, (size * (copies + (rest > 0 AND 2 * (rest - (upto - here)) >= here AND upto - here < rest)::INTEGER))::BIGINT AS taken
FROM placed"""


def _nearest() -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v, row_number() OVER () AS place FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.place, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.place <> c.place AND len(q.v) = len(c.v) WHERE q.vec_id % {QUERY_STEP} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}"""


def _licenses() -> str:
    known = "MAP {" + ", ".join(f"{_q(s)}: {_q(i)}" for s, i in licenses.SENTENCES.items()) + "}"

    def norm(x: str) -> str:
        return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"

    rules = ", ".join(f"CASE WHEN contains(line, {_q(' ' + ' '.join(ids) + ' ')}) THEN {_q(name)} END" for name, ids in licenses.RULES)
    order = list(dict.fromkeys(name for name, _ in licenses.RULES))
    return f"""
WITH parts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), {_q(licenses.BOUNDARY)}), lambda s: regexp_matches(s, {_q(licenses.SIGN)})) AS parts FROM documents),
found AS (
  SELECT doc_id, flatten(list_transform(parts, lambda s: CASE WHEN ({known})[{norm("s")}] IS NOT NULL THEN [({known})[{norm("s")}]]
         ELSE list_filter(list_transform(string_split(s, chr(10)), lambda x: ({known})[{norm("x")}]), lambda i: i IS NOT NULL) END)) AS ids
  FROM parts),
lined AS (SELECT doc_id, ids, ' ' || coalesce(array_to_string(ids, ' '), '') || ' ' AS line FROM found),
named AS (SELECT *, list_filter([{rules}], lambda n: n IS NOT NULL) AS names FROM lined)
SELECT doc_id, trim(line) AS identifiers,
       coalesce(array_to_string(list_filter([{", ".join(map(_q, order))}], lambda n: list_contains(names, n)), ','), '') AS licenses,
       len(ids)::BIGINT AS n_known
FROM named"""


def _perspectives() -> str:
    p = perspectives
    begin, end = _q(p.BEGIN), f"{_q(p.END.rstrip())} || chr(10)"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '{p.NAMELESS}') AS speaker, coalesce(text, '') AS text FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{p.SYSTEM}'),
shown AS (
  SELECT t.*, perspective, speaker = perspective AS own,
         CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = '{p.SYSTEM}' THEN '{p.SYSTEM}' ELSE 'user' END AS role,
         CASE WHEN speaker <> perspective AND speaker <> '{p.SYSTEM}' THEN speaker END AS name
  FROM t JOIN people ON t.conv_id IS NOT DISTINCT FROM people.conv_id),
headed AS (SELECT *, {begin} || role || coalesce(' name=' || name, '') || chr(10) AS head FROM shown),
sized AS (SELECT *, head || text || {end} AS message FROM headed),
placed AS (
  SELECT *, coalesce(sum(length(message)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized)
SELECT conv_id, perspective, turn, role, name, message, start, start + length(message) AS "end",
       CASE WHEN own THEN start + length(head) END AS train_start, CASE WHEN own THEN start + length(message) END AS train_end
FROM placed"""


def _merkle() -> str:
    def leaf(text: str) -> str:
        fields = [
            f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" if c != "text" else f"coalesce(strlen({text}) || ':' || {text}, '-')"
            for c in merkle.LEAF_COLUMNS
        ]
        return f"sha256({' || '.join(fields)})"

    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH RECURSIVE byte(i) AS (SELECT unnest(range(256))),
shifted(i, step, c) AS (
  SELECT i, 0, i::BIGINT FROM byte
  UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM shifted WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM shifted WHERE step = 8),
plain AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(f"translate(text, '{upper}', '{lower}')")} AS lowered,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda c, d: xor(t[(xor(c, d) & 255) + 1], c >> 8))) AS crc
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN crc % {merkle.TAMPER_STEP} = 0 THEN lowered ELSE leaf END AS given,
         coalesce('=' || lang, '-') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position,
         count(*) OVER (PARTITION BY lang) AS n
  FROM plain),
nodes(tree, level, position, n, digest) AS (
  SELECT tree, 0, position, n, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, position // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(digest, '' ORDER BY position))
  FROM nodes WHERE n > 1 GROUP BY tree, level, position // {merkle.FAN}, n),
subroots AS (SELECT tree, level AS levels, digest, row_number() OVER (ORDER BY tree) - 1 AS position, count(*) OVER () AS n FROM nodes WHERE n = 1),
above(level, position, n, digest) AS (
  SELECT 0, position, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, position // {merkle.FAN}, (n + {merkle.FAN - 1}) // {merkle.FAN}, sha256(string_agg(digest, '' ORDER BY position))
  FROM above WHERE n > 1 GROUP BY level, position // {merkle.FAN}, n),
runs AS (
  SELECT tree, level, position // {merkle.FAN} AS run, list(digest ORDER BY position) AS digests FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.tree, s.levels + a.level, r.run, r.digests
  FROM subroots s, (SELECT DISTINCT level FROM above WHERE n > 1) a,
       (SELECT level, position // {merkle.FAN} AS run, list(digest ORDER BY position) AS digests FROM above WHERE n > 1 GROUP BY ALL) r
  WHERE r.level = a.level AND r.run = s.position // ({merkle.FAN} ** (a.level + 1))::BIGINT),
walk(doc_id, tree, leaf, place, level, position, proof, cur) AS (
  SELECT doc_id, tree, leaf, position, 0, position, '', given FROM leaves
  UNION ALL
  SELECT w.doc_id, w.tree, w.leaf, w.place, w.level + 1, CASE WHEN w.level + 1 = s.levels THEN s.position ELSE w.position // {merkle.FAN} END,
         w.proof || coalesce(array_to_string(list_concat(r.digests[:own], r.digests[own + 2:]), ''), ''),
         sha256(coalesce(array_to_string(r.digests[:own], ''), '') || w.cur || coalesce(array_to_string(r.digests[own + 2:], ''), ''))
  FROM (SELECT *, position % {merkle.FAN} AS own FROM walk) w JOIN subroots s USING (tree)
  JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.position // {merkle.FAN}),
root AS (SELECT digest AS root FROM above WHERE n = 1),
ended AS (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level DESC) AS latest FROM walk)
SELECT e.doc_id, e.leaf, s.digest AS subroot, root, sha256(e.proof) AS proof_sha256, e.cur AS folded_root, e.cur = root AS verified,
       nullif(e.tree[2:], '') AS lang, e.place AS "position", e.level::INTEGER AS n_levels
FROM ended e JOIN subroots s USING (tree), root WHERE latest = 1"""


def statements() -> dict[str, str]:
    return {
        "op1_warc_derivatives": _warc(),
        "op2_mix_to_weights": _mixing(),
        "op5_kdtree_top_k": _nearest(),
        "op8_license_scan": _licenses(),
        "op9_perspectives": _perspectives(),
        "op13_merkle_manifest": _merkle(),
    }
