"""DuckDB SQL for the operators of this subpackage that SQL can express."""

from __future__ import annotations

OP7 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Shares are settled round by round: each round caps what stands above three times its source.
OP8 = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS spot, md5(coalesce(text, '')) AS body
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
           sum(sum(size)) OVER ()::BIGINT AS total
    FROM sized GROUP BY source),
rounds AS (
    SELECT 0 AS step, source, source_size, weight, total, false AS full_up FROM sources
    UNION ALL
    SELECT step + 1, source, source_size, weight, total,
           full_up OR (total - coalesce(sum(3 * source_size) FILTER (WHERE full_up) OVER (), 0))::DOUBLE
                      / sum(weight) FILTER (WHERE NOT full_up) OVER () * weight > 3 * source_size
    FROM rounds WHERE step < 40),
targets AS (
    SELECT source, source_size,
           CASE WHEN full_up THEN (3 * source_size)::DOUBLE
                ELSE (total - coalesce(sum(3 * source_size) FILTER (WHERE full_up) OVER (), 0))::DOUBLE
                     / sum(weight) FILTER (WHERE NOT full_up) OVER () * weight END AS target
    FROM rounds WHERE step = 40),
walked AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY spot, doc_id, body
                              ROWS UNBOUNDED PRECEDING) - size AS words_before FROM sized)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * size
        + greatest(0, least(size, floor(target)
              - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size
              - words_before)))::BIGINT AS taken
FROM walked JOIN targets ON walked.source IS NOT DISTINCT FROM targets.source
"""

# crc32 is folded byte by byte through its table, which the polynomial gives.
OP10 = """
WITH crc_table AS (
    SELECT list(v ORDER BY n) AS t
    FROM (SELECT n, list_reduce([n::BIGINT] || range(8), lambda c, i:
                                CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) r(n))),
bytes AS (
    SELECT doc_id, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS record,
           strlen(coalesce(text, '')) AS length, hex(encode(coalesce(text, ''))) AS digits
    FROM documents),
sums AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, record, length + 1 AS size,
           xor(list_reduce([4294967295::BIGINT]
                           || list_transform(range(1, length + 1), lambda i: ('0x' || substr(digits, 2 * i - 1, 2))::BIGINT),
                           lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
    FROM bytes, crc_table),
draws AS (
    SELECT row_no, n AS shard,
           -1.0 / ln((('0x' || substr(md5(record || ':' || n), 1, 13))::BIGINT + 0.5::DOUBLE)
                     / 4503599627370496.0::DOUBLE) AS draw
    FROM sums, range(17) AS r(n)),
placed AS (
    SELECT row_no, arg_max(shard, draw) FILTER (WHERE shard < 16) AS shard, arg_max(shard, draw) AS grown_shard
    FROM draws GROUP BY row_no)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(record), record, text_crc32, size) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM sums JOIN placed USING (row_no)
"""

# Every window of 200 bytes, counted; a byte goes if the last repeated window at or before it covers it.
OP1 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, hex(encode(coalesce(text, ''))) AS digits,
           octet_length(encode(coalesce(text, ''))) AS n_bytes
    FROM documents),
places AS (SELECT row_no, unnest(range(n_bytes)) AS place FROM docs),
windows AS (
    SELECT row_no, place, md5(substr(digits, 2 * place + 1, 400)) AS run
    FROM places JOIN docs USING (row_no) WHERE place + 200 <= n_bytes),
again AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
starts AS (SELECT row_no, place FROM windows WHERE run IN (SELECT run FROM again)),
judged AS (
    SELECT p.row_no, p.place,
           coalesce(p.place - max(s.place) OVER (PARTITION BY p.row_no ORDER BY p.place
                                                 ROWS UNBOUNDED PRECEDING) < 200, false) AS gone
    FROM places p LEFT JOIN starts s ON s.row_no = p.row_no AND s.place = p.place),
edges AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY row_no ORDER BY place), false) AS opens FROM judged),
result AS (
    SELECT row_no, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
           string_agg(substr(digits, 2 * place + 1, 2), '' ORDER BY place) FILTER (WHERE NOT gone) AS kept
    FROM edges JOIN docs USING (row_no) GROUP BY row_no)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs LEFT JOIN result USING (row_no)
"""

# Every window of 50 words with the smallest document that has it.
OP6 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(doc_id, 9223372036854775807) AS ord,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
windows AS (
    SELECT row_no, ord, place, md5(array_to_string(words[place + 1:place + 50], ' ')) AS run
    FROM (SELECT *, unnest(range(len(words) - 49)) AS place FROM docs WHERE len(words) >= 50)),
held AS (
    SELECT row_no, place FROM windows JOIN (SELECT run, min(ord) AS least FROM windows GROUP BY run) USING (run)
    WHERE least < ord),
gone AS (SELECT DISTINCT row_no, unnest(range(place, place + 50)) AS place FROM held),
spread AS (SELECT row_no, unnest(range(len(words))) AS place, unnest(words) AS word FROM docs),
kept AS (
    SELECT s.row_no, count(g.place) AS n_removed,
           string_agg(word, ' ' ORDER BY s.place) FILTER (WHERE g.place IS NULL) AS text
    FROM spread s LEFT JOIN gone g ON g.row_no = s.row_no AND g.place = s.place GROUP BY s.row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_no)
"""

# All pairs of documents that share a shingle, and what links reach from each.
OP3 = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                   END) AS shingle
    FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT one, two FROM shared JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = two
    WHERE 10 * shared.n >= 8 * (x.n + y.n - shared.n)),
reached(start, doc) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT start, two FROM reached JOIN links ON one = doc)
SELECT d.doc_id, (SELECT min(doc) FROM reached WHERE start = d.doc_id) AS class_id,
       (SELECT count(*) FROM links WHERE one = d.doc_id) AS n_links,
       coalesce((SELECT n FROM sizes WHERE sizes.doc_id = d.doc_id), 0) AS n_shingles
FROM documents d
"""

# A node is a prefix held as a list; its subtree is found through the members of the nodes below.
OP11 = r"""
WITH crc_table AS (
    SELECT list(v ORDER BY n) AS t
    FROM (SELECT n, list_reduce([n::BIGINT] || range(8), lambda c, i:
                                CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
          FROM range(256) r(n))),
convs AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
shared AS (
    SELECT conv_id, turns, conv_id - conv_id % 20 AS base,
           xor(list_reduce([4294967295::BIGINT]
                           || list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
                           lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 4 AS h
    FROM convs, crc_table),
rebuilt AS (
    SELECT own.conv_id, list_concat(coalesce(lender.turns[1:own.h], []), coalesce(own.turns[own.h + 1:], [])) AS turns
    FROM shared own LEFT JOIN convs lender ON lender.conv_id = own.base),
passes AS (
    SELECT conv_id AS member, d AS depth, min(conv_id) OVER same AS node,
           count(*) OVER (PARTITION BY d, turns[1:d]) AS n_convs, d = len(turns) AS ended,
           CASE WHEN d = 0 THEN 0
                ELSE len(regexp_extract_all(turns[d]['text'], '[^\x20\x09-\x0D]+')) END AS words
    FROM rebuilt, unnest(range(len(turns) + 1)) AS r(d)
    WINDOW same AS (PARTITION BY d, turns[1:d] ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
ends AS (
    SELECT node, depth, string_agg(member::VARCHAR, ',' ORDER BY member) AS ids FROM passes WHERE ended GROUP BY ALL),
nodes AS (
    SELECT member AS conv_id, p.depth, n_convs, (n_convs - 1) * words AS saves
    FROM passes p WHERE node = member),
children AS (
    SELECT up.node, up.depth, count(*) AS n_children
    FROM nodes JOIN passes up ON up.member = nodes.conv_id AND up.depth = nodes.depth - 1 GROUP BY ALL),
subtrees AS (
    SELECT up.node, up.depth, sum(saves) AS saved_tokens, count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
    FROM nodes JOIN passes up ON up.member = nodes.conv_id AND up.depth <= nodes.depth
    LEFT JOIN children c ON c.node = nodes.conv_id AND c.depth = nodes.depth GROUP BY up.node, up.depth)
SELECT n.conv_id, n.depth, up.node AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.conv_id AND s.depth = n.depth
LEFT JOIN children c ON c.node = n.conv_id AND c.depth = n.depth
LEFT JOIN ends e ON e.node = n.conv_id AND e.depth = n.depth
LEFT JOIN passes up ON up.member = n.conv_id AND up.depth = n.depth - 1
"""

ORACLE = {"op1_suffix_dedup": OP1, "op3_near_copies": OP3, "op6_lz_dedup": OP6, "op7_exact_dedup": OP7,
          "op8_mix_sources": OP8, "op10_rendezvous_shards": OP10, "op11_prefix_trie": OP11}


def _license_sql() -> str:
    """Every block against every template, without any filter; a block is one line of words."""
    from sessionlens.llm.license_scan import BLOCK, CONTAINMENT, LOWER, PHRASES, STEP, TEMPLATES, UPPER

    def listed(text: str) -> str:
        return "[" + ", ".join(f"'{w}'" for w in text.split()) + "]"

    phrases = ", ".join(f"({listed(p)}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({listed(text)}, ' {telling} ', '{label}')" for label, telling, text in TEMPLATES)
    return rf"""
WITH phrases(phrase, label) AS (VALUES {phrases}),
templates(own, telling, label) AS (SELECT list_distinct(t), p, l FROM (VALUES {templates}) AS v(t, p, l)),
docs AS (
    SELECT row_number() OVER () AS row_no, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
    SELECT row_no, label, unnest(list_filter(range(len(words) - len(phrase) + 1),
                                             lambda i: words[i + 1:i + len(phrase)] = phrase)) AS place
    FROM docs, phrases WHERE len(words) >= len(phrase)),
base AS (
    SELECT row_no, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           list(DISTINCT label) AS labels
    FROM places GROUP BY row_no),
blocks AS (
    SELECT row_no, list_distinct(words[start + 1:start + {BLOCK}]) AS block,
           ' ' || array_to_string(words[start + 1:start + {BLOCK}], ' ') || ' ' AS line
    FROM (SELECT row_no, words, unnest(range(0, len(words), {STEP})) AS start FROM docs)),
own AS (
    SELECT row_no, max(len(list_intersect(own, block)) / len(own)::DOUBLE) AS share, list(DISTINCT label) AS labels
    FROM blocks JOIN templates ON contains(line, telling) AND len(list_intersect(own, block)) / len(own) >= {CONTAINMENT}
    GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []),
                                                                    coalesce(own.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (row_no) LEFT JOIN own USING (row_no)
"""


ORACLE["op5_license_scan"] = _license_sql()
