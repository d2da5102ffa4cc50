"""SQL counterparts of the operators that SQL can express, for an independent engine."""

from __future__ import annotations

from gridpulse.llm.sharding import LAW

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A CRC-32 table by its rule, and a checksum over the bytes of a text.
CRC_TABLE = """crc_rows AS (
    SELECT b, list_reduce(list_prepend(b, range(0, 8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(0, 256) t(b)
),
crc_table AS (SELECT list(v ORDER BY b) AS crcs FROM crc_rows)"""


def crc32(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), {step}))"


def base32_sha1(text: str) -> str:
    """Forty hex digits as four numbers of forty bits, eight digits each."""
    digit = f"substr('{UPPER}234567', CAST((v >> (35 - 5 * j)) & 31 AS BIGINT) + 1, 1)"
    number = f"CAST('0x' || substr(sha1({text}), 10 * i + 1, 10) AS BIGINT)"
    each = f"list_transform(range(0, 8), lambda j: {digit.replace('v', number, 1)})"
    return f"array_to_string(flatten(list_transform(range(0, 4), lambda i: {each})), '')"


def near_duplicates(width: int, percent: int) -> str:
    return f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) = 0 THEN []::VARCHAR[]
            WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
        END) AS s
        FROM docs
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * k >= {percent} * (p.n + q.n - k)
    ),
    reached AS (
        SELECT doc_id, doc_id AS root FROM docs
        UNION
        SELECT y, root FROM reached JOIN links ON x = doc_id
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.root AS component_id, d.doc_id = r.root AS kept
    FROM docs d
    JOIN (SELECT doc_id, min(root) AS root FROM reached GROUP BY doc_id) r USING (doc_id)
    LEFT JOIN sizes s USING (doc_id)"""


def vector_duplicates(least: float) -> str:
    return f"""
    WITH RECURSIVE vectors AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    ),
    good AS (
        SELECT * FROM vectors
        WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(v, lambda x: abs(x))) > 0
    ),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= {least}
    ),
    reached AS (
        SELECT vec_id, vec_id AS root FROM vectors
        UNION
        SELECT y, root FROM reached JOIN links ON x = vec_id
    )
    SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, min(root) AS component_id,
           vec_id = min(root) AS kept
    FROM reached GROUP BY vec_id"""


WARC = f"""
    SELECT page_id, octet_length(encode(h)) AS payload_bytes, {base32_sha1("h")} AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM (
        SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages
    )"""


def shards(count: int, seed: int) -> str:
    return f"""
    WITH {CRC_TABLE},
    rows_ AS (
        SELECT doc_id, source, coalesce('=' || source, '') AS stratum, octet_length(encode(coalesce(text, ''))) + 1 AS size,
               {crc32("coalesce(text, '')")} AS text_crc32,
               CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 15) AS BIGINT) AS key
        FROM documents, crc_table
    ),
    ranked AS (
        SELECT *, (CAST(row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, size, text_crc32) AS DOUBLE) - 0.5)
               / count(*) OVER (PARTITION BY stratum) AS fraction
        FROM rows_
    ),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY fraction, stratum, key, doc_id, size, text_crc32) - 1 AS place,
               count(*) OVER () AS n
        FROM ranked
    ),
    cut AS (SELECT *, place * {count} // n AS shard FROM placed)
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, '{LAW}' AS law,
           CAST(shard AS INTEGER) AS shard, CAST(place - (shard * n + {count - 1}) // {count} AS BIGINT) AS slot,
           CAST(NULL AS INTEGER) AS grown_shard, source AS stratum_source
    FROM cut"""


def _framed(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _leaf(count: str) -> str:
    return f"sha256({' || '.join(map(_framed, ('doc_id', 'source', 'lang', count, 'text')))})"


def _levels(name: str, leaves: str) -> str:
    """Nodes of all levels over (tree, k, d), and the depth of each tree."""
    return f"""{name}(tree, lvl, k, d) AS (
        SELECT tree, 0, k, d FROM {leaves}
        UNION ALL
        SELECT tree, lvl + 1, k // 2, sha256(string_agg(d, '' ORDER BY k))
        FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1
        GROUP BY tree, lvl, k // 2
    ),
    {name}_top AS (SELECT tree, max(lvl) AS depth, max_by(d, lvl) AS d FROM {name} GROUP BY tree)"""


def _folded(name: str, start: str, nodes: str) -> str:
    """Ways up from (id, tree, k, d, proof), one row a level."""
    return f"""{name}(id, tree, lvl, k, d, proof) AS (
        SELECT id, tree, 0, k, d, proof FROM {start}
        UNION ALL
        SELECT f.id, f.tree, f.lvl + 1, f.k // 2,
               sha256(CASE WHEN f.k % 2 = 1 THEN s.d || f.d ELSE f.d || coalesce(s.d, '') END),
               f.proof || coalesce(s.d, '')
        FROM {name} f JOIN {nodes}_top t ON t.tree = f.tree AND f.lvl < t.depth
        LEFT JOIN {nodes} s ON s.tree = f.tree AND s.lvl = f.lvl AND s.k = xor(f.k, 1)
    ),
    {name}_end AS (SELECT f.* FROM {name} f JOIN {nodes}_top t ON t.tree = f.tree AND t.depth = f.lvl)"""


MERKLE = f"""
    WITH RECURSIVE {CRC_TABLE},
    given AS (
        SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
               CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS tampered
        FROM documents, crc_table
    ),
    leaves AS (
        SELECT *, leaf AS d, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM given
    ),
    {_levels("inner_nodes", "leaves")},
    groups_ AS (
        SELECT '' AS tree, tree AS grp, row_number() OVER (ORDER BY tree) - 1 AS k, d FROM inner_nodes_top
    ),
    {_levels("outer_nodes", "groups_")},
    ways AS (SELECT id, tree, k, coalesce(tampered, leaf) AS d, '' AS proof FROM leaves),
    {_folded("inner_ways", "ways", "inner_nodes")},
    between_ AS (
        SELECT w.id, g.tree, g.k, w.d, w.proof FROM inner_ways_end w JOIN groups_ g ON g.grp = w.tree
    ),
    {_folded("outer_ways", "between_", "outer_nodes")}
    SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, sha256(w.proof) AS proof_sha256, w.d AS folded_root,
           w.d = r.d AS verified
    FROM leaves l JOIN outer_ways_end w ON w.id = l.id JOIN inner_nodes_top s ON s.tree = l.tree
    JOIN outer_nodes_top r ON true"""


def conversation_repair() -> str:
    far = 1 << 40
    stays = f"CASE WHEN fault IN ('b', 'd') THEN {far} WHEN fault = 't' THEN 5 ELSE 0 END"

    def plain(state: str, kept: str, rerole: str) -> str:
        return f"least(2 + {state}, {stays} + ({kept}), {stays} + 1 + {rerole})"

    kept = {
        "e": f"CASE initial WHEN 's' THEN s WHEN 'u' THEN u ELSE {far} END",
        "s": f"CASE initial WHEN 'u' THEN u ELSE {far} END",
        "u": f"CASE initial WHEN 'a' THEN a ELSE {far} END",
        "a": f"CASE initial WHEN 'u' THEN u ELSE {far} END",
    }
    to = {"e": "u", "s": "u", "u": "a", "a": "u"}
    # Before a row without an insert, then with: one insert more only leads back.
    first = ", ".join(f"{plain(q, kept[q], to[q])} AS {q}0" for q in kept)
    second = "least(u0, 5 + a0) AS u1, least(a0, 5 + u0) AS a1, least(e0, 5 + least(u0, 5 + a0)) AS e1, least(s0, 5 + least(u0, 5 + a0)) AS s1"
    acts = ", ".join(
        f"CASE WHEN 2 + {q} = {q}1 THEN 'D' WHEN 5 + {to[q]}1 = {q}1 THEN 'I' "
        f"WHEN {stays} + ({kept[q]}) = {q}1 THEN 'K' ELSE 'R' END AS act_{q}"
        for q in kept
    )
    act = "CASE state WHEN 'e' THEN act_e WHEN 's' THEN act_s WHEN 'u' THEN act_u ELSE act_a END"
    after_insert = "CASE state WHEN 'u' THEN 'a' ELSE 'u' END"
    word = "CASE state WHEN 'u' THEN 'assistant' ELSE 'user' END"
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    WITH RECURSIVE {CRC_TABLE},
    given AS (
        SELECT coalesce('=' || conv_id, '') AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
        FROM conversations, crc_table
    ),
    hurt AS (
        SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE kind WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM given)
    ),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial,
               rtrim(text, {blanks}) AS body
        FROM hurt
    ),
    judged AS (
        SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
                    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
               lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
        FROM numbered
    ),
    counts AS (
        SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv
    ),
    costs AS (
        SELECT conv, n + 1 AS i, 0 AS e, 10 AS s, 5 AS u, 0 AS a, '' AS act_e, 'I' AS act_s, 'I' AS act_u, '' AS act_a FROM counts
        UNION ALL
        SELECT conv, i, e1, s1, u1, a1, {acts}
        FROM (
            SELECT *, {second} FROM (
                SELECT c.conv, j.i, j.initial, j.fault, c.e, c.s, c.u, c.a, {first}
                FROM costs c JOIN judged j ON j.conv = c.conv AND j.i = c.i - 1
            )
        )
    ),
    walk AS (
        SELECT conv, CAST(1 AS BIGINT) AS i, 'e' AS state, '' AS audit, []::VARCHAR[] AS lines, false AS done FROM counts
        UNION ALL
        SELECT conv, CASE WHEN act IN ('D', 'K', 'R') THEN i + 1 ELSE i END,
               CASE act WHEN 'K' THEN initial WHEN 'I' THEN {after_insert} WHEN 'R' THEN {after_insert} ELSE state END,
               audit || act,
               CASE act WHEN 'K' THEN list_append(lines, role || ':' || text) WHEN 'I' THEN list_append(lines, {word} || ':')
                        WHEN 'R' THEN list_append(lines, {word} || ':' || text) ELSE lines END,
               act = ''
        FROM (
            SELECT w.*, j.role, j.text, j.initial, {act} AS act
            FROM walk w JOIN costs c ON c.conv = w.conv AND c.i = w.i
            LEFT JOIN judged j ON j.conv = w.conv AND j.i = w.i
            WHERE NOT w.done
        )
    )
    SELECT g.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
           coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, coalesce(CAST(c.e AS BIGINT), 0) AS cost,
           coalesce(w.audit, '') AS audit, sha256(coalesce(array_to_string(w.lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv, conv_id FROM given) g
    LEFT JOIN counts n ON n.conv = g.conv
    LEFT JOIN costs c ON c.conv = g.conv AND c.i = 1
    LEFT JOIN walk w ON w.conv = g.conv AND w.done"""


def repeated_windows(width: int) -> str:
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ),
    starts AS (
        SELECT row, doc_id, w, unnest(range(1, len(w) - {width - 2})) AS i FROM docs WHERE len(w) >= {width}
    ),
    found AS (SELECT row, doc_id, i, array_to_string(w[i:i + {width - 1}], ' ') AS words FROM starts),
    firsts AS (SELECT words, min(doc_id) AS first_id FROM found GROUP BY words),
    gone AS (
        SELECT DISTINCT row, unnest(range(i, i + {width})) AS place
        FROM found JOIN firsts USING (words) WHERE first_id < doc_id
    ),
    gone_of AS (SELECT row, list(place) AS places FROM gone GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(CASE WHEN places IS NULL THEN w
               ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)), lambda i: w[i]) END, ' '))
               AS kept_sha256
    FROM docs LEFT JOIN gone_of USING (row)"""
