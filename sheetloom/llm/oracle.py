"""SQL for the queries of Merkle manifests, hard negatives and substring dedup."""

from __future__ import annotations


def _sized(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_sized, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _above(leaves: str) -> str:
    """All nodes of the trees of some leaves, as the body of a recursive table (tree, n, level, pos, digest)."""
    return f"""
            SELECT tree, n, 0 AS level, pos, digest FROM {leaves}
            UNION ALL
            SELECT tree, (n + 7) // 8, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
            FROM {{0}} WHERE n > 1 GROUP BY tree, n, level, pos // 8"""


def _led(start: str, nodes: str, name: str) -> str:
    """Leaves led up to the root of their tree, with the siblings on the way (key, tree, level, pos, node, siblings, done)."""
    return f"""
            SELECT key, tree, 0 AS level, pos, node, siblings FROM {start}
            UNION ALL
            SELECT f.key, f.tree, f.level + 1, f.pos // 8,
                   sha256(string_agg(CASE WHEN x.pos = f.pos THEN f.node ELSE x.digest END, '' ORDER BY x.pos)),
                   f.siblings || coalesce(string_agg(CASE WHEN x.pos <> f.pos THEN x.digest END, '' ORDER BY x.pos), '')
            FROM {name} f JOIN {nodes} x ON x.tree = f.tree AND x.level = f.level AND x.pos // 8 = f.pos // 8
            WHERE x.n > 1 GROUP BY f.key, f.tree, f.level, f.pos, f.node, f.siblings"""


MERKLE = f"""
        WITH RECURSIVE crc AS (  -- CRC-32 of the decimal id, bit by bit
            SELECT DISTINCT doc_id, doc_id::VARCHAR AS digits, 0 AS step, 4294967295::BIGINT AS value FROM documents WHERE doc_id IS NOT NULL
            UNION ALL
            SELECT doc_id, digits, step + 1, xor(fed >> 1, (fed & 1) * 3988292384)
            FROM (SELECT *, CASE WHEN step % 8 = 0 THEN xor(value, ascii(substr(digits, step // 8 + 1, 1))) ELSE value END AS fed FROM crc)
            WHERE step < 8 * length(digits)),
        picked AS (SELECT doc_id FROM crc WHERE step = 8 * length(digits) AND xor(value, 4294967295) % 3 = 0),
        hashed AS (
            SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf('text')} AS digest,
                   CASE WHEN doc_id IN (SELECT doc_id FROM picked) THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS held
            FROM documents),
        leaves AS (
            SELECT *, row_number() OVER () AS key, count(*) OVER (PARTITION BY tree) AS n,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos
            FROM hashed),
        nodes AS ({_above('leaves').format('nodes')}),
        subroots AS (
            SELECT '2' AS tree, tree AS name, digest, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
        tops AS ({_above('subroots').format('tops')}),
        low_start AS (SELECT key, tree, pos, held AS node, '' AS siblings FROM leaves),
        low_led AS ({_led('low_start', 'nodes', 'low_led')}),
        low_end AS (SELECT key, tree, node, siblings FROM low_led QUALIFY row_number() OVER (PARTITION BY key ORDER BY level DESC) = 1),
        top_start AS (SELECT e.key, s.tree, s.pos, e.node, e.siblings FROM low_end e JOIN subroots s ON s.name = e.tree),
        top_led AS ({_led('top_start', 'tops', 'top_led')}),
        top_end AS (SELECT key, node, siblings FROM top_led QUALIFY row_number() OVER (PARTITION BY key ORDER BY level DESC) = 1)
        SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(t.siblings) AS proof_sha256,
               t.node AS folded_root, t.node = r.digest AS verified
        FROM leaves l JOIN top_end t USING (key) JOIN subroots s ON s.name = l.tree JOIN (SELECT digest FROM tops WHERE n = 1) r ON true
    """

NEGATIVES = """
        WITH held AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS whole
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        numbered AS (SELECT *, row_number() OVER () AS key FROM held),
        long AS (SELECT key, unnest(whole) AS x, generate_subscripts(whole, 1) AS place FROM numbered),
        sums AS (
            SELECT a.key AS one, b.key AS two, sum(a.x * b.x)::BIGINT AS score
            FROM long a JOIN numbered n ON n.key = a.key AND n.vec_id % 100 = 0 JOIN long b ON a.place = b.place GROUP BY ALL),
        scored AS (
            SELECT a.key AS anchor, a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, coalesce(s.score, 0) AS score
            FROM numbered a JOIN numbered r ON r.key <> a.key LEFT JOIN sums s ON s.one = a.key AND s.two = r.key
            WHERE a.vec_id % 100 = 0),
        kin AS (
            SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
        paired AS (
            SELECT k.anchor_id, k.vec_id AS positive_id, n.vec_id AS negative_id, k.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY k.anchor, k.vec_id, k.score ORDER BY n.score DESC, n.vec_id)::INT AS rank
            FROM kin k JOIN scored n ON n.anchor = k.anchor AND NOT n.same
            WHERE 80 * k.score <= 100 * n.score AND n.score <= k.score)
        SELECT * FROM paired WHERE rank <= 5
    """

SUBSTRINGS = r"""
        WITH split AS (
            SELECT row_number() OVER (ORDER BY doc_id) AS key, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        windows AS (
            SELECT key, unnest(range(1, len(words) - 18)) AS start, words FROM split WHERE len(words) >= 20),
        hashed AS (SELECT key, start, array_to_string(words[start:start + 19], ' ') AS body FROM windows),
        later AS (SELECT key, start FROM hashed QUALIFY row_number() OVER (PARTITION BY body ORDER BY key, start) > 1),
        gone AS (SELECT DISTINCT key, unnest(range(start, start + 20)) AS place FROM later),
        marked AS (
            SELECT w.key, w.place, w.word, g.place IS NOT NULL AS removed
            FROM (SELECT key, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split) w
            LEFT JOIN gone g ON g.key = w.key AND g.place = w.place),
        rest AS (
            SELECT key, count(*) FILTER (removed) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT removed) AS kept FROM marked GROUP BY key)
        SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(r.n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(r.kept, '')) AS kept_sha256
        FROM split s LEFT JOIN rest r USING (key)
    """
