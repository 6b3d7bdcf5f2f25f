"""DuckDB twin of the Merkle manifest: levels by recursion over plain runs of 16 nodes."""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


_ABOUT = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Every byte as a list of steps: the byte to add, then eight shifts (-1), each with the polynomial where a bit falls out.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: list_prepend(ascii(c)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
        lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)
            WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END), 4294967295)"""

SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, sha256({_ABOUT} || {_field("text")}) AS leaf,
        CASE WHEN {_CRC} % 5 = 0 THEN sha256({_ABOUT} || {_field(_LOWER)}) END AS tampered
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS digest, n FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n
), below AS MATERIALIZED (SELECT * FROM nodes
), subroots AS MATERIALIZED (
    SELECT tree, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
    FROM below WHERE n = 1
), tops AS (
    SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16
    FROM tops WHERE n > 1 GROUP BY level, pos // 16, n
), above AS MATERIALIZED (SELECT * FROM tops
), tree_nodes AS MATERIALIZED (
    SELECT tree, level, pos, digest FROM below WHERE n > 1
    UNION ALL
    SELECT s.tree, s.height + a.level, a.pos, a.digest FROM subroots s JOIN above a ON a.n > 1
), climb AS (
    SELECT p.tree, p.pos AS leaf_pos, 0 AS level, CASE WHEN s.height = 0 THEN s.pos ELSE p.pos END AS pos, s.height, s.pos AS top, p.leaf, coalesce(p.tampered, p.leaf) AS folded, '' AS proof, p.doc_id
    FROM placed p JOIN subroots s USING (tree)
    UNION ALL
    SELECT c.tree, c.leaf_pos, c.level + 1, CASE WHEN c.level + 1 = c.height THEN c.top ELSE c.pos // 16 END, c.height, c.top, c.leaf,
        sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.folded ELSE t.digest END, '' ORDER BY t.pos)),
        c.proof || coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos <> c.pos), ''), c.doc_id
    FROM climb c JOIN tree_nodes t ON t.tree = c.tree AND t.level = c.level AND t.pos // 16 = c.pos // 16
    GROUP BY c.tree, c.leaf_pos, c.level, c.pos, c.height, c.top, c.leaf, c.folded, c.proof, c.doc_id
), climbed AS (
    SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, leaf_pos ORDER BY level DESC) = 1
)
SELECT c.doc_id, c.leaf, s.subroot, r.root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.root AS verified
FROM climbed c JOIN subroots s USING (tree), (SELECT digest AS root FROM above WHERE n = 1) r
"""
