"""SQL counterparts of the training-data queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.mixture import DEFAULT, LEVELS, Mixture

#: crc32 of a text of ASCII characters ``{text}``, bit by bit, unsigned.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(0, 8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

_LOWER = "translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item, {_WORDS.format(text="text")} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, array_to_string(list_slice(w, s, s + 9), ' ') AS phrase, least(len(w), 10) AS n
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
gram AS (
    SELECT r, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS phrase
    FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS t(s)),
found AS (SELECT r, s, gram.n, item FROM gram JOIN win USING (phrase)),
hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

PREFIX_TRIE = f"""
WITH told AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
own AS (SELECT *, {_CRC32.format(text="conv_id::VARCHAR")} % 4 AS h FROM told),
built AS (
    SELECT own.conv_id AS c,
        list_concat(coalesce(list_slice(base.turns, 1, own.h), []), list_slice(own.turns, own.h + 1, len(own.turns))) AS t
    FROM own LEFT JOIN told AS base ON base.conv_id = own.conv_id - own.conv_id % 20),
step AS (SELECT c, t, d, list_slice(t, 1, d) AS path FROM built, unnest(range(0, len(t) + 1)) AS x(d)),
node AS (
    SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(t) = d), '')) AS ends_sha256
    FROM step GROUP BY path),
child AS (SELECT path[:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
own_node AS (
    SELECT node.*, coalesce(n, 0) AS n_children,
        CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1)
            * len(regexp_extract_all(node.path[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM node LEFT JOIN child USING (path)),
below AS (
    SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT list_slice(path, 1, d) AS path, n_children, saved FROM own_node, unnest(range(0, depth + 1)) AS x(d))
    GROUP BY path)
SELECT own_node.conv_id, own_node.depth, up.conv_id AS parent_conv_id, own_node.n_convs, own_node.n_children,
    n_leaves, saved_tokens, own_node.ends_sha256
FROM own_node JOIN below USING (path)
LEFT JOIN node AS up ON own_node.depth > 0 AND up.path = own_node.path[:own_node.depth - 1]
"""


def _vector_codes(rounds: int = 4) -> str:
    near = """near{r} AS MATERIALIZED (
    SELECT id, p, best % 256 AS e, best // 256 AS d FROM (
        SELECT id, p, min((list_inner_product(q, q) - 2 * list_inner_product(q, m) + list_inner_product(m, m))::BIGINT
            * 256 + e) AS best FROM part JOIN book{r} USING (p) GROUP BY id, p))"""
    book = """mean{n} AS (
    SELECT p, e, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY i) AS m FROM (
        SELECT p, e, i, sum(q[i]::BIGINT)::BIGINT AS s, count(*) AS n
        FROM near{r} JOIN part USING (id, p), unnest(range(1, len(q) + 1)) AS t(i) GROUP BY p, e, i) GROUP BY p, e),
book{n} AS MATERIALIZED (
    SELECT p, e, coalesce(mean{n}.m, book{r}.m) AS m FROM book{r} LEFT JOIN mean{n} USING (p, e))"""
    steps = []
    for r in range(rounds):
        steps += [near.format(r=r), book.format(r=r, n=r + 1)]
    steps.append(near.format(r=rounds))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
    SELECT id, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS q FROM kept, range(4) AS t(p)),
book0 AS (SELECT p, id - 1 AS e, q AS m FROM part WHERE id <= 256),
{", ".join(steps)},
told AS (
    SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY id),
books AS (
    SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, i, m[i] AS x FROM book{rounds}, unnest(range(1, len(m) + 1)) AS t(i)))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN told USING (id), books
"""


NEAR_VECTORS = """
WITH RECURSIVE told AS (
    SELECT row_number() OVER () AS r, vec_id,
        CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS v
    FROM embeddings),
unit AS (SELECT r, v, sqrt(list_inner_product(v, v)) AS size FROM told WHERE v IS NOT NULL),
link AS (
    SELECT a.r AS a, b.r AS b FROM unit AS a, unit AS b
    WHERE a.r <> b.r AND list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM told UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
component AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN told ON told.r = reach.b GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = told.r) AS n_links, component_id, vec_id = component_id AS kept
FROM told JOIN component USING (r)
"""


def _mixture(mixture: Mixture = DEFAULT) -> str:
    def weight(name: str) -> str:
        cases = " ".join(f"WHEN '{key}' THEN {value}" for key, value in getattr(mixture, name).items())
        return f"(CASE {name} {cases} ELSE {mixture.other} END)::DOUBLE"

    def filled(depth: int) -> str:
        path, parent = LEVELS[: depth + 1], LEVELS[:depth]
        budget = "(SELECT floor(sum(tokens) * {}) FROM leaf)::BIGINT".format(mixture.share) if not depth else "up.given"
        same = " AND ".join(f"up.{p} IS NOT DISTINCT FROM n.{p}" for p in parent)
        above = f"JOIN fill{depth - 1} AS up ON {same}" if depth else ""
        group = f"PARTITION BY {', '.join(parent)}" if parent else ""
        order = f"{group} ORDER BY full_at, {', '.join(f'{p} NULLS FIRST' for p in path)}"
        return f"""node{depth} AS (
    SELECT n.*, {budget} AS budget, CASE WHEN n.weight > 0 THEN n.room / n.weight ELSE 'inf'::DOUBLE END AS full_at
    FROM (SELECT {', '.join(path)}, sum(room)::BIGINT AS room, {weight(path[-1])} AS weight FROM leaf GROUP BY ALL) AS n
    {above}),
level{depth} AS (
    SELECT *, row_number() OVER ({order}) AS nth, sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
        budget - coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS remaining
    FROM node{depth}),
open{depth} AS (
    SELECT *, CASE WHEN rest > 0 THEN remaining / rest ELSE 0 END AS level FROM level{depth}),
fill{depth} AS (
    SELECT *, min(nth) FILTER (level < full_at) OVER ({group}) AS open_nth,
        arg_min(level, nth) FILTER (level < full_at) OVER ({group}) AS open_level,
        CASE WHEN open_nth IS NULL OR nth < open_nth THEN room ELSE floor(open_level * weight)::BIGINT END AS given
    FROM open{depth})"""

    used = " AND ".join(f"{weight(name)} > 0" for name in LEVELS)
    same = " AND ".join(f"doc.{p} IS NOT DISTINCT FROM plan.{p}" for p in LEVELS)
    of_leaf = " AND ".join(f"fill2.{p} IS NOT DISTINCT FROM leaf.{p}" for p in LEVELS)
    return f"""
WITH doc AS (
    SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9])$', 1) IN ('0', '2', '4', '6', '8') THEN 'web' ELSE 'books' END
        AS domain, lang, source,
        greatest(len(regexp_split_to_array(trim(coalesce(text, ''), ' '), '[ \\t-\\r]+')), 1)::BIGINT AS n_tokens
    FROM documents),
leaf AS (
    SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens,
        CASE WHEN {used} THEN sum(n_tokens)::BIGINT * {mixture.epochs} ELSE 0 END AS room
    FROM doc GROUP BY domain, lang, source),
{", ".join(filled(depth) for depth in range(len(LEVELS)))},
plan AS (
    SELECT leaf.domain, leaf.lang, leaf.source, given // tokens AS whole, given % tokens AS part
    FROM fill2 JOIN leaf ON {of_leaf} WHERE given > 0),
used AS (SELECT doc.*, whole, part FROM doc JOIN plan ON {same}),
placed AS (
    SELECT *, ('0x' || substr(md5('{mixture.seed}:' || whole || ':' || doc_id), 1, 10))::BIGINT AS place FROM used WHERE part > 0),
begun AS (
    SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, e::INT AS epoch, n_tokens AS used_tokens
FROM used, unnest(range(0, whole)) AS t(e)
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, whole::INT, least(n_tokens, part - before) FROM begun WHERE before < part
"""


SQL: dict[str, str] = {
    "op2_embedding_lsh": NEAR_VECTORS,
    "op10_mixture": _mixture(),
    "op11_decontamination": DECONTAMINATION,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_vector_codes": _vector_codes(),
}
