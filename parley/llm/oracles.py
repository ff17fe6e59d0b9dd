"""SQL counterparts for DuckDB, where SQL expresses the operator."""

from __future__ import annotations

# The generator of the jump hash needs 128-bit integers; a CRC-32 goes byte by byte through
# the table of its polynomial.
_OP4 = """
WITH RECURSIVE crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h,
    (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616::HUGEINT) % 18446744073709551616::HUGEINT AS k0
  FROM documents
), steps(r, k, b, j) AS (
  SELECT r, k0, 0::BIGINT, 0::BIGINT FROM docs
  UNION ALL
  SELECT r, k2, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT r, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2
        FROM steps WHERE j < 16)
), last AS (
  SELECT r, max_by(b, j) AS shard, CASE WHEN max(j) = 16 THEN 16 ELSE max_by(b, j) END AS grown
  FROM steps GROUP BY r
), rows AS (
  SELECT d.doc_id, (length(d.h) // 2 + 1)::BIGINT AS size,
    xor(4294967295, coalesce(list_reduce(
      list_concat([4294967295::BIGINT],
        list_transform(range(length(d.h) // 2), lambda i: ('0x' || d.h[2 * i + 1 : 2 * i + 2])::BIGINT)),
      lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295))::BIGINT AS text_crc32,
    l.shard::INT AS shard, l.grown::INT AS grown_shard,
    (((d.k0 * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT) >> 54)::INT AS bucket
  FROM docs d JOIN last l USING (r), crc
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM rows
"""


# Components: the smallest id that a walk along the links reaches.
_REACHED = """
reached(node, other) AS (
  SELECT a, b FROM (SELECT a, b FROM links UNION SELECT b, a FROM links)
  UNION
  SELECT r.node, l.b FROM reached r JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) l ON r.other = l.a
)"""

_OP2 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i : i + 3], 'string_agg', ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id
  WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
), {_REACHED}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, r.least) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT node, min(other) AS least FROM reached GROUP BY 1) r ON d.doc_id = r.node
"""

_VALID = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_OP8 = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE {_VALID} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9
), {_REACHED}
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, least(e.vec_id, r.least) AS component_id,
  e.vec_id = least(e.vec_id, r.least) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM (SELECT a FROM links UNION ALL SELECT b FROM links) GROUP BY 1) l ON e.vec_id = l.a
LEFT JOIN (SELECT node, min(other) AS least FROM reached GROUP BY 1) r ON e.vec_id = r.node
"""

_OP9 = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE {_VALID}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = f"unnest(regexp_extract_all(translate(text, {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t"

_OP11 = f"""
WITH queried AS (
  SELECT item_id, t, count(*) AS q FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY 1, 2
), counted AS (
  SELECT r, doc_id, t, count(*) AS tf
  FROM (SELECT r, doc_id, {_TERMS} FROM (SELECT row_number() OVER () AS r, * FROM documents)) GROUP BY 1, 2, 3
), lengths AS (
  SELECT r, sum(tf)::BIGINT AS n FROM counted GROUP BY 1
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
), weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, whole WHERE t IN (SELECT t FROM queried) GROUP BY t, docs
), scored AS (
  SELECT q.item_id, c.r, c.doc_id,
    sum(q.q * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * l.n * docs) // total))))::BIGINT AS score
  FROM queried q JOIN weights w USING (t) JOIN counted c USING (t) JOIN lengths l USING (r), whole
  GROUP BY 1, 2, 3
)
SELECT item_id, (row_number() OVER best)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 AND item_id IS NOT NULL AND doc_id IS NOT NULL
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 10
"""

# Runs by lag: a run has at least five equal words in a row at its period, so only pairs of
# places whose next five words are equal are joined; unbroken rows of them are the stretches.
_OP12 = """
WITH RECURSIVE crc(t) AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(doc_id::VARCHAR)) AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), hashed AS (
  SELECT r, doc_id, w, len(w) AS n, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, x: xor(crc.t[(xor(c, x) & 255) + 1], c >> 8)))::BIGINT AS h
  FROM docs, crc
), seeds AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed
), words AS (
  SELECT r, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM seeds)
), grams AS (
  SELECT r, i, word, CASE WHEN count(*) OVER ahead = 5 THEN list(word) OVER ahead END AS gram
  FROM words WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i
), stretches AS (
  SELECT r, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island
), runs AS (
  SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length
), marks AS (
  SELECT r, i, sum(d) AS d FROM (
    SELECT r, start + period AS i, 1 AS d FROM runs UNION ALL SELECT r, start + length, -1 FROM runs) GROUP BY r, i
), kept AS (
  SELECT r, i, word, coalesce(sum(d) OVER (PARTITION BY r ORDER BY i), 0) AS inside
  FROM words LEFT JOIN marks USING (r, i)
), texts AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM kept WHERE inside = 0 GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t,
    first({'s': start, 'l': length, 'p': period} ORDER BY length DESC, start, period) AS b
  FROM runs GROUP BY r
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.p AS period,
  1000 * b.l // b.p AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(t.t, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l USING (r) LEFT JOIN texts t USING (r)
"""


def oracles() -> dict[str, str]:
    return {
        "op2_parity_sketch_join": _OP2,
        "op4_jump_shards": _OP4,
        "op8_itq_near_vectors": _OP8,
        "op9_dual_tree_top_k": _OP9,
        "op11_dual_tree_lexical": _OP11,
        "op12_scale_minimizers": _OP12,
    }
