"""DuckDB SQL of the queries that SQL can express (not 8 and 9)."""

from __future__ import annotations

BLANK = r"[\x20\x09-\x0D]+"
WORDS = rf"list_filter(string_split_regex(coalesce(text, ''), '{BLANK}'), lambda w: w <> '')"

OP1 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BLANK}'),
    lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON s.doc_id = m.x
"""

OP2 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _op3() -> str:
    from . import quality as q
    sizes = sorted({q.WINDOW, *q.MAX_DUP_PCT})
    grams = ",\n".join(f"""g{k} AS (SELECT doc_id, i, CASE WHEN i + {k - 1} <= n
      THEN (count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+{k - 1}], ' '), i + {k - 1} <= n)) > 1
      ELSE false END AS d FROM p),
    c{k} AS (SELECT doc_id, i, bool_or(d) OVER (PARTITION BY doc_id ORDER BY i
      ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS c FROM g{k}),
    x{k} AS (SELECT c.doc_id, count(*) AS words, sum(length(p.w[p.i])) AS chars FROM c{k} c JOIN p
      ON c.doc_id = p.doc_id AND c.i = p.i WHERE c.c GROUP BY c.doc_id)""" for k in sizes)
    joins = " ".join(f"LEFT JOIN x{k} ON b.doc_id = x{k}.doc_id" for k in sizes)
    bounds = " AND ".join(f"100 * coalesce(x{k}.chars, 0) <= {m} * b.word_chars" for k, m in q.MAX_DUP_PCT.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM d),
{grams},
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) > 1 AS later FROM l
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
y AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (later) AS dup, coalesce(sum(list_sum(list_transform(
    list_filter(string_split_regex(l, '{BLANK}'), lambda w: w <> ''), lambda w: length(w)))) FILTER (later), 0) AS chars
  FROM m GROUP BY doc_id),
b AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM d),
f AS (SELECT b.*, coalesce(y.dup, 0)::BIGINT AS n_dup_lines, coalesce(x{q.WINDOW}.words, 0)::BIGINT AS n_repeat_words,
  ({bounds} AND 100 * coalesce(y.chars, 0) <= {q.MAX_LINE_CHAR_PCT} * b.word_chars
   AND 100 * coalesce(y.dup, 0) <= {q.MAX_LINE_PCT} * coalesce(y.lines, 0)) AS fine
  FROM b LEFT JOIN y ON b.doc_id = y.doc_id {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words) AS base_failed,
  (NOT (n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words) AND fine) AS kept FROM f
"""


def _op4() -> str:
    from .queries import SHARDS
    from .sharding import SLOT_ROWS
    # 24 shards: shard r + 2 * (k + 3 * j) is the j-th of rack k in region r; the 25th is region 2.
    # Among equal weights the least exponential draw is the largest hash number.
    number = lambda name: f"('0x' || substr(md5(doc_id || ':' || {name}), 1, 13))::BIGINT"
    region = lambda r, w: f"-ln(({number(r)} + 1) / 4503599627370496::DOUBLE) / {w}"
    most = lambda n, name: (f"-(list_sort(list_transform(range({n}), lambda i: "  # noqa: E731
                            f"{{'h': {number(name)}, 'i': -i}}), 'DESC')[1].i)")
    half = SHARDS // 2
    return f"""
WITH t AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS text_crc32,
  {region("'0'", half)} AS r0, {region("'1'", half)} AS r1, {region("'2'", 1)} AS r2, CASE WHEN r0 <= r1 THEN 0 ELSE 1 END AS r,
  ('0x' || substr(md5(doc_id || ':slot'), 1, 8))::BIGINT % (SELECT greatest(1,
    ceil(count(*) / {SLOT_ROWS * SHARDS}.0))::BIGINT FROM documents) AS bucket FROM documents, t),
k AS (SELECT *, {most(3, "r || '/' || i")} AS k FROM d),
s AS (SELECT *, (r + 2 * (k + 3 * ({most(SHARDS // 6, "r || '/' || k || '/' || (r + 2 * (k + 3 * i))")})))::INTEGER AS shard FROM k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot,
  CASE WHEN r2 < least(r0, r1) THEN {SHARDS} ELSE shard END::INTEGER AS grown_shard FROM s
"""


def _op5() -> str:
    from .suffix_dedup import LENGTH as n
    return rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i+{n - 1}], ' ') AS g FROM p WHERE i + {n - 1} <= n),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY g) > 1 AS several,
  row_number() OVER (PARTITION BY g ORDER BY doc_id, i) = 1 AS first FROM g),
m AS (SELECT p.doc_id, p.i, coalesce(several AND first, false) AS a, coalesce(several AND NOT first, false) AS b
  FROM p LEFT JOIN f ON p.doc_id = f.doc_id AND p.i = f.i),
c AS (SELECT doc_id, i, bool_or(a) OVER w AS keep, bool_or(b) OVER w AS cut FROM m
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)),
s AS (SELECT doc_id, i, keep AS kept FROM c WHERE keep OR cut),
r AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, kept ORDER BY i) AS run FROM s)
SELECT doc_id, min(i) - 1 AS start_word, count(*) AS n_words, kept FROM r GROUP BY doc_id, kept, run
"""


OP6 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to FROM f
"""

_MARKED = "<|im_end|><|im_start|>assistant ok"
OP7 = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{_MARKED}'), (-1, 1, 'assistant', '{_MARKED}')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
  length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n,
  length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS r FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN before IS NULL THEN 13 + r WHEN before = role THEN 10 ELSE 24 + r END)::BIGINT + 11 AS formatted_chars
FROM e GROUP BY conv_id
"""


def _op10() -> str:
    from .mixing import EPOCHS, SEED, WEIGHTS
    weights = "[" + ", ".join(f"{float(w)}::DOUBLE" for w in WEIGHTS) + "]"
    return rf"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 13))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::BIGINT] AS w,
  source_size * {float(EPOCHS)}::DOUBLE AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT source, source_size, least(cap, coalesce((SELECT min_by(level, cap / w) FROM l WHERE level * w <= cap) * w, cap)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM g),
o AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS part,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN size > 0 AND before + size / 2.0 <= part THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
"""


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"""
_TABLE = """t AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def _op11() -> str:
    from .pq_dedup import COSINE
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT m.x AS vec_id, coalesce(l.n, 0)::BIGINT AS n_links, m.c AS component_id, m.x = m.c AS kept
FROM (SELECT x, min(y) AS c FROM r GROUP BY x) m LEFT JOIN (SELECT x, count(*) AS n FROM p GROUP BY x) l ON m.x = l.x
"""


OP12 = f"""
WITH {_TABLE},
i AS (SELECT conv_id, turn, strlen(x) AS size, substr(sha256(strlen(r) || ':' || r || x), 1, 32) AS id FROM (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS i FROM i),
c AS (SELECT conv_id, {_CRC.format("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM i), t),
n AS (SELECT c.conv_id, 0 AS part, o.i, id, size FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.i <= c.h
  UNION ALL SELECT c.conv_id, 1, o.i, id, size FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
k AS (SELECT conv_id, row_number() OVER w AS d, size, string_agg(id, '') OVER w AS path FROM n
    WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
e AS (SELECT conv_id, max(d) AS last FROM k GROUP BY conv_id),
m AS (SELECT path, d, min(k.conv_id) AS conv_id, count(*) AS n, max(size) AS size,
    string_agg(k.conv_id::VARCHAR, ',' ORDER BY k.conv_id) FILTER (e.last = k.d) AS ends
  FROM k JOIN e ON k.conv_id = e.conv_id GROUP BY path, d),
b AS (SELECT substr(path, 1, 32 * (d - 1)) AS path, count(*) AS kids FROM m WHERE d > 0 GROUP BY ALL),
f AS (SELECT m.*, coalesce(kids, 0) AS kids FROM m LEFT JOIN b ON m.path = b.path),
s AS (SELECT substr(path, 1, 32 * j) AS path, sum((kids = 0)::INTEGER) AS leaves, sum((n - 1) * size) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM f) GROUP BY ALL)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM f JOIN s ON f.path = s.path LEFT JOIN m u ON f.d > 0 AND u.path = substr(f.path, 1, 32 * (f.d - 1))
"""


def _op13() -> str:
    from .runs import MIN_WORDS
    # Equal runs of words show as equal 4-grams q words apart, in a row.
    return rf"""
WITH {_TABLE},
a AS (SELECT doc_id, {WORDS} AS w, {_CRC.format("doc_id::VARCHAR")} AS h FROM documents, t),
b AS (SELECT doc_id, w, len(w) AS n, h, (h // 10) AS g FROM a),
c AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS s, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM b),
d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: CASE WHEN i < s THEN w[i + 1] ELSE w[s + (i - s) % p + 1] END) ELSE w END AS w FROM c),
i AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word,
  unnest(list_transform(range(n), lambda i: CASE WHEN i + 4 <= n THEN array_to_string(w[i + 1:i + 4], ' ') END)) AS gram FROM d),
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM i x JOIN i y ON x.doc_id = y.doc_id AND x.gram = y.gram
  AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
f AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
r AS (SELECT doc_id, s, l, min(q) AS q FROM (SELECT doc_id, q, min(i) AS s, count(*) + 3 + q AS l FROM f GROUP BY doc_id, q, island)
  WHERE l >= greatest({MIN_WORDS}, 2 * q) GROUP BY doc_id, s, l),
o AS (SELECT doc_id, count(*) AS n_runs, max_by(struct_pack(s := s, l := l, q := q), [l, -s, -q]) AS best,
  string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY doc_id),
k AS (SELECT i.doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM i WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.doc_id = i.doc_id AND i.i >= r.s + r.q AND i.i < r.s + r.l) GROUP BY i.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS "start", best.l AS length, best.q AS period,
  (1000 * best.l) // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN o ON d.doc_id = o.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": OP1, "op2_topk": OP2, "op3_quality": _op3(), "op4_sharding": _op4(),
            "op5_repeats": _op5(), "op6_warc": OP6, "op7_chat": OP7, "op10_mixing": _op10(),
            "op11_near_vectors": _op11(), "op12_prefix_trie": OP12, "op13_periodic_runs": _op13()}
