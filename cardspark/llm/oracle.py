"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, hash(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
hit AS (
  SELECT doc_id, i FROM windows
  JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM hit),
gone_list AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN g IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone_list USING (doc_id)
"""

FOLDED = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

OP5 = rf"""
WITH d AS (SELECT doc_id, {FOLDED} AS w FROM documents),
b AS (SELECT item_id, {FOLDED} AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s, least(len(w), 5) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) >= 1)
),
bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s, least(len(w), 5) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM b WHERE len(w) >= 1)
),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_found
FROM ds JOIN bs USING (s, k) JOIN n USING (item_id) GROUP BY doc_id, item_id
HAVING 100 * count(*) >= 80 * any_value(n_shingles)
"""

OP6 = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size, md5(doc_id::VARCHAR) AS key FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
),
weighted AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(rank - 1) % 3 + 1] AS weight FROM per),
budget AS (SELECT 1.5::DOUBLE * sum(source_size) AS t, sum(weight) AS w FROM weighted),
stops AS (
  SELECT (t - sum(2 * source_size) OVER o) / nullif(w - sum(weight) OVER o, 0) AS rate,
    lead(2 * source_size / weight) OVER (ORDER BY 2 * source_size / weight, rank) AS next_ratio,
    2 * source_size / weight AS ratio, rank
  FROM weighted, budget WINDOW o AS (ORDER BY 2 * source_size / weight, rank ROWS UNBOUNDED PRECEDING)
),
rate AS (
  SELECT CASE WHEN t / w <= (SELECT min(2 * source_size / weight) FROM weighted) THEN t / w
    ELSE (SELECT rate FROM stops WHERE rate <= next_ratio ORDER BY ratio, rank LIMIT 1) END AS rate FROM budget
),
plan AS (
  SELECT source, source_size, rank,
    CASE WHEN weight * rate > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE weight * rate END AS target
  FROM weighted, rate
),
queue AS (
  SELECT d.doc_id, d.size, d.key, p.source_size, p.rank, p.target, c,
    (sum(size) OVER (PARTITION BY p.rank ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING)) AS emitted
  FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source, (SELECT unnest([0, 1]) AS c) AS copies
  WHERE c = 0
),
copies AS (
  SELECT doc_id, size, source_size, target, rank, key, c,
    CASE WHEN target > 0 THEN (emitted + source_size * c) / target ELSE 0 END AS finish
  FROM (SELECT * EXCLUDE (c), unnest([0, 1]) AS c FROM queue)
),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, key, doc_id ROWS UNBOUNDED PRECEDING) AS total FROM copies
)
SELECT doc_id, size, source_size, target, sum(CASE WHEN total <= t THEN size ELSE 0 END)::BIGINT AS taken
FROM summed, budget GROUP BY doc_id, size, source_size, target
"""

OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) >= 1)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id
    GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * same >= 85 * (na.n + nb.n - same)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) USING (doc_id)
"""

# the same lanes as in `fingerprints`: pieces, four halves of 30 bits, 120 bit counts
OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
      first(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), first(doc_id) OVER (ORDER BY doc_id DESC)) AS next_id
  FROM documents
),
e AS (
  SELECT *, length(text) AS n,
    substr(text, 1, length(text) - length(text) // 3) || substr(next, 1, length(text) // 3) AS edited FROM d
),
p AS (
  SELECT doc_id, which, md5(piece) AS h FROM (
    SELECT doc_id, 0 AS which, unnest(regexp_extract_all(text, '[^\n.!?]{1,160}[\n.!?]*|[\n.!?]+')) AS piece FROM e
    UNION ALL
    SELECT doc_id, 1, unnest(regexp_extract_all(edited, '[^\n.!?]{1,160}[\n.!?]*|[\n.!?]+')) FROM e)
),
b AS (
  SELECT doc_id, which, ('0x' || substr(h, 1, 15))::BIGINT AS a, ('0x' || substr(h, 16, 15))::BIGINT AS b FROM p
),
halves AS (
  SELECT doc_id, which, count(*) AS n,
    printf('%08x%08x%08x%08x%08x', (count(*) % 4294967296)::BIGINT, (sum(a >> 30) % 4294967296)::BIGINT,
      (sum(a & 1073741823) % 4294967296)::BIGINT, (sum(b >> 30) % 4294967296)::BIGINT,
      (sum(b & 1073741823) % 4294967296)::BIGINT) AS wide
  FROM b GROUP BY doc_id, which
),
bits AS (
  SELECT doc_id, which, j, sum((a >> j) & 1)::BIGINT AS a, sum((b >> j) & 1)::BIGINT AS b
  FROM b, (SELECT unnest(range(60)) AS j) AS lanes GROUP BY doc_id, which, j
),
counts AS (
  SELECT doc_id, which, list(a ORDER BY j) AS a, list(b ORDER BY j) AS b FROM bits GROUP BY doc_id, which
),
v AS (
  SELECT k.doc_id, k.which, coalesce(n, 0) AS n,
    coalesce(wide, repeat('0', 40)) AS wide,
    list_concat(coalesce(a, list_transform(range(60), lambda x: 0)), coalesce(b, list_transform(range(60), lambda x: 0)))
      AS c
  FROM (SELECT doc_id, unnest([0, 1]) AS which FROM documents) AS k
  LEFT JOIN halves USING (doc_id, which) LEFT JOIN counts USING (doc_id, which)
),
f AS (
  SELECT doc_id, which, n, c, wide || array_to_string(list_transform(range(60), lambda i: printf('%04x%04x',
      c[(i // 30) * 60 + i % 30 + 31] % 65536, c[(i // 30) * 60 + i % 30 + 1] % 65536)), '') AS print,
    list_sum(list_transform(c, lambda x: (2 * x - n) * (2 * x - n))) AS norm
  FROM v
),
pairs AS (
  SELECT x.doc_id, x.print, y.print AS edited_print,
    list_sum(list_transform(range(1, 121), lambda i:
      (2 * (x.c[i] - y.c[i]) - (x.n - y.n)) * (2 * (x.c[i] - y.c[i]) - (x.n - y.n)))) AS apart_edited,
    list_sum(list_transform(range(1, 121), lambda i:
      (2 * (x.c[i] - z.c[i]) - (x.n - z.n)) * (2 * (x.c[i] - z.c[i]) - (x.n - z.n)))) AS apart_next,
    x.norm + y.norm AS both_edited, x.norm + z.norm AS both_next
  FROM f x JOIN e ON e.doc_id = x.doc_id AND x.which = 0
  JOIN f y ON y.doc_id = x.doc_id AND y.which = 1 JOIN f z ON z.doc_id = e.next_id AND z.which = 0
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, print AS fingerprint, edited_print AS edited_fingerprint,
  CASE WHEN both_edited = 0 THEN 1.0::DOUBLE
    ELSE greatest(0.0, least(1.0, 1 - apart_edited / both_edited))::DOUBLE END AS near_edited,
  CASE WHEN both_next = 0 THEN 1.0::DOUBLE
    ELSE greatest(0.0, least(1.0, 1 - apart_next / both_next))::DOUBLE END AS near_next
FROM pairs JOIN e USING (doc_id)
"""

OP9 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (
  SELECT doc_id, i, hash(substr(x, 2 * i - 1, 100)) AS h
  FROM (SELECT doc_id, x, unnest(range(1, length(x) // 2 - 48)) AS i FROM d WHERE length(x) >= 100)
),
hit AS (
  SELECT doc_id, i FROM strings JOIN (SELECT h, min(doc_id) AS first FROM strings GROUP BY h) USING (h)
  WHERE first < doc_id
),
marked AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
numbered AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS span
  FROM marked
),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte FROM spans
),
per AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
    list({'a': a, 'f': from_byte} ORDER BY a) AS g
  FROM gaps GROUP BY doc_id
)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN g IS NULL THEN x
    ELSE coalesce(array_to_string(list_transform(g, lambda p: substr(x, 2 * p.f - 1, 2 * (p.a - p.f))), ''), '')
      || substr(x, 2 * tail - 1) END)) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""

def _codebook_round(before: str, after: str, book: str) -> str:
    """SQL of one assignment (ties: lower entry) from codebook `before`; `book` names the next codebook."""
    return f"""
{after} AS (
  SELECT rid, part, arg_min(entry, d * 65536 + entry) AS entry, min(d) AS d
  FROM (SELECT c.rid, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d
        FROM comp c JOIN {before} b USING (part, pos) GROUP BY ALL)
  GROUP BY rid, part
)""" + ("" if book is None else f""",
{book} AS (
  SELECT b.part, b.entry, b.pos, coalesce(n.x, b.x) AS x FROM {before} b LEFT JOIN (
    SELECT a.part, a.entry, c.pos, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
    FROM {after} a JOIN comp c USING (rid, part) GROUP BY ALL) n USING (part, entry, pos)
)""")


OP11 = rf"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
comp AS (
  SELECT rid, (i - 1) // (len(e) // 16) AS part, (i - 1) % (len(e) // 16) AS pos, floor(e[i]::DOUBLE * 256)::BIGINT AS x
  FROM (SELECT rid, e, unnest(range(1, len(e) + 1)) AS i FROM kept)
),
b0 AS (SELECT part, rid - 1 AS entry, pos, x FROM comp WHERE rid <= 64),
{_codebook_round("b0", "a1", "b1")},
{_codebook_round("b1", "a2", "b2")},
{_codebook_round("b2", "a3", None)},
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', a.entry), '' ORDER BY a.part) AS code, sum(a.d)::BIGINT AS error
  FROM a3 a JOIN kept k USING (rid) GROUP BY k.rid, k.vec_id, k.label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256
FROM coded
"""

def _audit_orders() -> str:
    from cardspark.llm.filter_audit import orders

    return ", ".join(f"('{o}', {s}, '{x}', {b}, {a})" for o, s, x, b, a in orders())


OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
m AS (
  SELECT doc_id, part,
    (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id IS NOT DISTINCT FROM first_id THEN 0 ELSE 16 END) AS f
  FROM w
),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
          max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
sv AS (
  SELECT part, s, count(*) FILTER (WHERE f & s = 0) AS n_all,
    count(*) FILTER (WHERE f & s = 0 AND good = 1) AS n_good, count(*) FILTER (WHERE f & s = 0 AND toxic = 1) AS n_toxic
  FROM m LEFT JOIN lab USING (doc_id) CROSS JOIN range(32) r(s) GROUP BY part, s
),
o(filter_order, step, letter, before, after) AS (VALUES {_audit_orders()}),
r AS (
  SELECT b.part, o.filter_order, o.step, o.letter, a.n_all AS kept, b.n_all - a.n_all AS removed,
    z.n_all - x.n_all - (b.n_all - a.n_all) AS redundant, u.n_all - f.n_all AS unique_fails,
    b.n_good - a.n_good AS good_lost, b.n_toxic - a.n_toxic AS toxic_lost
  FROM o JOIN sv b ON b.s = o.before
  JOIN sv a ON a.part = b.part AND a.s = o.after
  JOIN sv z ON z.part = b.part AND z.s = 0
  JOIN sv x ON x.part = b.part AND x.s = o.after - o.before
  JOIN sv u ON u.part = b.part AND u.s = 31 - (o.after - o.before)
  JOIN sv f ON f.part = b.part AND f.s = 31
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM r
"""

ORACLES = {
    "op3_substring_dedup": OP3,
    "op5_benchmark_decontamination": OP5,
    "op6_source_mixing": OP6,
    "op7_minhash_near_dedup": OP7,
    "op8_document_fingerprints": OP8,
    "op9_suffix_array_dedup": OP9,
    "op11_vector_codes": OP11,
    "op12_filter_audit": OP12,
}
