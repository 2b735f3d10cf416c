"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT source, source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sources
), levels AS (
  SELECT source, source_size, weight, 2.0::DOUBLE * source_size / weight AS fills,
         (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
          - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target
  FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target,
         row_number() OVER (PARTITION BY s.source ORDER BY floor(log2(size + 1) * 4),
             md5(coalesce(doc_id::VARCHAR, '')), doc_id, size) - 1 AS place,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0::DOUBLE END AS rate,
         ('0x' || substr(md5(coalesce(s.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS shift
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (floor((place + 1) * rate + shift) - floor(place * rate + shift))::BIGINT * size AS taken
FROM placed
"""

NEAREST = """
WITH codes AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings WHERE embedding IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id,
         list_sum(list_transform(range(1, len(q.code) + 1), lambda i: (q.code[i] <> c.code[i])::INT))::INT AS distance
  FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS rank FROM pairs
)
SELECT query_id, rank, id, distance FROM ranked WHERE rank <= 10
"""

BACKOFF = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS c, generate_subscripts(ws, 1) AS i FROM texts
), grams AS (
  SELECT doc_id, i, c, lag(c) OVER w AS b, lag(c, 2) OVER w AS a FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), one AS (
  SELECT doc_id, c, count(*) AS own, sum(count(*)) OVER (PARTITION BY c) AS total FROM grams GROUP BY doc_id, c
), two AS (
  SELECT doc_id, b, c, count(*) AS own, sum(count(*)) OVER (PARTITION BY b, c) AS total
  FROM grams WHERE i > 1 GROUP BY doc_id, b, c
), three AS (
  SELECT doc_id, a, b, c, count(*) AS own, sum(count(*)) OVER (PARTITION BY a, b, c) AS total
  FROM grams WHERE i > 2 GROUP BY doc_id, a, b, c
), counts AS (
  SELECT g.doc_id, g.i,
         three.total - three.own AS n3, before3.total - before3.own AS d3,
         two.total - two.own AS n2, before2.total - before2.own AS d2,
         one.total - one.own AS n1, (SELECT count(*) FROM words) - len(t.ws) AS d1,
         CASE WHEN g.i > 2 THEN three.total::DOUBLE / before3.total::DOUBLE
              WHEN g.i > 1 THEN two.total::DOUBLE / before2.total::DOUBLE
              ELSE one.total::DOUBLE / (SELECT count(*) FROM words)::DOUBLE END AS whole
  FROM grams g JOIN texts t ON t.doc_id = g.doc_id
  JOIN one ON one.doc_id = g.doc_id AND one.c = g.c
  LEFT JOIN one before2 ON before2.doc_id = g.doc_id AND before2.c = g.b
  LEFT JOIN two ON two.doc_id = g.doc_id AND two.b = g.b AND two.c = g.c
  LEFT JOIN two before3 ON before3.doc_id = g.doc_id AND before3.b = g.a AND before3.c = g.b
  LEFT JOIN three ON three.doc_id = g.doc_id AND three.a = g.a AND three.b = g.b AND three.c = g.c
), said AS (
  SELECT doc_id, ln(whole) AS whole,
         CASE WHEN i > 2 AND n3 > 0 THEN n3::DOUBLE / greatest(d3, 1)::DOUBLE
              WHEN i > 1 AND n2 > 0 THEN n2::DOUBLE / greatest(d2, 1)::DOUBLE * pow(0.4::DOUBLE, (i > 2)::INT)
              ELSE greatest(n1, 1)::DOUBLE / greatest(d1, 1)::DOUBLE * pow(0.4::DOUBLE, least(i - 1, 2))
         END AS score
  FROM counts
), summed AS (
  SELECT doc_id, sum(round_even(ln(score) * 1000000, 0)::BIGINT)::BIGINT AS micro_nats,
         sum(round_even(whole * 1000000, 0)::BIGINT)::BIGINT AS corpus_micro_nats
  FROM said GROUP BY doc_id
)
SELECT t.doc_id, len(t.ws)::BIGINT AS n_words, coalesce(s.micro_nats, 0)::BIGINT AS micro_nats,
       coalesce(s.corpus_micro_nats, 0)::BIGINT AS corpus_micro_nats
FROM texts t LEFT JOIN summed s ON s.doc_id = t.doc_id
"""

SEARCH = r"""
WITH raw AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), sums AS (
  SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS words FROM raw WHERE len(ws) > 0
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), times AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(ws) AS term FROM raw)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc, term
), weights AS (
  SELECT term, floor(1000::DOUBLE * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM times, sums GROUP BY term, docs
), norms AS (
  SELECT doc, doc_id, (50 + (50 * len(ws) * docs) // words)::BIGINT AS m FROM raw, sums WHERE len(ws) > 0
), scores AS (
  SELECT item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN times USING (term) JOIN weights USING (term) JOIN norms USING (doc)
  GROUP BY item_id, doc, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
         doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

DUPLICATES = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bytes
  FROM documents
), placed AS (
  SELECT doc_id, bytes, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id,
         count(*) OVER (PARTITION BY bytes) AS group_size
  FROM rows WINDOW best AS (PARTITION BY bytes ORDER BY size DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, sha256(bytes) AS text_sha256 FROM placed
"""

ORACLE: dict[str, str] = {
    "op6_nearest_codes": NEAREST,
    "op9_backoff_scores": BACKOFF,
    "op10_mix_sources": MIX,
    "op12_ranked_search": SEARCH,
    "op13_exact_duplicates": DUPLICATES,
}
