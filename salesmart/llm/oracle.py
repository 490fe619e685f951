"""DuckDB SQL of the subpackage's queries that SQL can express, with the same columns."""

from __future__ import annotations

from salesmart.llm.codebooks import ENTRIES, PARTS, ROUNDS, SCALE
from salesmart.llm.licenses import BLOCK, CONTAINMENT, PHRASE_ONLY_SCORE, PHRASES, STEP, TEMPLATES
from salesmart.llm.mixing import MAX_EPOCHS, SEED

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '') || ':{SEED}'), 1, 13))::BIGINT / 4503599627370496.0 AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM docs GROUP BY source),
filling AS (
  SELECT *, source_size * {MAX_EPOCHS}.0 AS cap,
         sum(source_size * {MAX_EPOCHS}.0) OVER o AS caps, sum(w) OVER o AS ws,
         lead(source_size * {MAX_EPOCHS}.0 / w) OVER (ORDER BY source_size / w, source NULLS LAST) AS next_ratio,
         sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
         first_value(source_size * {MAX_EPOCHS}.0 / w) OVER (ORDER BY source_size / w, source NULLS LAST) AS least_ratio
  FROM sources WINDOW o AS (ORDER BY source_size / w, source NULLS LAST)),
level AS (
  SELECT CASE WHEN max(total / all_w) <= max(least_ratio) THEN max(total / all_w)
              ELSE min(CASE WHEN ws < all_w AND (total - caps) / (all_w - ws) <= next_ratio
                            THEN (total - caps) / (all_w - ws) END) END AS words
  FROM filling),
goal AS (
  SELECT source, source_size, w, least(source_size * {MAX_EPOCHS}.0, w * words)::DOUBLE AS target FROM sources, level),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.w, round(g.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM docs d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, {" + ".join(f"greatest(0, least(size, budget - start - {e} * source_size))" for e in range(MAX_EPOCHS))} AS taken,
         CASE WHEN start < budget AND size > 0 THEN start / target END AS u FROM placed)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       round(CASE w WHEN 1 THEN 1.5 - sqrt(2.25 - 2 * u) WHEN 2 THEN u ELSE sqrt(0.25 + 2 * u) - 0.5 END, 6) AS first_position
FROM taken
"""


def _place_sql(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
    return f"list_filter(range(0, greatest(len(w) - {len(words) - 1}, 0)), lambda i: {test})"


def _op6() -> str:
    bases = ", ".join(f"{_place_sql(p)} AS p{i}" for i, p in enumerate(PHRASES))
    every = "flatten([" + ", ".join(f"p{i}" for i in range(len(PHRASES))) + "])"
    labels = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(PHRASES.values()))
    templates = ", ".join(
        f"('{label}', [{', '.join(repr(x) for x in sorted(set(notice.split())))}])" for notice, label in TEMPLATES.items()
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
base AS (SELECT r, doc_id, w, {bases} FROM docs),
templates(label, tokens) AS (VALUES {templates}),
blocks AS (
  SELECT DISTINCT r, unnest(list_transform(range(0, greatest(len(w) - {STEP}, 1), {STEP}),
                                           lambda i: list_distinct(w[i + 1 : i + {BLOCK}]))) AS t
  FROM docs),
matches AS (
  SELECT r, label, len(list_intersect(t, tokens)) / len(tokens) AS containment
  FROM blocks, templates WHERE len(list_intersect(t, tokens)) >= ceil({CONTAINMENT} * len(tokens) - 1e-9)),
more AS (SELECT r, list(DISTINCT label) AS labels, max(containment) AS best FROM matches GROUP BY r),
named AS (SELECT base.*, {every} AS p, list_sort(list_distinct(list_filter([{labels}], lambda x: x IS NOT NULL))) AS b FROM base)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word,
       list_max(p)::BIGINT AS last_word, array_to_string(b, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(b, coalesce(labels, [])))), ',') AS labels,
       greatest(coalesce(best, 0.0), CASE WHEN len(p) > 0 THEN {PHRASE_ONLY_SCORE} ELSE 0.0 END)::DOUBLE AS score
FROM named LEFT JOIN more USING (r)
"""


OP10 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, ''))::BIGINT AS n
  FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""

def _op11(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """Plain Lloyd rounds, one full scan each; vectors of one length, ids once each."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT r, p, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS m
  FROM parts JOIN c{t} USING (p) GROUP BY r, p)""")
        if t < rounds:
            steps.append(f"""
u{t} AS (
  SELECT p, e, list(s ORDER BY i) AS n FROM (
    SELECT p, m.e AS e, i, ((sum(x[i]) - (((sum(x[i]) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS s
    FROM a{t} JOIN parts USING (r, p), places GROUP BY p, m.e, i) GROUP BY p, e),
c{t+1} AS MATERIALIZED (SELECT p, e, coalesce(n, c) AS c FROM c{t} LEFT JOIN u{t} USING (p, e))""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS p)),
places AS (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries}),{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


ORACLE = {"op1_mixing": OP1, "op6_licenses": _op6(), "op10_warc": OP10, "op11_codes": _op11()}
