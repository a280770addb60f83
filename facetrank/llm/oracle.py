"""SQL of the queries that SQL can express, for the tables as views."""

from __future__ import annotations

from facetrank.llm.common import UPPER
from facetrank.llm.mixing import SEED, TEMPERATURE


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}')"


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL = {
    "op2_mix": f"""
WITH sized AS (
  SELECT source, sum(greatest(1, coalesce(length(text), 0))) AS size FROM documents GROUP BY source
), weighted AS (SELECT *, pow(size, {TEMPERATURE}) AS weight FROM sized),
rated AS (
  SELECT source, sum(size) OVER () * weight / sum(weight) OVER () / size AS rate FROM weighted
), terms AS (
  SELECT source, rate, k,
         -rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate / greatest(k, 1)) END)
           OVER (PARTITION BY source ORDER BY k) AS log_term
  FROM rated, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS t(k)
), below AS (
  SELECT source, k, sum(exp(log_term)) OVER (PARTITION BY source ORDER BY k) AS p FROM terms
), drawn AS (
  SELECT *, (('0x' || substr(md5('{SEED}/count/' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE)
            / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), counted AS (
  SELECT doc_id, count(*) AS n FROM drawn JOIN below USING (source) WHERE p < draw GROUP BY doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INTEGER AS copy,
       md5('{SEED}/order/' || d.doc_id || '/' || c.copy) AS shuffle_key
FROM documents d JOIN counted USING (doc_id), unnest(range(1, n + 1)) AS c(copy)
""",
    "op4_decontaminate": f"""
WITH own AS (
  SELECT doc_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS words FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, words[s : s + 12] AS win
  FROM items, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS t(s) WHERE len(words) > 0
), lens AS (SELECT DISTINCT len(win) AS n FROM wins),
places AS (
  SELECT doc_id, s, n, words[s : s + n - 1] AS win
  FROM own, lens, unnest(range(1, len(words) - n + 2)) AS t(s)
), hit AS (SELECT doc_id, s, n, item_id FROM places JOIN wins USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM own LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op10_exact_dedup": f"""
WITH normal AS (SELECT doc_id, {_lower("text")} AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM normal JOIN groups USING (t)
""",
}
