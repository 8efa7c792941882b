"""Query 8: measures and verdicts of every document."""

from pyspark.sql import DataFrame, SparkSession

from sparkq.llm.quality import judge
from sparkq.llm.registry import query
from sparkq.sources.views import read

ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM words)
), twice AS (
  SELECT doc_id, p FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
), measures AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), failures AS (
  SELECT host, r.rule, r.fails
  FROM (SELECT host, unnest([
          {'rule': 'short', 'fails': n_words < 50},
          {'rule': 'repetitive', 'fails': 100 * n_repeat_words > 50 * n_words},
          {'rule': 'symbols', 'fails': 100 * n_symbols > 10 * word_chars},
          {'rule': 'lines', 'fails': 100 * n_dup_lines > 50 * n_lines}]) AS r
        FROM measures)
), hosts AS (
  SELECT host, rule, count(*) AS n, count(*) FILTER (fails) AS f FROM failures GROUP BY host, rule
), means AS (
  SELECT rule, sum(n) AS n, count(*) AS k, sum(f) / sum(n) AS m FROM hosts GROUP BY rule
), spreads AS (
  SELECT h.rule, sum(h.n * power(h.f / h.n - a.m, 2)) / any_value(a.n) AS v
  FROM hosts h JOIN means a ON h.rule = a.rule GROUP BY h.rule
), priors AS (
  SELECT a.rule, a.m,
         greatest(a.m * (1 - a.m) / greatest(s.v - a.m * (1 - a.m) * a.k / a.n, 1e-6) - 1, 1.0) AS strength
  FROM means a JOIN spreads s ON a.rule = s.rule
), verdicts AS (
  SELECT host, max((f + m * strength) / (n + strength)) > 0.5 AS rejected
  FROM hosts JOIN priors ON hosts.rule = priors.rule GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT rejected AS kept
FROM measures JOIN verdicts ON measures.host = verdicts.host
"""

@query(ORACLE)
def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"), "doc_id", "text", "source").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )
