"""Query 3: the repeated units of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.lines import repeated_units
from sparkq.llm.registry import query
from sparkq.sources.views import read

# Pieces end behind a line break or a sentence; a piece begins a unit if the piece
# before it ends in a line break or if its own sentence has five words.
ORACLE = r"""
WITH pieces AS (
  SELECT doc_id, i, list[i] AS piece,
         CAST(sum(length(list[i])) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop
  FROM (SELECT doc_id, list, unnest(range(1, len(list) + 1)) AS i
        FROM (SELECT doc_id, string_split(
                regexp_replace(text, '([.!?] |\n)', '\1' || chr(1), 'g'), chr(1)) AS list
              FROM documents))
), marked AS (
  SELECT *, coalesce(lag(piece) OVER (PARTITION BY doc_id ORDER BY i) LIKE '%' || chr(10), TRUE)
         OR regexp_matches(piece,
              '^([^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\t]+){4}[^\x20\x09-\x0D]') AS begins
  FROM pieces WHERE piece <> ''
), numbered AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS unit
  FROM marked
), units AS (
  SELECT doc_id, CAST(min(stop - length(piece)) AS INT) AS start, CAST(max(stop) AS INT) AS "end",
         trim(trim(regexp_replace(lower(string_agg(piece, '' ORDER BY i)), '[\x20\x09-\x0D]+', ' ', 'g')),
              '.,;:!?"''()[]') AS norm
  FROM numbered GROUP BY doc_id, unit
), ranked AS (
  SELECT *, CAST(len(string_split(norm, ' ')) AS INT) AS n_words,
         first_value(doc_id) OVER w AS first_doc_id, first_value(start) OVER w AS first_start,
         row_number() OVER w AS place
  FROM units
  WHERE norm <> ''
  WINDOW w AS (PARTITION BY norm ORDER BY doc_id, start)
)
SELECT doc_id, start, "end", n_words, first_doc_id, first_start
FROM ranked WHERE n_words >= 5 AND place > 1
"""


@query(ORACLE)
def op3_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", F.col("end"), "n_words", "first_doc_id", "first_start"
    )
