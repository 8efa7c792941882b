"""Query 12: all documents mixed to target weights over training time."""

from pyspark.sql import DataFrame, SparkSession

from sparkq.llm.mixture import mix
from sparkq.llm.registry import query
from sparkq.sources.views import read


@query(
    r"""
    WITH d AS (
        SELECT doc_id, source,
               CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')) AS hash
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
        FROM d GROUP BY source
    ), w AS (
        SELECT *, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
               CASE turn % 3 WHEN 0 THEN [7, 5, 3] WHEN 1 THEN [2, 2, 2] ELSE [0, 1, 2] END AS spans,
               1.5::DOUBLE * sum(source_size) OVER () AS budget
        FROM s
    ), filled AS (  -- what is left, and for which weight, if all sources before this one are at their bound
        SELECT *, budget - 2.0::DOUBLE * coalesce(sum(source_size) OVER before, 0) AS remains,
               sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights,
               row_number() OVER (ORDER BY source_size / weight, turn) AS nth
        FROM w
        WINDOW before AS (ORDER BY source_size / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), free AS (
        SELECT remains, weights, nth AS first_free FROM filled
        WHERE remains * weight / weights <= 2.0::DOUBLE * source_size
        ORDER BY nth LIMIT 1
    ), t AS (
        SELECT f.source, f.source_size, f.spans,
               CASE WHEN f.nth < free.first_free THEN 2.0::DOUBLE * f.source_size
                    ELSE free.remains * f.weight / free.weights END AS target
        FROM filled AS f CROSS JOIN free
    ), p AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, t.spans, floor(t.target + 0.5) AS goal,
               sum(d.size) OVER (PARTITION BY d.source ORDER BY d.hash, d.size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS ahead
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), r AS (
        SELECT *, CAST(greatest(least(goal - ahead, size), 0) AS BIGINT) AS first_use,
               CAST(greatest(least(goal - source_size - ahead, size), 0) AS BIGINT) AS second_use,
               ahead / goal AS part,
               spans[1] / list_sum(spans) AS one, (spans[1] + spans[2]) / list_sum(spans) AS two
        FROM p
    )
    SELECT doc_id, size, source_size, target, first_use + second_use AS taken,
           CASE WHEN first_use = 0 THEN NULL
                WHEN part < one THEN (0 + (part - 0.0::DOUBLE) / (one - 0.0::DOUBLE)) / 3
                WHEN part < two THEN (1 + (part - one) / (two - one)) / 3
                ELSE (2 + (part - two) / (1.0::DOUBLE - two)) / 3 END AS position
    FROM r
    """
)
def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, in the order of first use; ``position`` is null for those
    not taken."""
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position")
