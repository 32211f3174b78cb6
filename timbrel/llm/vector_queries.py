"""Hard negatives over the whole of ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.llm.hard_negatives import hard_negatives
from timbrel.llm.registry import query
from timbrel.llm.rows import keyed

#: The label of a row, before anything else: every seventh one is moved on.
_LABEL = "CASE WHEN {id} % 7 = 0 THEN ({label} + 1) % 10 ELSE {label} END"


@query(
    "op11_code_hard_negatives",
    f"""
    WITH e AS (SELECT row_number() OVER () AS rid, vec_id, {_LABEL.format(id="vec_id", label="CAST(label AS BIGINT)")} AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.rid AS arid, a.vec_id AS anchor_id, b.rid AS brid, b.vec_id AS other_id, a.label = b.label AS same,
                 CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
          FROM e a JOIN e b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0 AND a.rid <> b.rid),
    p AS (SELECT *, row_number() OVER (PARTITION BY arid ORDER BY score DESC, other_id NULLS LAST) AS place
          FROM s WHERE same QUALIFY place <= 5)
    SELECT p.anchor_id, p.other_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.arid, p.brid ORDER BY n.score DESC, n.other_id NULLS LAST) AS INTEGER) AS rank,
           n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.arid = p.arid AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY rank <= 5
    """,
)
def op11_code_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hard negatives of every anchor and positive."""
    rows = keyed(spark.read.parquet(f"{folder}/embeddings.parquet"))
    label = F.expr(_LABEL.format(id="doc.vec_id", label="CAST(doc.label AS BIGINT)"))
    found = hard_negatives(rows, label=label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
