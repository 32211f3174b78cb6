"""Fill-in-the-middle forms of the whole of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timbrel.llm.fill_middle import digests, output_pieces
from timbrel.llm.registry import documents, query


@query(
    "op12_fill_middle",
    r"""
    WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x,
                      sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT *, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
                 CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                 CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM t),
    f AS (SELECT *, len(units) AS n, CASE
              WHEN x = '' OR regexp_matches(x, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM f),
    p AS (SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
                 coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
                 coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix FROM c)
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(x) AS restored_sha256
    FROM p
    """,
)
def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, parts and digests of output and restored text of every document, all by sorted pieces."""
    return digests(output_pieces(documents(spark, folder))).drop("row")
