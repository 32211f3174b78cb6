"""One query per operator over the whole of ``documents``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.llm.bpe import bpe
from timbrel.llm.chosen_path import jaccard_join
from timbrel.llm.exact_dedup import exact_dedup, normalised
from timbrel.llm.language import language
from timbrel.llm.lattice import lattice_score
from timbrel.llm.line_chunks import line_chunks
from timbrel.llm.line_frequency import LEFT, LINE_DOCUMENTS, LINE_SHARE, line_rules
from timbrel.llm.mixing import mix
from timbrel.llm.personal_data import KINDS, personal_data, span_list
from timbrel.llm.repeated_bytes import repeated_bytes
from timbrel.llm.registry import QUERIES, SQL, documents, query  # noqa: F401
from timbrel.llm.rows import keyed, text_of
from timbrel.llm import middle_queries, url_queries, vector_queries  # noqa: F401


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the vocabulary file of the public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op8_exact_dedup",
    r"""
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
        FROM documents),
    g AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
                 first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
          FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
    """,
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every document; the digest of singles is taken here, the operator does not need it."""
    rows = keyed(documents(spark, folder))
    digest = rows.select("row", F.sha2(normalised(text_of(rows)), 256).alias("text_sha256"))
    found = exact_dedup(rows).join(digest, "row")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op7_line_frequency_rules",
    rf"""
    WITH t AS (
        SELECT doc_id, source, coalesce(text, '') AS x,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, i, w[i:i+2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
    r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM r, (SELECT unnest([0, 1, 2]) AS d) GROUP BY 1),
    l AS (SELECT doc_id, source, x, unnest(string_split(x, chr(10))) AS line FROM t),
    m AS (SELECT *, lower(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS plain FROM l
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM m GROUP BY 1),
    host AS (SELECT source, greatest({LINE_DOCUMENTS}, {LINE_SHARE} * count(DISTINCT x)) AS most FROM m GROUP BY 1),
    f AS (SELECT source, plain FROM m JOIN host USING (source) GROUP BY source, plain, most
          HAVING count(DISTINCT x) > most),
    cut AS (SELECT doc_id, sum(length(plain)) AS n FROM m JOIN f USING (source, plain) GROUP BY 1),
    c AS (SELECT t.doc_id, len(w) AS n_words,
                 length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                 length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                 coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
                 CAST(coalesce(cut.n, 0) AS BIGINT) AS removed_chars
          FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cut USING (doc_id))
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND word_chars - removed_chars >= {LEFT} * word_chars AS kept
    FROM c
    """,
)
def op7_line_frequency_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return line_rules(documents(spark, folder)).drop("row")


@query("op5_pivotal_mix")
def op5_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mix(documents(spark, folder)).drop("row")


@query("op4_bpe_pair_index")
def op4_bpe_pair_index(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    coded = bpe(documents(spark, folder), tokenizer_path())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op2_byte_cnn_language")
def op2_byte_cnn_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    return language(documents(spark, folder)).drop("row")


@query("op9_lattice_likelihood")
def op9_lattice_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    """Base and lattice score of every document."""
    return lattice_score(documents(spark, folder), tokenizer_path("piece_bpe_32k.model")).drop("row")


@query("op10_chosen_path_join")
def op10_chosen_path_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class, links and group of every document."""
    return jaccard_join(documents(spark, folder)).drop("row")


@query("op1_line_chunks")
def op1_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document, as a digest."""
    found = line_chunks(documents(spark, folder))
    return found.select(
        "doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query("op6_boosted_personal_data")
def op6_boosted_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans of every document."""
    found = personal_data(documents(spark, folder))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans")
    )


@query("op3_repeated_bytes")
def op3_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses, and the digest of what stays."""
    return repeated_bytes(documents(spark, folder)).drop("row")
