"""Jobs, names, uploads and error rules over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.functions import names
from timbrel.functions.errors import is_error
from timbrel.operators import metrics, results, uploads
from timbrel.plans.registry import query, table
from timbrel.sources.media import wrap_items

# Text rules below are plain SQL understood by both engines.
SONG_ID = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'song_' || CAST(doc_id AS VARCHAR(20)) END"
DOC_NAME = "'doc_' || CAST(doc_id AS VARCHAR(20)) || '.' || lang || '.txt'"
FILE_NAME = """CASE doc_id % 9
    WHEN 0 THEN 'a.mp3' WHEN 1 THEN 'A.FLAC' WHEN 2 THEN 'noext' WHEN 3 THEN 'a.txt' WHEN 4 THEN 'b.c.Wav'
    WHEN 5 THEN 'x.' WHEN 6 THEN '.ogg' WHEN 7 THEN 'clip.m4a' ELSE 'take.aiff' END"""
ERROR_TEXT = """CASE event_type
    WHEN 'error' THEN 'Preprocessing failed: invalid format'
    WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE chr(10) || ' ' || chr(9) END
    WHEN 'view' THEN NULL
    WHEN 'signup' THEN 'nan'
    ELSE CASE event_id % 4 WHEN 0 THEN 'Error: file not found' WHEN 1 THEN chr(10) || 'late' ELSE '' END END"""
IS_ERROR_SQL = "coalesce(error <> 'nan' AND trim(error, ' ' || chr(9) || chr(10) || chr(13)) <> '', FALSE)"


@query(
    "job_rows",
    f"""
    SELECT doc_id, {DOC_NAME} AS filename,
           'job_' || substr(sha256('job|' || doc_id), 1, 12) AS job_id,
           'job_' || substr(sha256('job|' || source), 1, 12) AS request_job_id,
           coalesce(nullif({SONG_ID}, ''), 'trk_' || substr(sha256('trk|' || doc_id), 1, 12)) AS song_id,
           sha256(text) AS song_hash
    FROM documents""",
)
def job_rows(spark, folder):
    docs = table(spark, folder, "documents")
    jobs = results.make_jobs(
        docs, F.col("text"), F.expr(DOC_NAME), key=[F.col("doc_id")], song_id=F.expr(SONG_ID)
    )
    return jobs.select(
        "doc_id",
        "filename",
        "job_id",
        names.stable_id("job", F.col("source")).alias("request_job_id"),
        "song_id",
        "song_hash",
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS song_hash, substr(sha256(text), 1, 16) AS hash16 FROM documents")
def content_hash(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", names.content_hash(text).alias("song_hash"), names.content_hash(text, 16).alias("hash16")
    )


@query(
    "file_stem",
    r"""
    WITH named AS (
        SELECT page_id, CASE page_id % 5 WHEN 0 THEN url || '.tar.gz' WHEN 1 THEN url || '/.hidden'
                        WHEN 2 THEN url || '/dir.d/name' ELSE url END AS path FROM pages),
    based AS (SELECT page_id, split_part(path, '/', -1) AS name FROM named)
    SELECT page_id, name, split_part(name, '.', 1) AS stem_first,
           regexp_replace(name, '^(.+)\.[^.]+$', '\1', 's') AS stem_last,
           CASE WHEN contains(name, '.') THEN split_part(name, '.', -1) ELSE 'mp3' END AS suffix
    FROM based""",
)
def file_stem(spark, folder):
    path = F.expr(
        "CASE page_id % 5 WHEN 0 THEN url || '.tar.gz' WHEN 1 THEN url || '/.hidden' "
        "WHEN 2 THEN url || '/dir.d/name' ELSE url END"
    )
    return table(spark, folder, "pages").select(
        "page_id",
        names.basename(path).alias("name"),
        names.stem_to_first_dot(path).alias("stem_first"),
        names.stem_to_last_dot(path).alias("stem_last"),
        names.decoder_suffix(names.basename(path)).alias("suffix"),
    )


@query(
    "sanitize_name",
    r"""SELECT page_id, translate(url || '<|>"*' || chr(92), '<>:"/\|?*', '_________') AS name FROM pages""",
)
def sanitize_name(spark, folder):
    raw = F.concat("url", F.lit('<|>"*\\'))
    return table(spark, folder, "pages").select("page_id", names.sanitize_name(raw).alias("name"))


@query(
    "track_keys",
    """
    WITH t AS (
        SELECT p_partkey, p_name, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN p_brand
                                  ELSE p_brand || ', ' || p_type END AS artists FROM part)
    SELECT p_partkey, artists, p_name || ' ' || artists AS search_text, artists || ' - ' || p_name AS display_name
    FROM t""",
)
def track_keys(spark, folder):
    people = F.expr(
        "CASE p_partkey % 3 WHEN 0 THEN CAST(array() AS array<struct<name:string>>) "
        "WHEN 1 THEN array(named_struct('name', p_brand)) "
        "ELSE array(named_struct('name', p_brand), named_struct('name', p_type)) END"
    )
    tracks = table(spark, folder, "part").withColumn("artists", names.join_names(people))
    name, artists = F.col("p_name"), F.col("artists")
    return tracks.select(
        "p_partkey",
        "artists",
        names.search_text(name, artists).alias("search_text"),
        names.display_name(name, artists).alias("display_name"),
    )


VALID_SQL = f"""
    files AS (SELECT doc_id, source, {FILE_NAME} AS filename, n_chars * 10000 AS size FROM documents),
    parts AS (SELECT *, lower(split_part(filename, '.', -1)) AS ext FROM files),
    checked AS (
        SELECT *, CASE WHEN NOT contains(filename, '.') THEN 400
                       WHEN ext NOT IN ('mp3','wav','flac','ogg','m4a','aac','wma','aiff') THEN 400
                       WHEN size > 104857600 THEN 413 ELSE 200 END AS code FROM parts)"""
LISTED = "aac, aiff, flac, m4a, mp3, ogg, wav, wma"


def _files(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", "source", F.expr(FILE_NAME).alias("filename"), (F.col("n_chars") * 10000).alias("size")
    )


@query(
    "validate_files",
    f"""
    WITH {VALID_SQL}
    SELECT doc_id, code = 200 AS ok, code,
           CASE WHEN NOT contains(filename, '.') THEN 'File must have an extension. Allowed: {LISTED}'
                WHEN code = 400 THEN 'File extension ' || chr(39) || ext || chr(39) || ' not allowed. Allowed: {LISTED}'
                WHEN code = 413 THEN 'File too large. Maximum size: 100.0MB' ELSE '' END AS detail
    FROM checked""",
)
def validate_files(spark, folder):
    verdict = uploads.validate_upload(F.col("filename"), F.col("size"))
    return _files(spark, folder).select("doc_id", verdict.alias("v")).select("doc_id", "v.*")


@query(
    "validate_batch_prefix",
    f"""
    WITH {VALID_SQL}
    SELECT doc_id, source,
           sum(CASE WHEN code <> 200 THEN 1 ELSE 0 END)
               OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) = 0 AS accepted
    FROM checked""",
)
def validate_batch_prefix(spark, folder):
    files = _files(spark, folder)
    ok = uploads.validate_upload(F.col("filename"), F.col("size"))["ok"]
    return uploads.accept_prefix(files, "source", "doc_id", ok).select("doc_id", "source", "accepted")


@query("wrap_item", "SELECT text AS data FROM conversations")
def wrap_item(spark, folder):
    return wrap_items(table(spark, folder, "conversations"), "text")


@query(
    "error_split",
    f"""
    WITH e AS (SELECT event_id, {ERROR_TEXT} AS error FROM events)
    SELECT event_id, error, 'failure' AS branch FROM e WHERE {IS_ERROR_SQL}
    UNION ALL SELECT event_id, error, 'success' FROM e WHERE NOT {IS_ERROR_SQL}""",
)
def error_split(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.expr(ERROR_TEXT).alias("error"))
    # both branches in one pass; split_errors gives them as two frames
    return rows.withColumn("branch", F.when(is_error(F.col("error")), "failure").otherwise("success"))


@query(
    "error_counts",
    f"""
    WITH e AS (SELECT event_type, {ERROR_TEXT} AS error FROM events)
    SELECT event_type, count(*) AS total, count(*) FILTER (NOT {IS_ERROR_SQL}) AS successful,
           count(*) FILTER ({IS_ERROR_SQL}) AS failed
    FROM e GROUP BY event_type""",
)
def error_counts(spark, folder):
    rows = table(spark, folder, "events").select("event_type", F.expr(ERROR_TEXT).alias("error"))
    return metrics.error_counts(rows, "event_type")


@query(
    "status_counts",
    f"""
    WITH e AS (SELECT event_id, event_type, {ERROR_TEXT} AS error FROM events),
    s AS (SELECT CASE WHEN event_id % 11 = 0 THEN 'skipped' WHEN event_id % 13 = 0 THEN 'unknown'
                      WHEN event_id % 7 = 0 THEN 'skipped' WHEN {IS_ERROR_SQL} THEN 'error'
                      ELSE 'downloaded' END AS status,
                 CASE WHEN event_id % 11 = 0 THEN 'no_track' WHEN event_id % 13 = 0 THEN 'no_name'
                      WHEN event_id % 7 = 0 THEN 'no_results' WHEN {IS_ERROR_SQL} THEN error
                      ELSE '' END AS reason FROM e)
    SELECT status, count(*) AS n, count(*) FILTER (reason <> '') AS with_reason FROM s GROUP BY status""",
)
def status_counts(spark, folder):
    eid = F.col("event_id")
    rows = table(spark, folder, "events").select("event_id", F.expr(ERROR_TEXT).alias("error"))
    outcome = metrics.intake_status(
        eid % 11 != 0,
        F.when(eid % 13 != 0, F.lit("name")),
        F.when(eid % 7 == 0, 0).otherwise(1),
        F.col("error"),
    )
    # a debug run writes "debug"; it is counted with the downloads
    found = rows.select(outcome.alias("o"), "event_id").select(
        F.when((F.col("o.status") == "downloaded") & (eid % 2 == 0), "debug").otherwise(F.col("o.status")).alias("status"),
        "o.reason",
    )
    return metrics.status_counts(found)


@query(
    "skip_existing",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def skip_existing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return results.skip_existing(docs, table(spark, folder, "labels"), "doc_id")


@query(
    "completeness",
    """
    SELECT (SELECT count(*) FROM orders) AS submitted, (SELECT count(*) FROM lineitem
               WHERE l_orderkey IN (SELECT o_orderkey FROM orders)) AS received,
           (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS missing,
           NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS complete""",
)
def completeness(spark, folder):
    jobs = table(spark, folder, "orders").select(F.col("o_orderkey").alias("job"))
    done = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("job"))
    return results.completeness(jobs, done, "job")


@query(
    "missing_results",
    "SELECT o_orderkey AS job, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def missing_results(spark, folder):
    jobs = table(spark, folder, "orders").select(F.col("o_orderkey").alias("job"), "o_orderstatus")
    done = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("job"))
    return results.missing_results(jobs, done, "job")
