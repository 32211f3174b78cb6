"""Whole jobs over the given tables: the evaluation set, and decode to results."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.functions import chat
from timbrel.operators import results
from timbrel.operators.stages import Predictor
from timbrel.plans import bulk, eval_set, rule_model
from timbrel.plans.media_queries import wav_jobs
from timbrel.plans.registry import query, table

N = 50

# A search answer per part: its type is the genre, and sizes make tracks recur between genres.
_ITEMS = """transform(sequence(0, p_size % 4), i -> named_struct(
    'id', 't' || (p_size * 10 + i), 'name', p_name, 'artists', array(named_struct('name', p_brand)),
    'album', named_struct('name', p_type), 'popularity', p_size + i, 'duration_ms', p_partkey * 1000 + i,
    'preview_url', CASE WHEN i = 1 THEN 'http://x/' || p_partkey END))"""


@query(
    "eval_set_build",
    f"""
    WITH kinds AS (SELECT p_type, row_number() OVER (ORDER BY p_type DESC) AS genre_pos FROM (SELECT DISTINCT p_type FROM part)),
    hits AS (
        SELECT lower(p.p_type) AS genre, upper(substr(p.p_type, 1, 1)) || lower(substr(p.p_type, 2)) AS target_genre,
               genre_pos, CASE WHEN p_retailprice >= 905 THEN 0 ELSE 1 END AS src, p_partkey AS page, i AS position,
               't' || (p_size * 10 + i) AS track_id, p_name AS track_name, p_brand AS artists, p_size + i AS popularity,
               p_partkey * 1000 + i AS duration_ms, CASE WHEN i = 1 THEN 'http://x/' || p_partkey END AS preview_url
        FROM (SELECT *, CAST(unnest(range(p_size % 4 + 1)) AS INTEGER) AS i FROM part) p JOIN kinds k ON k.p_type = p.p_type),
    drawn AS (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY src, page, position) AS rn FROM hits),
    uniq AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY genre_pos, src, page, position) AS first
             FROM drawn WHERE rn <= {N})
    SELECT target_genre, genre, track_id, track_name, artists, popularity, duration_ms, preview_url FROM uniq WHERE first = 1""",
)
def eval_set_build(spark, folder):
    part = table(spark, folder, "part")
    pages = part.select(
        F.lower("p_type").alias("genre"), F.col("p_partkey").alias("page"), "p_retailprice", F.expr(_ITEMS).alias("items")
    )
    searches = pages.filter("p_retailprice >= 905").withColumn(
        "payload", F.to_json(F.struct(F.struct("items").alias("tracks")))
    )
    recommended = pages.filter("p_retailprice < 905").withColumn(
        "payload", F.to_json(F.struct(F.col("items").alias("tracks")))
    )
    kinds = part.select("p_type").distinct()
    targets = kinds.select(
        F.initcap(F.lower("p_type")).alias("target"), (-F.ascii("p_type") * 256 - F.ascii(F.substr("p_type", F.lit(2)))).alias("genre_pos")
    )
    available = kinds.select(F.lower("p_type").alias("name"), F.ascii("p_type").alias("pos"))
    built = eval_set.build_eval_set(searches, recommended, targets, available, N)
    return built.select(
        "target_genre", "genre", "track_id", "track_name", "artists", "popularity", "duration_ms", "preview_url"
    )


STEP_2 = "Of {plan}: list the layers {{json}}"
_RATE_SQL = "CASE label % 3 WHEN 0 THEN 8000 WHEN 1 THEN 44100 ELSE 16000 END"


@query(
    "bulk_media",
    f"""
    WITH j AS (
        SELECT vec_id, 'clip' || vec_id || '.wav' AS filename, 'job_' || substr(sha256('job|' || vec_id), 1, 12) AS job_id,
               CAST(ceil(64 * 16000.0 / {_RATE_SQL}) AS INTEGER) || ' samples' AS plan,
               CASE WHEN vec_id % 6 = 5 THEN 'Preprocessing failed: file does not start with RIFF id' ELSE '' END AS error
        FROM embeddings),
    p AS (SELECT *, 'Of ' || plan || ': list the layers {{json}}' AS prompt FROM j)
    SELECT job_id, filename, CASE WHEN error = '' THEN plan ELSE '' END AS planning_response,
           CASE WHEN error = '' THEN CAST(length(prompt) AS VARCHAR) ELSE '' END AS background,
           CASE WHEN error = '' THEN md5(prompt) ELSE '' END AS foreground, error FROM p""",
)
def bulk_media(spark, folder):
    """Files made from the embeddings: jobs, decode, resample, two prompts, parse, envelope."""
    rate = F.when(F.col("label") % 3 == 0, 8000).when(F.col("label") % 3 == 1, 44100).otherwise(16000)
    files = wav_jobs(spark, folder, F.lit(1), rate).withColumn(
        "audio_bytes", F.when(F.col("vec_id") % 6 == 5, F.lit(b"not a wave file")).otherwise(F.col("audio_bytes"))
    )
    jobs = results.make_jobs(files, F.col("audio_bytes"), F.col("filename"), key=[F.col("vec_id")])
    done = bulk.annotate_jobs(
        jobs, Predictor(rule_model.sample_counts), Predictor(rule_model.final_answers), STEP_2
    )
    return done.select(
        "job_id",
        "filename",
        "planning_response",
        F.array_join("background", "|").alias("background"),
        F.array_join("foreground", "|").alias("foreground"),
        "error",
    )


SYSTEM, FIRST, SECOND = "You label recordings.", "Say what you hear.", "You heard a recording."


@query(
    "bulk_media_chat",
    f"""
    WITH s AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(trunc(CAST(x AS DOUBLE) * 32767) AS INTEGER)) AS s,
               CASE WHEN vec_id % 6 = 5 THEN 'Preprocessing failed: file does not start with RIFF id' ELSE '' END AS error
        FROM embeddings),
    h AS (SELECT *, len(s) || ' samples of ' || CAST(list_sum(s) AS BIGINT) AS sound FROM s),
    p AS (SELECT *, sound || ' for ' || md5('{SYSTEM}' || chr(10) || chr(10) || '{FIRST}') AS plan FROM h)
    SELECT vec_id, CASE WHEN error = '' THEN plan ELSE '' END AS planning_response,
           CASE WHEN error = '' THEN sound ELSE '' END AS background,
           CASE WHEN error = '' THEN md5('{SYSTEM}{SECOND}' || chr(10) || chr(10) || 'Of ' || plan || ': list the layers {{json}}')
                ELSE '' END AS foreground, error FROM p""",
)
def bulk_media_chat(spark, folder):
    """The whole job with chats: the first has the recording, the second has it again beside the plan."""
    files = wav_jobs(spark, folder, F.lit(1), F.lit(16000)).withColumn(
        "audio_bytes", F.when(F.col("vec_id") % 6 == 5, F.lit(b"not a wave file")).otherwise(F.col("audio_bytes"))
    )
    jobs = results.make_jobs(
        files, F.col("audio_bytes"), F.col("filename"), key=[F.col("vec_id")], song_id=F.col("vec_id").cast("string")
    )
    done = bulk.annotate_jobs(
        jobs,
        Predictor(rule_model.chat_plans, batch_size=8),
        Predictor(rule_model.chat_finals, batch_size=8),
        lambda audio, plan: chat.next_step_chat(SYSTEM, STEP_2, audio, SECOND, plan=plan),
        step_1=lambda audio: chat.first_step_chat(SYSTEM, FIRST, audio),
    )
    return done.select(
        F.col("song_id").cast(files.schema["vec_id"].dataType).alias("vec_id"),
        "planning_response",
        F.array_join("background", "|").alias("background"),
        F.array_join("foreground", "|").alias("foreground"),
        "error",
    )
