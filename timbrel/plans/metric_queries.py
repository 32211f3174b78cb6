"""Throughput, timings, progress, ensembles and agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.operators import ensemble, metrics
from timbrel.operators.positions import drop_warmup, skip_first
from timbrel.plans.job_queries import ERROR_TEXT, IS_ERROR_SQL
from timbrel.plans.registry import query, table


def _timed(spark, folder):
    """Events as results: a batch per hour, ``value`` as milliseconds."""
    return table(spark, folder, "events").select(
        (F.unix_date(F.to_date("ts")) * 24 + F.hour("ts")).alias("batch"), "value", F.expr(ERROR_TEXT).alias("error")
    )


def _throughput_sql(first_batches: int) -> str:
    return f"""
    WITH e AS (SELECT CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) AS batch, value, {ERROR_TEXT} AS error FROM events),
    b AS (SELECT batch, count(*) FILTER (NOT {IS_ERROR_SQL}) AS ok, sum(CAST(value AS DECIMAL(18,3))) AS ms,
                 row_number() OVER (ORDER BY batch) AS rn FROM e GROUP BY batch),
    t AS (SELECT CAST(sum(ok) AS BIGINT) AS files, CAST(sum(ms) AS DOUBLE) / 1000 AS seconds FROM b WHERE rn > {first_batches})
    SELECT files, seconds, files / seconds AS files_per_second, seconds / files AS seconds_per_file FROM t"""


@query("throughput", _throughput_sql(0))
def throughput(spark, folder):
    return metrics.throughput(_timed(spark, folder), "batch", "value")


@query("throughput_after_warmup", _throughput_sql(1))
def throughput_after_warmup(spark, folder):
    return metrics.throughput(_timed(spark, folder), "batch", "value", skip_batches=1)


@query(
    "throughput_marked_warmup",
    f"""
    WITH e AS (SELECT value, {ERROR_TEXT} AS error FROM events WHERE NOT coalesce(value < 1, FALSE)),
    t AS (SELECT count(*) FILTER (NOT {IS_ERROR_SQL}) AS files, CAST(sum(CAST(value AS DECIMAL(18,3))) AS DOUBLE) / 1000 AS seconds FROM e)
    SELECT files, seconds, files / seconds AS files_per_second, seconds / files AS seconds_per_file FROM t""",
)
def throughput_marked_warmup(spark, folder):
    # short results play the marked warm-up rows
    marked = _timed(spark, folder).withColumn("is_warmup", F.col("value") < 1)
    return metrics.throughput(drop_warmup(marked), "batch", "value")


@query(
    "exclude_warmup_rows",
    "SELECT event_id, event_type FROM events QUALIFY row_number() OVER (ORDER BY ts, event_id) > 25",
)
def exclude_warmup_rows(spark, folder):
    return skip_first(table(spark, folder, "events"), 25, "event_id", "ts", "event_id").select("event_id", "event_type")


@query(
    "stage_stats",
    """
    WITH t AS (SELECT event_type AS stage, CASE WHEN event_id % 4 = 0 AND event_type <> 'signup' THEN value END AS ms,
                      CASE WHEN event_id % 4 = 0 AND event_type <> 'signup' THEN 4 END AS n FROM events),
    g AS (SELECT stage, CAST(coalesce(sum(n), 0) AS BIGINT) AS processed_count, count(ms) AS batch_count,
                 CAST(coalesce(sum(CAST(ms AS DECIMAL(18,3))), 0) AS DOUBLE) AS total_ms FROM t GROUP BY stage)
    SELECT *, coalesce(total_ms / nullif(batch_count, 0), 0) AS ms_per_batch,
           coalesce(total_ms / nullif(processed_count, 0), 0) AS ms_per_row FROM g""",
)
def stage_stats(spark, folder):
    # every fourth row leads a batch and carries its timing; sign-ups never ran
    first = (F.col("event_id") % 4 == 0) & (F.col("event_type") != "signup")
    timed = table(spark, folder, "events").select(
        F.col("event_type").alias("stage"), F.when(first, F.col("value")).alias("ms"), F.when(first, 4).alias("n")
    )
    return metrics.stage_stats(timed, "stage", "ms", "n")


_KIND = "CASE event_type WHEN 'click' THEN 'SUBMIT' WHEN 'view' THEN 'RESULT' WHEN 'purchase' THEN 'RESULT' WHEN 'signup' THEN 'PRODUCER_DONE' ELSE 'LOG' END"


@query(
    "progress",
    f"""
    WITH g AS (SELECT date_trunc('day', ts) AS day, count(*) FILTER ({_KIND} = 'SUBMIT') AS submitted,
                      count(*) FILTER ({_KIND} = 'RESULT') AS consumed FROM events GROUP BY 1),
    r AS (SELECT *, CAST(sum(submitted) OVER w AS BIGINT) AS submitted_total, CAST(sum(consumed) OVER w AS BIGINT) AS consumed_total
          FROM g WINDOW w AS (ORDER BY day ROWS UNBOUNDED PRECEDING))
    SELECT strftime(day, '%Y-%m-%d') AS day, submitted, consumed, submitted_total, consumed_total,
           submitted_total - consumed_total AS backlog FROM r""",
)
def progress(spark, folder):
    log = table(spark, folder, "events").select("ts", F.expr(_KIND).alias("kind"))
    return metrics.progress(log, "ts", "kind", "day").select(
        F.date_format("interval", "yyyy-MM-dd").alias("day"),
        "submitted",
        "consumed",
        "submitted_total",
        "consumed_total",
        "backlog",
    )


def _log(spark, folder):
    # event_id orders the log; the last sign-up stands for the end of the producer
    events = table(spark, folder, "events")
    last = events.filter("event_type = 'signup'").agg(F.max("event_id")).scalar()
    kind = F.when(F.col("event_type") == "signup", F.when(F.col("event_id") == last, "PRODUCER_DONE").otherwise("LOG")).otherwise(
        F.expr(_KIND)
    )
    return events.select("event_id", (F.col("event_id") / 8).alias("elapsed"), kind.alias("kind"))


_LOG_SQL = f"""
    log AS (SELECT event_id, event_id / 8.0::DOUBLE AS elapsed,
                   CASE WHEN event_type = 'signup' THEN CASE WHEN event_id = (SELECT max(event_id) FROM events WHERE event_type = 'signup')
                        THEN 'PRODUCER_DONE' ELSE 'LOG' END ELSE {_KIND} END AS kind FROM events)"""


@query(
    "streaming_proof",
    f"""
    WITH {_LOG_SQL}, d AS (SELECT min(elapsed) AS done FROM log WHERE kind = 'PRODUCER_DONE')
    SELECT min(elapsed) FILTER (kind = 'RESULT') AS first_result, max(elapsed) FILTER (kind = 'RESULT') AS last_result,
           max(done) AS producer_done, count(*) FILTER (kind = 'RESULT' AND elapsed < done) AS results_before_done,
           count(*) FILTER (kind = 'RESULT') AS results,
           max(done) - min(elapsed) FILTER (kind = 'RESULT') AS lead_seconds,
           min(elapsed) FILTER (kind = 'RESULT') < max(done) AS streaming
    FROM log, d""",
)
def streaming_proof(spark, folder):
    return metrics.streaming_proof(_log(spark, folder), "elapsed", "kind")


@query("event_timeline", f"WITH {_LOG_SQL} SELECT event_id, elapsed, kind FROM log ORDER BY elapsed, event_id")
def event_timeline(spark, folder):
    return metrics.timeline(_log(spark, folder), "elapsed", "event_id")


# Three runs per part; the answer of a run is a list whose items depend on the run.
RUNS = 3
RUN_TEXT = """CASE WHEN p_partkey % 9 = 8 THEN 'nothing heard'
    WHEN run = 1 AND p_partkey % 4 = 1 THEN 'cut [' || chr(39) || p_name
    ELSE 'Run ' || CAST(run AS VARCHAR(20)) || ': [' || chr(39) || p_brand || chr(39) || ', ' || chr(39)
         || CASE WHEN (p_partkey + run) % 3 = 0 THEN p_type ELSE p_name END || chr(39)
         || CASE WHEN run = 2 AND p_partkey % 2 = 0 THEN ', ' || chr(39) || 'bass' || chr(39) ELSE '' END || ']' END"""
_RUNS_SQL = f"""
    runs AS (SELECT p_partkey, run, {RUN_TEXT} AS response FROM part, (SELECT unnest(range({RUNS})) AS run)),
    sets AS (SELECT p_partkey, run, response,
                    CASE WHEN body <> '' AND json_valid(body) THEN list_sort(list_distinct(from_json(CAST(body AS JSON), '["VARCHAR"]')))
                         ELSE CAST([] AS VARCHAR[]) END AS items
             FROM (SELECT *, replace(regexp_extract(response, '(?s)\\[.*\\]', 0), chr(39), '"') AS body FROM runs))"""


@query(
    "ensemble",
    f"""
    WITH {_RUNS_SQL}
    SELECT p_partkey, array_to_string(list_sort(list_distinct(flatten(list(items ORDER BY run)))), '|') AS ensembled_instruments,
           array_to_string(list(response ORDER BY run), chr(10)) AS individual_responses, count(*) AS num_runs
    FROM sets GROUP BY p_partkey""",
)
def ensemble_answers(spark, folder):
    # the answers of all runs lie in one array per row, so nothing is shuffled
    answers = F.array(*[F.expr(RUN_TEXT.replace("run", str(r))) for r in range(RUNS)])
    rows = table(spark, folder, "part").select("p_partkey", answers.alias("responses"))
    return ensemble.ensemble(rows, "responses", "p_partkey").select(
        "p_partkey",
        F.array_join("ensembled_instruments", "|").alias("ensembled_instruments"),
        F.array_join("individual_responses", "\n").alias("individual_responses"),
        F.col("num_runs").cast("bigint").alias("num_runs"),
    )


def _runs(spark, folder):
    parts = ensemble.replicate_runs(table(spark, folder, "part"), RUNS)
    return parts.select("p_partkey", F.expr(RUN_TEXT).alias("response"))


@query(
    "ensemble_rows",
    f"""
    WITH {_RUNS_SQL}, one AS (SELECT p_partkey, run, unnest(items) AS item FROM sets)
    SELECT p_partkey, item, count(*) AS runs_with_item FROM one GROUP BY p_partkey, item""",
)
def ensemble_rows(spark, folder):
    return ensemble.ensemble_rows(_runs(spark, folder), "p_partkey", "response")


_AGREEMENT_SQL = f"""
    WITH {_RUNS_SQL},
    g AS (SELECT p_partkey, count(*) AS num_runs, list(items ORDER BY run) AS all_items, max(len(items)) AS max_size FROM sets GROUP BY p_partkey),
    s AS (SELECT *, len(list_intersect(list_intersect(all_items[1], all_items[2]), all_items[3])) AS shared_items FROM g)"""


@query(
    "agreement",
    f"{_AGREEMENT_SQL} SELECT p_partkey, num_runs, shared_items, max_size, shared_items / nullif(max_size, 0)::DOUBLE AS agreement FROM s",
)
def agreement(spark, folder):
    return ensemble.agreement(_runs(spark, folder), "p_partkey", "response")


@query(
    "agreement_in_row",
    f"{_AGREEMENT_SQL} SELECT p_partkey, shared_items / nullif(max_size, 0)::DOUBLE AS agreement FROM s",
)
def agreement_in_row(spark, folder):
    answers = F.array(*[F.expr(RUN_TEXT.replace("run", str(r))) for r in range(RUNS)])
    rows = table(spark, folder, "part").select("p_partkey", answers.alias("responses"))
    return rows.select("p_partkey", ensemble.agreement_of(F.col("responses")).alias("agreement"))
