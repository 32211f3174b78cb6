"""Streaming runs over the given tables; each result equals its batch query."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.functions.errors import is_error
from timbrel.plans.job_queries import ERROR_TEXT, IS_ERROR_SQL
from timbrel.plans.registry import query, table
from timbrel.plans.stage_queries import ANNOTATE_SQL, annotated, flat_layers
from timbrel.session import run_dir
from timbrel.sinks.tables import read_split
from timbrel.sources.media import stream_table
from timbrel.streaming import batches, counts, iterate, missing, runs, warmup

_ERRORS_SQL = f"WITH e AS (SELECT event_id, user_id, {ERROR_TEXT} AS error FROM events)"


def _arriving(spark, folder, name, **limits):
    return stream_table(spark, f"{folder}/{name}.parquet", table(spark, folder, name).schema, **limits)


def _with_error(events):
    return events.select("event_id", "user_id", F.expr(ERROR_TEXT).alias("error"))


#: Rows of a micro-batch in the queries below, and how many that wait are taken by one trigger.
BATCH, TOGETHER = 4000, 256


def _with_error_and_batch(events):
    return events.select("event_id", "user_id", F.expr(ERROR_TEXT).alias("error"), batches.FIRST)


@query(
    "stream_intake",
    f"""{_ERRORS_SQL}, n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM e)
    SELECT event_id, user_id, error, place // {BATCH} AS batch,
           count(*) OVER (PARTITION BY place // {BATCH}) AS batch_rows FROM n""",
)
def stream_intake(spark, folder):
    """Every row with the number and the size of the micro-batch that took it in; the last one is closed by time."""
    source, path = f"{folder}/events.parquet", run_dir(spark, "stream-intake")
    events = table(spark, folder, "events")
    batches.read_bounded(
        spark, source, path, events.schema, None, shape=_with_error_and_batch,
        batch_size=BATCH, batch_timeout=0.2, parallelism=4, together=TOGETHER)
    return batches.read_numbered(spark, f"{path}/table", _with_error(events).schema)


@query(
    "stream_bounded_read",
    f"""{_ERRORS_SQL}, n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place, count(*) OVER () AS n FROM e)
    SELECT event_id, user_id, error, CASE WHEN place < n // 3 THEN 1 ELSE 2 END AS run FROM n""",
)
def stream_bounded_read(spark, folder):
    """A first run takes exactly a third of the rows, a second one on the same checkpoint the others."""
    source, path = f"{folder}/events.parquet", run_dir(spark, "stream-bounded")
    events = table(spark, folder, "events")
    shape, settings = _with_error_and_batch, {"batch_size": BATCH, "parallelism": 4, "together": TOGETHER}
    schema = _with_error(events).schema
    batches.read_bounded(spark, source, path, events.schema, events.count() // 3, shape, **settings)
    first = batches.read_numbered(spark, f"{path}/table", schema).agg(F.max("batch")).first()[0]
    batches.read_bounded(spark, source, path, events.schema, None, shape, **settings)
    rows = batches.read_numbered(spark, f"{path}/table", schema)
    return rows.select("event_id", "user_id", "error", F.when(F.col("batch") <= first, 1).otherwise(2).alias("run"))


@query("stream_drain", f"{_ERRORS_SQL} SELECT event_id, {IS_ERROR_SQL} AS failed FROM e")
def stream_drain(spark, folder):
    arriving = _with_error(_arriving(spark, folder, "events"))
    failed = arriving.select("event_id", is_error(F.col("error")).alias("failed"))
    return runs.drain(failed, run_dir(spark, "stream-drain"))


@query("stream_annotate", ANNOTATE_SQL)
def stream_annotate(spark, folder):
    arriving = _arriving(spark, folder, "documents")
    return runs.drain(flat_layers(annotated(arriving)), run_dir(spark, "stream-annotate"))


@query(
    "stream_split_sink",
    f"{_ERRORS_SQL} SELECT CASE WHEN {IS_ERROR_SQL} THEN 'failure' ELSE 'success' END AS branch, event_id, user_id, error FROM e",
)
def stream_split_sink(spark, folder):
    path = run_dir(spark, "stream-split")
    runs.start_split(_with_error(_arriving(spark, folder, "events")), path).awaitTermination()
    good, bad = read_split(spark, f"{path}/table")
    return good.withColumn("branch", F.lit("success")).unionByName(bad.withColumn("branch", F.lit("failure")))


@query("stream_late_jobs", f"{_ERRORS_SQL} SELECT event_id, user_id, error FROM e")
def stream_late_jobs(spark, folder):
    """Three waves of files; the later ones arrive while the query is running."""
    path = run_dir(spark, "stream-late")
    events = table(spark, folder, "events")
    waves = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    waves[0].write.mode("append").parquet(f"{path}/inbox")
    arriving = stream_table(spark, f"{path}/inbox", events.schema)
    running = runs.start_table(_with_error(arriving), path, every="0 seconds")
    try:
        for wave in waves[1:]:
            running.processAllAvailable()
            wave.write.mode("append").parquet(f"{path}/inbox")
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{path}/table")


@query(
    "stream_iterate",
    f"""{_ERRORS_SQL} SELECT event_id % 3 AS wave, count(*) AS total, count(*) FILTER ({IS_ERROR_SQL}) AS failed,
           TRUE AS before_the_end FROM e GROUP BY 1""",
)
def stream_iterate(spark, folder):
    """Counts per wave from an iterator; each later wave is written only after results of the one before are out."""
    path = run_dir(spark, "stream-iterate")
    events = table(spark, folder, "events")
    waves = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    waves[0].write.mode("append").parquet(f"{path}/inbox")
    arriving = _with_error(stream_table(spark, f"{path}/inbox", events.schema))
    results = iterate.iterate_batches(arriving, f"{path}/run")
    sums, written = [], 1
    for _, rows in results:
        failed = is_error(F.col("error"))
        per_wave = rows.groupBy((F.col("event_id") % 3).alias("wave")).agg(
            F.count("*").alias("total"), F.count_if(failed).alias("failed"), F.lit(written).alias("written"))
        sums.append(per_wave)
        if written == 3:
            break
        waves[written].write.mode("append").parquet(f"{path}/inbox")
        written += 1
    results.close()
    every = sums[0].unionByName(sums[1]).unionByName(sums[2])
    # results of a wave came out before any later wave had been written
    early = F.max("written") == F.col("wave") + 1
    return every.groupBy("wave").agg(
        F.sum("total").alias("total"), F.sum("failed").alias("failed"), early.alias("before_the_end"))


_WARM_UP_ROWS = 3


@query(
    "stream_warmup",
    f"""
    WITH k AS (SELECT event_id, user_id, value, event_id % 97 AS replica, event_id % 11 = 0 AND event_id % 97 < 60 AS is_warmup FROM events),
    w AS (SELECT replica, count(*) FILTER (is_warmup) AS n FROM k GROUP BY 1)
    SELECT event_id, user_id, value, replica, CASE WHEN n >= {_WARM_UP_ROWS} THEN 'warm' ELSE 'timeout' END AS warm_up
    FROM k JOIN w USING (replica) WHERE NOT is_warmup""",
)
def stream_warmup(spark, folder):
    """Replicas that get their warm-up rows release what waits; the others do so when their time is over."""
    path = run_dir(spark, "stream-warmup")
    events = table(spark, folder, "events")
    arriving = _arriving(spark, folder, "events").select(
        "event_id", "user_id", "value", (F.col("event_id") % 97).alias("replica"),
        ((F.col("event_id") % 11 == 0) & (F.col("event_id") % 97 < 60)).alias("is_warmup"),
    )
    before = spark.conf.get(warmup.STATE_STORE[0])
    spark.conf.set(*warmup.STATE_STORE)
    try:
        released = warmup.warm_up(arriving, "replica", "is_warmup", _WARM_UP_ROWS, timeout=3.0)
        running = runs.start_table(released, path, every="0 seconds")
    finally:
        spark.conf.set(warmup.STATE_STORE[0], before)
    marked = (F.col("event_id") % 11 == 0) & (F.col("event_id") % 97 < 60)
    expected = events.filter(~marked).count()
    try:
        runs.wait_for(lambda: spark.read.schema(released.schema).parquet(f"{path}/table").count() >= expected, running)
    finally:
        running.stop()
    return spark.read.parquet(f"{path}/table")


@query(
    "stream_counts",
    f"""{_ERRORS_SQL.replace("user_id,", "user_id, props,")}
    SELECT count(*) AS total, count(*) FILTER (user_id % 7 <> 0 AND NOT {IS_ERROR_SQL}) AS ok,
           count(*) FILTER (user_id % 7 <> 0 AND {IS_ERROR_SQL}) AS failed, count(*) FILTER (user_id % 7 = 0) AS quarantined,
           CAST(sum(strlen(props)) AS BIGINT) AS bytes FROM e""",
)
def stream_counts(spark, folder):
    """Counts of a job taken from its micro-batches while it writes its results."""
    path = run_dir(spark, "stream-counts")
    arriving = _arriving(spark, folder, "events").select("event_id", "user_id", "props", F.expr(ERROR_TEXT).alias("error"))
    seen = counts.RunCounts("job")
    counted = counts.observe_counts(arriving, "job", size=F.octet_length("props"), quarantined=F.col("user_id") % 7 == 0)
    spark.streams.addListener(seen)
    try:
        running = runs.start_table(counted, path, available_now=True)
        running.awaitTermination()
        runs.wait_for(lambda: str(running.id) in seen.ended)
    finally:
        spark.streams.removeListener(seen)
    return seen.frame(spark).drop("batches")


@query(
    "stream_missing",
    """
    WITH j AS (SELECT event_id AS job_id, TIMESTAMP '2024-01-01' + event_id * INTERVAL 1 SECOND AS submitted FROM events)
    SELECT job_id, submitted, CASE WHEN job_id % 100 <> 42 THEN submitted + INTERVAL 5 SECOND END AS finished,
           job_id % 100 = 42 AS missing FROM j""",
)
def stream_missing(spark, folder):
    """Three waves of jobs and of their results, some of which are lost; a last pair moves the clock on."""
    path = run_dir(spark, "stream-missing")
    n = table(spark, folder, "events").agg(F.max("event_id")).first()[0] + 1
    at = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.col("event_id"))
    events = table(spark, folder, "events").select(F.col("event_id").alias("job_id"), at.cast("timestamp").alias("submitted"))
    done = events.filter("job_id % 100 <> 42").select("job_id", (F.col("submitted") + F.expr("INTERVAL 5 SECONDS")).alias("finished"))
    last = events.agg(F.max("submitted").alias("t")).select((F.col("t") + F.expr("INTERVAL 1 DAY")).alias("t"))
    end = last.select(F.lit(-1).cast("bigint").alias("job_id"), F.col("t"))

    def arrive(rows, name):
        rows.write.mode("append").parquet(f"{path}/{name}")

    def wave(i):
        part = (F.col("job_id") >= i * n // 3) & (F.col("job_id") < (i + 1) * n // 3)
        arrive(events.filter(part), "jobs")
        arrive(done.filter(part), "results")

    wave(0)
    found = missing.missing_on_stream(
        stream_table(spark, f"{path}/jobs", events.schema), stream_table(spark, f"{path}/results", done.schema),
        "job_id", "submitted", "finished", wait="10 SECONDS", late="1 MINUTE",
    )
    running = runs.start_table(found, path, every="0 seconds")
    try:
        running.processAllAvailable()
        for i in (1, 2):
            wave(i)
            running.processAllAvailable()
        arrive(end.select("job_id", F.col("t").alias("submitted")), "jobs")
        arrive(end.select("job_id", F.col("t").alias("finished")), "results")
        arrive(end.select("job_id", (F.col("t") + F.expr("INTERVAL 2 DAYS")).alias("submitted")), "jobs")
        arrive(end.select("job_id", (F.col("t") + F.expr("INTERVAL 2 DAYS")).alias("finished")), "results")
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(found.schema).parquet(f"{path}/table").filter("job_id >= 0")
