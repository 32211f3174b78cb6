"""User-function stages and annotation over the given tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.functions import parse
from timbrel.functions.text import fill_template
from timbrel.operators import ensemble, metrics, results, stages, uploads
from timbrel.plans import rule_model
from timbrel.plans.registry import query, table

_LINE = [
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()),
]


def _lines(spark, folder, *more):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *more)


def _priced(rows: list[dict], factor: float) -> list[dict]:
    return [{**r, "amount": r["l_quantity"] * factor + r["l_linenumber"]} for r in rows]


PRICE = stages.Stage(
    "price",
    _priced,
    T.StructType([*_LINE, T.StructField("amount", T.DoubleType())]),
    setup=lambda: 2.0,
    batch_size=4096,
)


@query("stage_map", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 + l_linenumber AS amount FROM lineitem")
def stage_map(spark, folder):
    return stages.map_stage(_lines(spark, folder, "l_quantity"), PRICE)


def _columns(batch: dict[str, list]) -> dict[str, list]:
    keep = {k: batch[k] for k in ("l_orderkey", "l_linenumber", "l_partkey")}
    return {**keep, "amount": [q + 1.0 for q in batch["l_quantity"]]}


@query("stage_columns", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 1 AS amount FROM lineitem")
def stage_columns(spark, folder):
    stage = stages.Stage("columns", _columns, PRICE.schema, batch_format=stages.COLUMNS, batch_size=8192)
    return stages.map_stage(_lines(spark, folder, "l_quantity"), stage)


def _table(batch: pa.Table, factor: float) -> pa.Table:
    return batch.append_column("amount", pc.add(pc.multiply(batch["l_quantity"], factor), batch["l_linenumber"]))


@query("stage_arrow", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 + l_linenumber AS amount FROM lineitem")
def stage_arrow(spark, folder):
    stage = stages.Stage(
        "arrow", _table, PRICE.schema, setup=lambda: 2.0, batch_format=stages.ARROW, batch_size=8192
    )
    return stages.map_stage(_lines(spark, folder, "l_quantity"), stage)


@query("stage_items", "SELECT upper(role) AS item, length(role) AS n FROM conversations")
def stage_items(spark, folder):
    stage = stages.Stage(
        "items",
        lambda items: [{"item": x.upper(), "n": len(x)} for x in items],
        T.StructType([T.StructField("item", T.StringType()), T.StructField("n", T.LongType())]),
        batch_format=stages.ITEMS,
        item_column="role",
    )
    return stages.map_stage(table(spark, folder, "conversations"), stage)


def _expanded(rows: list[dict]) -> list[dict]:
    """Drops lines with number 1 and repeats the others."""
    return [{**r, "copy": i} for r in rows if r["l_linenumber"] != 1 for i in range(r["l_linenumber"] % 3 + 1)]


EXPAND = stages.Stage(
    "expand", _expanded, T.StructType([*_LINE, T.StructField("copy", T.IntegerType())]), batch_size=4096
)


@query(
    "stage_expand",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(unnest(range(l_linenumber % 3 + 1)) AS INTEGER) AS copy
    FROM lineitem WHERE l_linenumber <> 1""",
)
def stage_expand(spark, folder):
    return stages.map_stage(_lines(spark, folder), EXPAND)


def _expanded_batch(batch: pa.RecordBatch):
    """As :func:`_expanded`, on Arrow columns."""
    number = batch.column("l_linenumber").to_numpy()
    times = np.where(number != 1, number % 3 + 1, 0)
    at = np.repeat(np.arange(len(times)), times)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    taken = batch.take(pa.array(at))
    yield pa.table({**{n: taken.column(n) for n in taken.schema.names}, "copy": pa.array(copy, pa.int32())})


@query(
    "stage_expand_table",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(unnest(range(l_linenumber % 3 + 1)) AS INTEGER) AS copy
    FROM lineitem WHERE l_linenumber <> 1""",
)
def stage_expand_table(spark, folder):
    """The same by a table function with a table argument."""
    return stages.expand_rows(_lines(spark, folder), _expanded_batch, EXPAND.schema)


def _copied(rows: list[dict]) -> list[dict]:
    return [{**r, "amount": r["copy"] * 0.5 + r["l_partkey"]} for r in rows]


@query(
    "stage_chain",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(copy * 0.5 + l_partkey AS DOUBLE) AS amount FROM (
        SELECT *, unnest(range(l_linenumber % 3 + 1)) AS copy FROM lineitem WHERE l_linenumber <> 1)
    WHERE copy < 2""",
)
def stage_chain(spark, folder):
    copied = stages.Stage("copied", _copied, PRICE.schema, batch_size=4096)
    return stages.chain(_lines(spark, folder), EXPAND, lambda df: df.filter("copy < 2"), copied)


def _refusing(rows: list[dict]) -> list[dict]:
    if any(r["l_partkey"] % 97 == 0 for r in rows):
        raise ValueError("refused")
    return [{**r, "error": ""} for r in rows]


@query(
    "stage_errors",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 97 = 0 THEN 'refused' ELSE '' END AS error
    FROM lineitem""",
)
def stage_errors(spark, folder):
    stage = stages.Stage(
        "refusing",
        _refusing,
        T.StructType([*_LINE, T.StructField("error", T.StringType())]),
        batch_size=64,
        on_error="row",
        error_row=lambda row, message: {**row, "error": message},
    )
    return stages.map_stage(_lines(spark, folder), stage)


# Every tenth document arrives with an error of an earlier stage.
_UPSTREAM = "CASE WHEN doc_id % 10 = 0 THEN 'Preprocessing failed: no text' ELSE '' END"
_THE = "((length(text) - length(replace(text, 'the', ''))) // 3)"
_LAYER_SQL = f"""
    d AS (SELECT doc_id, source, lang, text, length(text) AS len, {_THE} AS n, {_UPSTREAM} AS upstream FROM documents),
    a AS (SELECT *, CASE WHEN upstream <> '' THEN upstream
                         WHEN len % 13 = 7 THEN 'Prediction failed: cannot label ' || len || ' characters' ELSE '' END AS error FROM d),
    r AS (SELECT *, CASE WHEN error <> '' OR len % 4 > 1 THEN '' WHEN len % 4 = 0 THEN 'the ' || n ELSE 'pad|the ' || n END AS background,
                    CASE WHEN error <> '' OR len % 4 > 1 THEN '' WHEN len % 4 = 0 THEN 'piano' ELSE 'pad' END AS foreground,
                    CASE WHEN error <> '' OR len % 4 > 1 THEN '' WHEN len % 4 = 0 THEN 'piano|the ' || n ELSE 'pad|the ' || n END AS instruments
          FROM a)"""


def annotated(docs, batch_size=32, on_error="row", *keep):
    predictor = stages.Predictor(rule_model.layer_answers, batch_size=batch_size, on_error=on_error)
    rows = docs.withColumn("error", F.expr(_UPSTREAM))
    return stages.annotate(rows, predictor, F.col("text"), "doc_id", *keep)


def flat_layers(df):
    return df.select(
        "doc_id",
        F.array_join("background", "|").alias("background"),
        F.array_join("foreground", "|").alias("foreground"),
        F.array_join(F.array_sort("instruments"), "|").alias("instruments"),
        "error",
    )


ANNOTATE_SQL = f"WITH {_LAYER_SQL} SELECT doc_id, background, foreground, instruments, error FROM r"


@query("annotate", ANNOTATE_SQL)
def annotate(spark, folder):
    return flat_layers(annotated(table(spark, folder, "documents")))


@query(
    "annotate_flat",
    f"""
    WITH {_LAYER_SQL}
    SELECT doc_id, error,
           CASE WHEN error <> '' THEN '' WHEN len % 3 = 0 THEN n || ' drums' ELSE 'the ' || n || '|drums' END AS instruments
    FROM r""",
)
def annotate_flat(spark, folder):
    """A plain list in an envelope of its own."""
    rows = table(spark, folder, "documents").withColumn("error", F.expr(_UPSTREAM))
    predictor = stages.Predictor(rule_model.list_answers)
    flat = stages.annotate(
        rows, predictor, F.col("text"), "doc_id", parse=parse.parse_list, envelope=results.flat_envelope
    )
    return flat.select("doc_id", "error", F.array_join("instruments", "|").alias("instruments"))


@query("annotate_skip", f"WITH {_LAYER_SQL} SELECT doc_id, background, foreground, instruments, error FROM r WHERE error NOT LIKE 'Pred%'")
def annotate_skip(spark, folder):
    # with batches of one, skipping a failing batch drops exactly the refused rows
    return flat_layers(annotated(table(spark, folder, "documents"), batch_size=1, on_error="skip"))


@query("annotate_stats", "SELECT 'annotate' AS stage, count(*) AS processed_count FROM documents WHERE doc_id % 10 <> 0")
def annotate_stats(spark, folder):
    predictor = stages.Predictor(rule_model.layer_answers)
    rows = table(spark, folder, "documents").withColumn("error", F.expr(_UPSTREAM))
    timed = stages.predict(rows, "answer", predictor, [F.col("text")])
    stats = timed.select(F.lit("annotate").alias("stage"), "answer.batch_ms", "answer.batch_rows")
    return metrics.stage_stats(stats, "stage", "batch_ms", "batch_rows").select("stage", "processed_count")


STEP_2 = "About {plan}: answer {{json}}"
_PLAN_SQL = f"{_THE} || ' {{times}} in ' || length(text)"


@query(
    "annotate_two_step",
    f"""
    WITH p AS (SELECT doc_id, {_UPSTREAM} AS error, {_PLAN_SQL} AS plan FROM documents),
    f AS (SELECT *, 'About ' || plan || ': answer {{json}}' AS prompt FROM p)
    SELECT doc_id, CASE WHEN error = '' THEN plan ELSE '' END AS planning_response,
           CASE WHEN error = '' THEN CAST(length(prompt) AS VARCHAR) ELSE '' END AS background,
           CASE WHEN error = '' THEN md5(prompt) ELSE '' END AS foreground, error FROM f""",
)
def annotate_two_step(spark, folder):
    rows = table(spark, folder, "documents").withColumn("error", F.expr(_UPSTREAM))
    answered = stages.annotate_steps(
        rows,
        [
            ("plan", stages.Predictor(rule_model.plan_answers), lambda _: F.col("text")),
            ("final", stages.Predictor(rule_model.final_answers), lambda a: fill_template(STEP_2, plan=a["plan"])),
        ],
    )
    out = results.layered_result(
        answered, parse.parse_layers(F.col("final")), F.col("plan"), F.col("error"), "doc_id"
    )
    return out.select(
        "doc_id",
        "planning_response",
        F.array_join("background", "|").alias("background"),
        F.array_join("foreground", "|").alias("foreground"),
        "error",
    )


@query(
    "annotate_three_step",
    f"""
    WITH p AS (SELECT doc_id, {_UPSTREAM} AS error, {_PLAN_SQL} AS step_1 FROM documents),
    q AS (SELECT *, '{{"background": ["' || length('When: ' || step_1) || '"], "foreground": ["' || md5('When: ' || step_1) || '"]}}' AS step_2 FROM p),
    t AS (SELECT *, length(step_1 || ' / ' || step_2) AS n FROM q)
    SELECT doc_id, CASE WHEN error = '' THEN step_1 END AS step_1, CASE WHEN error = '' THEN step_2 END AS step_2,
           CASE WHEN error = '' AND n % 2 = 1 THEN 1 ELSE 0 END::INTEGER AS n_instruments,
           CASE WHEN error = '' AND n % 2 = 1 THEN 'pad' END AS name,
           CASE WHEN error = '' AND n % 2 = 1 THEN n % 60 END AS start_seconds FROM t""",
)
def annotate_three_step(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text", F.expr(_UPSTREAM).alias("error"))
    answered = stages.annotate_steps(
        rows,
        [
            ("step_1", stages.Predictor(rule_model.plan_answers), lambda _: F.col("text")),
            ("step_2", stages.Predictor(rule_model.final_answers), lambda a: fill_template("When: {s}", s=a["step_1"])),
            (
                "step_3",
                stages.Predictor(rule_model.timeline_answers),
                lambda a: fill_template("{s} / {t}", s=a["step_1"], t=a["step_2"]),
            ),
        ],
    )
    parsed = answered.withColumn("timeline", parse.parse_timeline(F.col("step_3")))
    spans = parse.explode_timeline(parsed, "timeline", "doc_id", "step_1", "step_2")
    return spans.select("doc_id", "step_1", "step_2", "n_instruments", "name", "start_seconds")


@query(
    "predict_runs",
    f"""
    WITH d AS (SELECT doc_id, {_UPSTREAM} AS error, {_THE} AS n, length(text) AS len FROM documents),
    r AS (SELECT doc_id, error, len, unnest(range(3)) AS run, n FROM d),
    i AS (SELECT doc_id, 'i' || ((n + run) % 3) AS item FROM r WHERE error = '' AND NOT (run = 1 AND len % 5 = 0)
          UNION SELECT doc_id, 'drums' FROM r WHERE error = ''),
    g AS (SELECT doc_id, string_agg(DISTINCT item, '|' ORDER BY item) AS items FROM i GROUP BY doc_id)
    SELECT d.doc_id, coalesce(items, '') AS items,
           CASE WHEN error <> '' THEN 0 WHEN len % 5 = 0 THEN 2 ELSE 3 END::INTEGER AS num_runs
    FROM d LEFT JOIN g ON g.doc_id = d.doc_id""",
)
def predict_runs(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text", F.expr(_UPSTREAM).alias("error"))
    predictor = stages.Predictor(rule_model.run_answers)
    answered = stages.predict_runs(rows, "responses", predictor, F.col("text"), 3)
    out = ensemble.ensemble(answered, "responses", "doc_id")
    return out.select("doc_id", F.array_join("ensembled_instruments", "|").alias("items"), "num_runs")


@query(
    "bulk_annotation",
    f"""
    WITH {_LAYER_SQL},
    v AS (SELECT *, 'doc_' || doc_id || CASE doc_id % 7 WHEN 3 THEN '' WHEN 5 THEN '.pdf' ELSE '.mp3' END AS filename FROM r),
    ok AS (SELECT * FROM v WHERE doc_id % 7 NOT IN (3, 5)),
    bad AS (SELECT lang, count(*) AS rejected, count(*) FILTER (doc_id % 7 = 3) AS no_extension FROM v WHERE doc_id % 7 IN (3, 5) GROUP BY lang),
    good AS (SELECT lang, count(*) AS total, count(*) FILTER (error = '') AS successful, count(*) FILTER (error <> '') AS failed,
           CAST(sum(len(CASE WHEN instruments = '' THEN [] ELSE string_split(instruments, '|') END)) AS BIGINT) AS instruments,
           bit_xor(CAST('0x' || substr(sha256('job|' || doc_id), 1, 12) AS BIGINT)) AS job_ids,
           bit_xor(CAST('0x' || substr(sha256(text), 1, 12) AS BIGINT)) AS song_hashes
    FROM ok GROUP BY lang)
    SELECT coalesce(good.lang, bad.lang) AS lang, coalesce(total, 0) AS total, coalesce(successful, 0) AS successful,
           coalesce(failed, 0) AS failed, coalesce(instruments, 0) AS instruments, job_ids, song_hashes,
           coalesce(rejected, 0) AS rejected, coalesce(no_extension, 0) AS no_extension
    FROM good FULL JOIN bad ON good.lang IS NOT DISTINCT FROM bad.lang""",
)
def bulk_annotation(spark, folder):
    """Jobs, validation, prediction, parsing and counts in one plan; rejected files are counted with the others."""
    docs = table(spark, folder, "documents").withColumn(
        "filename",
        F.expr("'doc_' || doc_id || CASE doc_id % 7 WHEN 3 THEN '' WHEN 5 THEN '.pdf' ELSE '.mp3' END"),
    )
    accepted, rejected = uploads.split_uploads(docs, "filename", "n_chars")
    jobs = results.make_jobs(accepted, F.col("text"), F.col("filename"), key=[F.col("doc_id")])
    rows = annotated(jobs, 32, "row", "lang", "job_id", "song_hash")
    counts = rows.select("lang", "instruments", "job_id", "song_hash", "error").unionByName(
        rejected.select("lang", "detail"), allowMissingColumns=True).groupBy("lang").agg(
        F.sum(F.size("instruments")).alias("instruments"),
        # checksums over all ids and hashes
        F.bit_xor(F.conv(F.substr("job_id", F.lit(5)), 16, 10).cast("bigint")).alias("job_ids"),
        F.bit_xor(F.conv(F.substr("song_hash", F.lit(1), F.lit(12)), 16, 10).cast("bigint")).alias("song_hashes"),
        F.count("job_id").alias("total"),
        F.count_if(F.col("error") == "").alias("successful"),
        F.count_if(F.col("error") != "").alias("failed"),
        F.count("detail").alias("rejected"),
        F.count_if(F.col("detail").startswith("File must have")).alias("no_extension"),
    )
    return counts.select(
        "lang", "total", "successful", "failed", F.coalesce("instruments", F.lit(0)).alias("instruments"),
        "job_ids", "song_hashes", "rejected", "no_extension")
