"""Bulk annotation: a folder of media files to result tables, failures and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timbrel.functions.errors import waveform_error
from timbrel.functions.names import ID_DIGITS, basename
from timbrel.functions.parse import parse_layers
from timbrel.functions.text import fill_template
from timbrel.operators.media import Decoder, decode_media
from timbrel.operators.results import ID_COLUMNS, layered_result, make_jobs, split_errors
from timbrel.operators.stages import Predictor, annotate_steps
from timbrel.operators.uploads import split_uploads
from timbrel.sinks.tables import write_report, write_results_csv
from timbrel.sources.media import empty_media, scan_media


def intake(files: DataFrame, digits: int = ID_DIGITS, **limits) -> tuple[DataFrame, DataFrame]:
    """(jobs, quarantine) of a binary-file frame; the content of oversized files is not read.

    ``limits`` are those of :func:`split_uploads`: ``allowed`` extensions and ``max_bytes``.
    """
    named = files.withColumn("filename", basename(F.col("path")))
    accepted, rejected = split_uploads(named, "filename", "length", **limits)
    jobs = make_jobs(accepted, F.col("content"), F.col("filename"), key=[F.col("path")], digits=digits)
    quarantine = rejected.select("path", "length", "code", "detail")
    return jobs.select(*ID_COLUMNS, "created_at", F.col("content").alias("audio_bytes")), quarantine


def annotate_jobs(
    jobs: DataFrame,
    planner: Predictor,
    responder: Predictor,
    step_2: str | Callable[[Column, Column], Column],
    target_rate: int = 16000,
    decoders: dict[str, Decoder] | None = None,
    step_1: Callable[[Column], Column] | None = None,
    parse: Callable[[Column], Column] = parse_layers,
    envelope: Callable[..., DataFrame] = layered_result,
    width: int | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Jobs to layered results: decode, plan, answer, parse. Works on batches and streams.

    ``step_2`` is the template of the second prompt with ``{plan}``, or makes
    the second input of waveform and plan, such as a chat with both; ``step_1``
    makes the first input of the waveform, which goes as it is without.
    ``envelope`` is that of :func:`annotate`. ``width`` sets how many tasks run the models, where that differs from decoding; only
    then do waveforms travel through an exchange. ``profile`` gives these tasks
    resources of their own.
    """
    decoded = decode_media(jobs, target_rate=target_rate, decoders=decoders)
    decoded = decoded.withColumn("error", waveform_error(F.col("waveform_bytes"), F.col("error")))
    if width:
        decoded = decoded.repartition(width)
    audio = F.col("waveform_bytes")

    def second(answers: dict[str, Column]) -> Column:
        plan = answers["plan"]
        return fill_template(step_2, plan=plan) if isinstance(step_2, str) else step_2(audio, plan)

    answered = annotate_steps(
        decoded,
        [("plan", planner, lambda _: step_1(audio) if step_1 else audio), ("final", responder, second)],
        profile=profile,
    )
    return envelope(answered, parse(F.col("final")), F.col("plan"), F.col("error"), *ID_COLUMNS)


def annotate_folder(
    spark: SparkSession,
    folder: str,
    out: str,
    planner: Predictor,
    responder: Predictor,
    step_2: str | Callable[[Column, Column], Column],
    load_seconds: float = 0.0,
    run_seconds: float = 0.0,
    include_empty: bool = True,
    **options,
) -> dict[str, str]:
    """Run the whole job; returns the paths written.

    The model runs once: its results are written as a table, and the CSV, the
    failure table and the report are made from that table. Zero-length files
    become failures, too, unless ``include_empty`` is off, as it has to be
    where the folder lies on a file system that Arrow cannot list.
    """
    files = scan_media(spark, folder)
    if include_empty:
        files = files.unionByName(empty_media(spark, folder))
    jobs, quarantine = intake(files)
    paths = {n: f"{out}/{n}" for n in ("results", "quarantine", "failures", "csv", "report")}
    annotate_jobs(jobs, planner, responder, step_2, **options).write.mode("overwrite").parquet(paths["results"])
    quarantine.write.mode("overwrite").parquet(paths["quarantine"])
    results = spark.read.parquet(paths["results"])
    good, bad = split_errors(results)
    bad.write.mode("overwrite").parquet(paths["failures"])
    write_results_csv(good, paths["csv"])
    write_report(results, load_seconds, run_seconds, "job_id", paths["report"])
    return paths
