"""Exports and reports, written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from timbrel.plans.catalog_queries import _CATALOG_SQL, _catalog
from timbrel.plans.parse_queries import _STRICT_SQL, _parsed
from timbrel.plans.registry import query
from timbrel.session import run_dir
from timbrel.sinks import tables

_CSV_SQL = f"""
    WITH {_STRICT_SQL}
    SELECT p_partkey, to_json(background)::VARCHAR AS background, to_json(middle_ground)::VARCHAR AS middle_ground,
           to_json(foreground)::VARCHAR AS foreground,
           to_json(list_sort(list_distinct(background || middle_ground || foreground)))::VARCHAR AS instruments
    FROM layers"""


@query("results_csv_ready", _CSV_SQL)
def results_csv_ready(spark, folder):
    return tables.csv_ready(_parsed(spark, folder))


@query("results_csv", _CSV_SQL)
def results_csv(spark, folder):
    ready = _parsed(spark, folder)
    path = run_dir(spark, "results-csv")
    tables.write_results_csv(ready, path)
    schema = tables.csv_ready(ready).schema
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    "catalog_export",
    f"""
    WITH {_CATALOG_SQL}, f AS (SELECT unnest(['csv', 'json']) AS format)
    SELECT format, target_genre, genre, track_id, position, popularity, duration_ms FROM catalog, f""",
)
def catalog_export(spark, folder):
    rows = _catalog(spark, folder).select("target_genre", "genre", "track_id", "position", "popularity", "duration_ms")
    csv_path, json_path = tables.export_catalog(rows, run_dir(spark, "catalog"))
    from_csv = spark.read.schema(rows.schema).option("header", True).csv(csv_path)
    from_json = spark.read.schema(rows.schema).json(json_path)
    return from_csv.withColumn("format", F.lit("csv")).unionByName(from_json.withColumn("format", F.lit("json")))


_ERROR = "CASE WHEN p_partkey % 5 = 3 THEN 'Error: file not found' ELSE '' END"


@query(
    "bench_report",
    f"""
    WITH {_STRICT_SQL},
    r AS (SELECT *, 'part_' || p_partkey AS filename, {_ERROR} AS error FROM layers)
    SELECT 0 AS part, CAST(NULL AS BIGINT) AS position,
           '{{"summary": {{"total_files":' || count(*) || ',"successful":' || count(*) FILTER (error = '') || ',"failed":'
           || count(*) FILTER (error <> '') || ',"model_load_time_sec":1.5,"inference_time_sec":64.0,"throughput_files_per_sec":'
           || CAST(count(*) FILTER (error = '') / 64.0::DOUBLE AS VARCHAR) || '}}, "results": [' AS line FROM r
    UNION ALL
    SELECT 1, p_partkey, CASE WHEN p_partkey = (SELECT min(p_partkey) FROM part) THEN '' ELSE ',' END
           || '{{"filename":"' || filename || '","background":' || to_json(background) || ',"middle_ground":'
           || to_json(middle_ground) || ',"foreground":' || to_json(foreground) || ',"error":"' || error || '"}}' FROM r
    UNION ALL SELECT 2, NULL, ']}}'""",
)
def bench_report(spark, folder):
    rows = _parsed(spark, folder).withColumns(
        {"filename": F.expr("'part_' || p_partkey"), "error": F.expr(_ERROR)}
    )
    return tables.report_lines(rows, 1.5, 64.0, "p_partkey")
