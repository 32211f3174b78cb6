"""Whole jobs, written documents, and the shape of physical plans."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_media import sine, wav

import __spark_entry__ as entry
from timbrel.operators import catalog, metrics, stages
from timbrel.plans import bulk, eval_set
from timbrel.session import run_dir, shared_dir
from timbrel.sinks import tables
from timbrel.sources.media import scan_media

FOLDER = "/root/testdata/sf0.001"


def _text(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_folder_to_tables(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(4):
        (folder / f"s{i}.wav").write_bytes(wav([sine(16000, 0.1)], 16000))
    (folder / "bad.wav").write_bytes(b"")
    (folder / "song.mp3").write_bytes(b"x")
    paths = bulk.annotate_folder(
        spark,
        str(folder),
        str(tmp_path / "out"),
        stages.Predictor(lambda waves: ["low"] * len(waves)),
        stages.Predictor(lambda prompts: ['{"background": ["kick", "a, \\"b\\""], "foreground": ["kick"]}'] * len(prompts)),
        "Plan: {plan}",
        load_seconds=2.0,
        run_seconds=4.0,
        width=3,
    )
    document = json.loads(_text(paths["report"]))
    assert document["summary"] == {
        "total_files": 6, "successful": 4, "failed": 2, "model_load_time_sec": 2.0,
        "inference_time_sec": 4.0, "throughput_files_per_sec": 1.0,
    }
    assert len(document["results"]) == 6
    assert sum(r["background"] == ["kick", 'a, "b"'] for r in document["results"]) == 4
    assert spark.read.parquet(paths["failures"]).count() == 2
    cells = spark.read.option("header", True).option("escape", '"').csv(paths["csv"]).collect()
    assert len(cells) == 4 and json.loads(cells[0].instruments) == ["kick", 'a, "b"']
    assert spark.read.parquet(paths["quarantine"]).count() == 0


def test_empty_report_is_a_document(spark, tmp_path):
    rows = spark.createDataFrame(
        [], "id int, filename string, background array<string>, middle_ground array<string>, foreground array<string>, error string"
    )
    tables.write_report(rows, 0, 0, "id", str(tmp_path / "r"))
    document = json.loads(_text(tmp_path / "r"))
    assert document["results"] == [] and document["summary"]["throughput_files_per_sec"] == 0


def _payload(genre, ids, nested):
    items = [
        {
            "id": i, "name": f"n{i}", "artists": [{"name": "A"}, {"name": genre}], "album": {"name": "al"},
            "popularity": 10, "duration_ms": 90000, **({"preview_url": "u"} if i.endswith("0") else {}),
        }
        for i in ids
    ]
    return genre, 0, json.dumps({"tracks": {"items": items}} if nested else {"tracks": items})


def test_eval_set(spark, tmp_path):
    available = spark.createDataFrame([("rock", 0), ("hip-hop", 1), ("jazz", 2)], "name string, pos int")
    targets = spark.createDataFrame([("Jazz", 0), ("hiphop", 1), ("rock", 2), ("zzz", 3)], "target string, genre_pos int")
    searches = spark.createDataFrame(
        [_payload("rock", ["r0", "s1", "r2"], True), _payload("jazz", ["s1"], True), _payload("hip-hop", [], True)],
        "genre string, page int, payload string",
    )
    more = spark.createDataFrame(
        [("jazz", 1, _payload("jazz", ["j2", "j3"], False)[2]), _payload("jazz", ["j0", "j1"], False), _payload("hip-hop", ["j0", "h1"], False), _payload("rock", ["r9"], False)],
        "genre string, page int, payload string",
    )
    built = eval_set.build_eval_set(searches, more, targets, available, n=3)
    got = {(r.target_genre, r.track_id) for r in built.collect()}
    assert got == {("Jazz", "s1"), ("Jazz", "j0"), ("Jazz", "j1"), ("hiphop", "h1"), ("rock", "r0"), ("rock", "r2")}
    first = built.filter("track_id = 'r0'").first()
    assert (first.artists, first.album, first.preview_url) == ("A, rock", "al", "u")
    summary, totals = eval_set.export_eval_set(built, str(tmp_path))
    assert tuple(totals.first()) == (6, 3)
    assert {r.genre: tuple(r)[1:] for r in summary.collect()}["jazz"] == (3, 10.0, 1.5)


def test_catalog_with_one_track_in_most_rows(spark):
    rows = spark.range(20000).select(
        F.concat(F.lit("g"), F.col("id") % 5).alias("genre"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("track_id"),
        F.lit(0).alias("page"),
        F.col("id").alias("position"),
    )
    genres = spark.createDataFrame([(f"g{i}", f"t{i}", i) for i in range(5)], "genre string, target_genre string, genre_pos int")
    built = catalog.build_catalog(rows, rows.limit(0), genres, n=30).collect()
    assert sum(r.track_id == "hot" for r in built) == 1
    assert len({r.track_id for r in built}) == len(built)


def test_metrics_without_time(spark):
    none = spark.createDataFrame([], "batch int, ms double, error string")
    assert tuple(metrics.throughput(none, "batch", "ms").first()) == (0, 0.0, 0.0, 0.0)
    log = spark.createDataFrame([(1.0, "SUBMIT"), (2.0, "RESULT")], "t double, e string")
    r = metrics.streaming_proof(log, "t", "e").first()
    assert (r.first_result, r.producer_done, r.streaming) == (2.0, None, False)


def test_status_rules(spark):
    df = spark.createDataFrame(
        [(False, "n", 1, ""), (True, "", 1, ""), (True, "n", 0, ""), (True, "n", 1, "boom"), (True, "n", 2, None), (None, None, None, None)],
        "found boolean, name string, hits int, error string",
    )
    outcome = metrics.intake_status(F.col("found"), F.col("name"), F.col("hits"), F.col("error"))
    got = [tuple(r) for r in df.select(outcome.alias("o")).select("o.*").collect()]
    assert got == [
        ("skipped", "no_track"), ("unknown", "no_name"), ("skipped", "no_results"), ("error", "boom"),
        ("downloaded", ""), ("skipped", "no_track"),
    ]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert run_dir(spark, "x").startswith(shared_dir(spark)) and run_dir(spark, "x") != run_dir(spark, "x")


BATCH = [n for n in entry.queries() if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_physical_plan(spark, name):
    """No pairing of all rows, no row-at-a-time Python, windows only over groups or reduced rows."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert banned not in plan, banned
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "Aggregate" in below or "Project" in below and "Aggregate" in lines[i + 2], below


@pytest.mark.parametrize("name", ["supplement_union", "sample_per_status", "catalog_build"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_oversized_files_are_not_read(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(b"x")
    jobs, quarantine = bulk.intake(scan_media(spark, str(tmp_path)))
    plan = jobs._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,104857600)" in plan
    assert "content" not in quarantine._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["error_counts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
    plan = entry.queries()["find_first"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan
