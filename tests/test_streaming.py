"""Streams equal batches, late files are processed, sinks survive repeats."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_media import sine, wav

from timbrel.operators import stages
from timbrel.plans import bulk
from timbrel.sinks import tables
from timbrel.sources import media as sources
from timbrel.streaming import runs

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("error", T.StringType())])


def _wave(spark, path, start, n):
    rows = spark.range(start, start + n).select("id", F.when(F.col("id") % 5 == 0, "Error: x").otherwise("").alias("error"))
    rows.coalesce(1).write.mode("append").parquet(path)


def test_three_waves(spark, tmp_path):
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    _wave(spark, inbox, 0, 5)
    query = runs.start_table(sources.stream_table(spark, inbox, SCHEMA), out, every="0 seconds")
    try:
        for i in (1, 2):
            query.processAllAvailable()
            assert spark.read.parquet(f"{out}/table").count() == 5 * i
            _wave(spark, inbox, 5 * i, 5)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.id for r in spark.read.parquet(f"{out}/table").collect()) == list(range(15))


def test_drain_resumes_where_it_stopped(spark, tmp_path):
    inbox, out = f"{tmp_path}/inbox", f"{tmp_path}/out"
    _wave(spark, inbox, 0, 4)
    assert runs.drain(sources.stream_table(spark, inbox, SCHEMA, max_files=1), out).count() == 4
    _wave(spark, inbox, 4, 3)
    assert runs.drain(sources.stream_table(spark, inbox, SCHEMA), out).count() == 7
    assert runs.drain(sources.stream_table(spark, inbox, SCHEMA), out).count() == 7


def test_batches_are_bounded(spark, tmp_path):
    for i in range(5):
        _wave(spark, f"{tmp_path}/inbox", i * 10, 10)
    sizes = []
    stream = sources.stream_table(spark, f"{tmp_path}/inbox", SCHEMA, max_files=2)
    query = (
        stream.writeStream.foreachBatch(lambda df, _: sizes.append(df.count()))
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(sizes) == [10, 20, 20]


def test_bounded_read_while_the_producer_writes(spark, tmp_path):
    inbox = f"{tmp_path}/inbox"
    _wave(spark, inbox, 0, 4)
    stop = threading.Event()

    def produce():
        n = 1
        while not stop.is_set():
            _wave(spark, inbox, n * 4, 4)
            n += 1
            time.sleep(0.2)

    producer = threading.Thread(target=produce)
    producer.start()
    got = []
    try:
        stream = sources.stream_table(spark, inbox, SCHEMA, max_files=1)
        seen = runs.read_until(stream, lambda df, _: got.extend(r.id for r in df.collect()), 10, f"{tmp_path}/cp", "0 seconds")
    finally:
        stop.set()
        producer.join()
    assert seen == len(got) == 12


def test_split_sink_and_a_repeated_batch(spark, tmp_path):
    _wave(spark, f"{tmp_path}/inbox", 0, 10)
    path, done = f"{tmp_path}/out", []
    stream = sources.stream_table(spark, f"{tmp_path}/inbox", SCHEMA)
    runs.start_split(stream, path, on_success=lambda df, i: done.append(df.count())).awaitTermination()
    # the same micro-batch once more, as after a lost driver
    batch = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/inbox")
    tables.split_sink(f"{path}/table")(batch, 0)
    good, bad = tables.read_split(spark, f"{path}/table")
    assert (good.count(), bad.count(), done) == (8, 2, [8])
    assert good.columns == bad.columns == ["id", "error"]


def test_progress_listener(spark, tmp_path):
    for i in range(3):
        _wave(spark, f"{tmp_path}/inbox", i * 6, 6)
    listener = runs.ProgressListener()
    spark.streams.addListener(listener)
    try:
        stream = sources.stream_table(spark, f"{tmp_path}/inbox", SCHEMA, max_files=1)
        query = runs.start_table(stream, f"{tmp_path}/out", every="0 seconds")
        query.processAllAvailable()
        query.stop()
        for _ in range(100):
            if listener.total == 18:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.status["rows"] == 18 and listener.status["healthy"]
    assert [n for _, n, _ in listener.triggers if n] == [6, 6, 6]
    assert listener.status["sources"] == [{}]


def test_media_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "media"
    (folder / "deep").mkdir(parents=True)
    for i in range(3):
        (folder / f"s{i}.wav").write_bytes(wav([sine(8000, 0.1)], 8000))
    (folder / "deep" / "t.wav").write_bytes(b"broken")
    (folder / "skip.txt").write_bytes(b"no media")

    def job(files):
        jobs, _ = bulk.intake(files)
        plan = stages.Predictor(lambda waves: [f"{len(w)} bytes" for w in waves])
        final = stages.Predictor(lambda prompts: [f'{{"background": ["{p}"]}}' for p in prompts])
        return bulk.annotate_jobs(jobs, plan, final, "plan: {plan}").drop("detected_at")

    batch = job(sources.scan_media(spark, str(folder)))
    stream = job(sources.stream_media(spark, str(folder), max_files=2))
    got = runs.drain(stream, f"{tmp_path}/out").collect()
    assert sorted(map(str, got)) == sorted(map(str, batch.collect()))
    by_name = {r.filename: r for r in got}
    assert set(by_name) == {"s0.wav", "s1.wav", "s2.wav", "t.wav"}
    assert by_name["s0.wav"].planning_response == "6400 bytes"
    assert by_name["s0.wav"].instruments == ["plan: 6400 bytes"]
    assert by_name["t.wav"].error.startswith("Preprocessing failed") and by_name["t.wav"].instruments == []


def test_flat_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b.wav", "a.mp3", "sub/c.flac", "d.txt"):
        (tmp_path / name).write_bytes(b"12345")
    listed = sources.list_media(spark, str(tmp_path))
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in listed.collect()] == [("a.mp3", 5), ("b.wav", 5), ("c.flac", 5)]
    flat = sources.list_media(spark, str(tmp_path), ("mp3",), recursive=False)
    assert [r.path.rsplit("/", 1)[1] for r in flat.collect()] == ["a.mp3"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_empty_files_are_found(spark, tmp_path):
    deep = tmp_path / "d é+%" / "x y"
    deep.mkdir(parents=True)
    for name, data in (("a b+c%.wav", b""), ("é.mp3", b""), ("full one.wav", b"x"), ("skip.txt", b"")):
        (tmp_path / name).write_bytes(data)
        (deep / name).write_bytes(data)
    found = sources.empty_media(spark, str(tmp_path)).collect()
    assert {r.path for r in found} == {f"file:{d}/{n}" for d in (tmp_path, deep) for n in ("a b+c%.wav", "é.mp3")}
    assert all(r.length == 0 and bytes(r.content) == b"" for r in found)
    assert sources.empty_media(spark, f"file://{tmp_path}", recursive=False).count() == 2
    scanned = {r.path for r in sources.list_media(spark, str(tmp_path)).collect()}
    assert scanned == {f"file:{d}/full one.wav" for d in (tmp_path, deep)}


def test_items_with_broken_lines(spark, tmp_path):
    (tmp_path / "items.json").write_text(json.dumps({"id": 1, "error": "x"}) + "\n{broken\n")
    good, bad = sources.read_items(spark, str(tmp_path / "items.json"), SCHEMA)
    assert [r.id for r in good.collect()] == [1]
    assert [r.value for r in bad.collect()] == ["{broken"]


def test_stage_on_a_stream(spark, tmp_path):
    _wave(spark, f"{tmp_path}/inbox", 0, 10)
    stage = stages.Stage("double", lambda rows: [{**r, "id": r["id"] * 2} for r in rows], SCHEMA, batch_size=3)
    stream = stages.map_stage(sources.stream_table(spark, f"{tmp_path}/inbox", SCHEMA), stage)
    assert sorted(r.id for r in runs.drain(stream, f"{tmp_path}/out").collect()) == list(range(0, 20, 2))


@pytest.mark.parametrize("n", [1, 3])
def test_result_iterator(spark, n):
    batches = list(tables.iterate_results(spark.range(7), n))
    assert [len(b) for b in batches] == {1: [1] * 7, 3: [3, 3, 1]}[n]


def test_bounded_reads_resume_without_loss(spark, tmp_path):
    """Every row comes exactly once over runs on one checkpoint, also when the sink is slow."""
    import time

    spark.range(400).repartition(40).write.parquet(f"{tmp_path}/in")
    got = []

    def slow(batch, _):
        time.sleep(0.1)
        got.extend(r.id for r in batch.collect())

    def stream():
        return spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 4).parquet(f"{tmp_path}/in")

    for bound in (10, 90, 300):
        if len(got) < 400:
            want = min(bound, 400 - len(got))
            assert runs.read_until(stream(), slow, want, f"{tmp_path}/cp", "0 seconds") >= want
    assert sorted(got) == sorted(set(got))
    while len(got) < 400:
        runs.read_until(stream(), slow, 1, f"{tmp_path}/cp", "0 seconds")
    assert sorted(got) == list(range(400))
