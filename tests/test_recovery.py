"""Tasks that die once: results are whole and nothing is written twice."""

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.operators import positions, stages
from timbrel.sources.media import stream_table
from timbrel.streaming import runs

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("error", T.StringType())])


def dies_once(folder, name):
    """Raises in the first call anywhere, by a marker file all workers see."""
    marker = Path(folder, name)
    try:
        marker.touch(exist_ok=False)
    except FileExistsError:
        return
    raise OSError("worker lost")


def test_stage(spark, tmp_path):
    folder = str(tmp_path)

    def process(rows):
        if any(r["id"] == 77 for r in rows):
            dies_once(folder, "stage")
        return [{"id": r["id"], "error": ""} for r in rows]

    got = stages.map_stage(spark.range(0, 100, 1, 5), stages.Stage("s", process, SCHEMA, batch_size=3)).collect()
    assert sorted(r.id for r in got) == list(range(100)) and (tmp_path / "stage").exists()


def test_predictor_before_a_shuffle(spark, tmp_path):
    folder = str(tmp_path)

    def answers(texts):
        if "55" in texts:
            dies_once(folder, "model")
        return texts

    rows = spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("t"), F.lit("").alias("error"))
    told = stages.predict(rows, "a", stages.Predictor(answers, on_error="raise"), [F.col("t")])
    placed = positions.with_position(told.select(F.col("a.text").cast("int").alias("n")), "n")
    assert sorted((r.n, r.position) for r in placed.collect()) == [(i, i) for i in range(100)]
    assert (tmp_path / "model").exists()


def test_stream_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(0, 60, 1, 3).select("id", F.when(F.col("id") % 4 == 0, "Error: x").otherwise("").alias("error")).write.parquet(
        f"{folder}/in"
    )

    def process(rows):
        dies_once(folder, "stream")
        return rows

    stage = stages.Stage("s", process, SCHEMA)
    stream = stages.map_stage(stream_table(spark, f"{folder}/in", SCHEMA), stage)
    runs.start_split(stream, f"{folder}/out").awaitTermination()
    written = spark.read.parquet(f"{folder}/out/table")
    assert sorted(r.id for r in written.collect()) == list(range(60))
    assert (tmp_path / "stream").exists()


def test_a_stream_that_dies_resumes(spark, tmp_path):
    """The query fails in its second micro-batch; started again, it completes without repeats."""
    folder = str(tmp_path)
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, 1, 1).select("id", F.lit("").alias("error")).write.mode("append").parquet(f"{folder}/in")
    calls = []

    def broken(batch, batch_id):
        calls.append(batch_id)
        if len(calls) == 2:
            raise OSError("sink lost")

    def start():
        stream = stream_table(spark, f"{folder}/in", SCHEMA, max_files=1)
        return runs.start_split(stream, f"{folder}/out", on_success=broken)

    try:
        start().awaitTermination()
    except Exception as e:
        assert "sink lost" in str(e)
    start().awaitTermination()
    written = spark.read.parquet(f"{folder}/out/table")
    assert sorted(r.id for r in written.collect()) == list(range(30))
    assert calls == [0, 1, 1, 2]
