import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.functions import chat
from timbrel.operators import ensemble, metrics, stages

OUT = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("error", T.StringType())])


def sizes(rows):
    return [{"id": r["id"], "n": len(rows), "error": ""} for r in rows]


def test_exact_batch_sizes(spark):
    stage = stages.Stage("sizes", sizes, OUT, batch_size=30)
    got = stages.map_stage(spark.range(100).coalesce(1), stage).collect()
    assert [r.n for r in got] == [30] * 90 + [10] * 10
    assert [r.id for r in got] == list(range(100))


def test_batches_larger_than_arrow_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        got = stages.map_stage(spark.range(50).coalesce(1), stages.Stage("s", sizes, OUT, batch_size=20)).collect()
        assert [r.n for r in got] == [20] * 40 + [10] * 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_setup_result_is_an_argument_and_none_is_not(spark):
    given = stages.Stage("g", lambda rows, k: [{"id": r["id"] * k, "n": 0, "error": ""} for r in rows], OUT, setup=lambda: 3)
    plain = stages.Stage("p", sizes, OUT, setup=lambda: None)
    assert sorted(r.id for r in stages.map_stage(spark.range(4), given).collect()) == [0, 3, 6, 9]
    assert stages.map_stage(spark.range(4), plain).count() == 4
    assert given.process_one({"id": 5}) == {"id": 15, "n": 0, "error": ""}
    assert stages.Stage("e", lambda rows: [], OUT).process_one({"id": 1}) is None


def test_teardown_runs_after_each_task(spark, tmp_path):
    folder = str(tmp_path)

    def close(handle):
        import uuid
        from pathlib import Path

        Path(handle, uuid.uuid4().hex).touch()

    stage = stages.Stage("t", lambda rows, _: sizes(rows), OUT, setup=lambda: folder, teardown=close)
    assert stages.map_stage(spark.range(10).repartition(3), stage).count() == 10
    assert len(list(tmp_path.iterdir())) == 3


def test_missing_and_null_fields_keep_their_types(spark):
    stage = stages.Stage("m", lambda rows: [{"id": rows[0]["id"]}, {"n": 2, "extra": 1}], OUT)
    got = stages.map_stage(spark.range(1), stage).collect()
    assert [tuple(r) for r in got] == [(0, None, None), (None, 2, None)]


def failing(rows):
    if any(r["id"] % 10 == 3 for r in rows):
        raise ValueError("three")
    return sizes(rows)


def test_failure_policies(spark):
    df = spark.range(40).coalesce(1)
    row = stages.Stage("r", failing, OUT, batch_size=5, on_error="row", error_row=lambda r, m: {"id": r["id"], "error": m})
    got = stages.map_stage(df, row).collect()
    assert len(got) == 40 and sorted(r.id for r in got if r.error) == [3, 13, 23, 33]
    skip = stages.Stage("s", failing, OUT, batch_size=5, on_error="skip")
    assert sorted(r.id for r in stages.map_stage(df, skip).collect()) == [i for i in range(40) if i % 10 >= 5]
    with pytest.raises(Exception, match="three"):
        stages.map_stage(df, stages.Stage("x", failing, OUT, batch_size=5)).collect()
    with pytest.raises(ValueError, match="error_row"):
        stages.map_stage(df, stages.Stage("x", failing, OUT, on_error="row"))


def test_chain_and_width(spark):
    wide = stages.Stage("w", sizes, OUT, partitions=6)
    got = stages.chain(spark.range(20).coalesce(1), wide, lambda df: df.filter("id > 4"), stages.Stage("l", sizes, OUT))
    assert got.rdd.getNumPartitions() == 6 and got.count() == 15


def answers(texts):
    if any("bad" in t for t in texts):
        raise RuntimeError("no answer")
    return [f'{{"background": ["{t}"]}}' for t in texts]


def _rows(spark):
    return spark.createDataFrame(
        [("a", "x", ""), ("b", "bad y", ""), ("c", "z", "Preprocessing failed: q"), ("d", "w", "nan"), ("e", "v", None)],
        "job_id string, text string, error string",
    ).coalesce(1)


def test_annotate_passes_errors_on(spark):
    got = {r.job_id: r for r in stages.annotate(_rows(spark), stages.Predictor(answers), F.col("text"), "job_id").collect()}
    assert len(got) == 5
    assert got["a"].background == ["x"] and got["a"].error == "" and got["a"].instruments == ["x"]
    assert got["b"].error == "Prediction failed: no answer" and got["b"].background == []
    assert got["c"].error == "Preprocessing failed: q" and got["c"].planning_response == ""
    assert got["d"].background == ["w"] and got["e"].error == ""


def test_annotate_raise_and_skip(spark):
    with pytest.raises(Exception, match="no answer"):
        stages.annotate(_rows(spark), stages.Predictor(answers, on_error="raise"), F.col("text"), "job_id").collect()
    skipped = stages.annotate(_rows(spark), stages.Predictor(answers, batch_size=2, on_error="skip"), F.col("text"), "job_id")
    assert sorted(r.job_id for r in skipped.collect()) == ["c", "d", "e"]


def test_mapped_predictor_gives_the_same_rows(spark, monkeypatch):
    # a local session takes no resource profile, so the mapped form runs without one
    mapped = stages._predict_mapped
    monkeypatch.setattr(stages, "_predict_mapped", lambda *args: mapped(*args[:-1], None))

    def rows(policy, profile):
        predictor = stages.Predictor(answers, batch_size=1, on_error=policy)
        df = stages.predict(_rows(spark), "a", predictor, [F.col("text")], profile=profile)
        return sorted(str((r.job_id, r.a.text, r.a.error, r.error)) for r in df.collect())

    for policy in ("row", "skip"):
        assert rows(policy, "gpu") == rows(policy, None)
    two = stages.Predictor(lambda pairs: [f"{text}-{job}" for text, job in pairs])
    got = stages.predict(_rows(spark), "a", two, [F.col("text"), F.col("job_id")], profile="gpu").collect()
    assert sorted(r.a.text for r in got if r.a.text) == ["bad y-b", "v-e", "w-d", "x-a"]


def test_short_answers_become_errors(spark):
    predictor = stages.Predictor(lambda texts: ["{}"] if len(texts) > 1 else [])
    got = stages.annotate(_rows(spark), predictor, F.col("text"), "job_id").collect()
    assert sum(r.error.startswith("Prediction failed: predictor returned 0") for r in got) == 4
    none = stages.annotate(_rows(spark), stages.Predictor(lambda texts: [None] * len(texts)), F.col("text"), "job_id")
    assert sum(r.error == "Prediction failed: predictor returned no answer" for r in none.collect()) == 4


def test_error_rows_never_reach_the_model(spark):
    seen = stages.predict(_rows(spark), "a", stages.Predictor(lambda texts: [str(len(texts))] * len(texts)), [F.col("text")])
    assert {r.job_id: r.a.text for r in seen.collect()} == {"a": "4", "b": "4", "c": None, "d": "4", "e": "4"}


def test_model_batches_are_filled_across_arrow_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(3000).select("id", F.when(F.col("id") % 4 == 1, "boom").otherwise("").alias("error")).coalesce(1)
        predictor = stages.Predictor(lambda xs: [f"{x} of {len(xs)}" for x in xs], batch_size=100)
        got = stages.predict(df, "a", predictor, [F.col("id").cast("string")]).orderBy("id").collect()
        assert len(got) == 3000
        assert all(r.a.text is None if r.id % 4 == 1 else r.a.text.startswith(f"{r.id} of ") for r in got)
        assert {r.a.text.split(" of ")[1] for r in got if r.a.text} == {"100", "50"}
        assert sum(r.a.batch_rows or 0 for r in got) == 2250
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_chats_are_plain_values(spark):
    df = spark.createDataFrame([(b"12", "hi", ""), (None, "yo", "")], "a binary, t string, error string")
    talk = chat.first_step_chat("sys", None, F.col("a"), F.col("t"))

    def answer(chats):
        return [f"{c[0]['role']} {[p['type'] for p in c[1]['content']]} {c[1]['content'][0]['audio']}" for c in chats]

    got = stages.predict(df, "x", stages.Predictor(answer), [talk]).collect()
    assert [r.x.text for r in got] == ["system ['audio', 'text'] b'12'", "system ['text'] None"]


def test_long_runs_of_failed_rows(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 5000 != 17, "boom").otherwise("").alias("error")).coalesce(1)
    got = stages.predict(df, "a", stages.Predictor(lambda xs: xs), [F.col("id").cast("string")])
    assert sorted(r.id for r in got.filter("a.text = cast(id as string)").collect()) == [17, 5017, 10017, 15017]
    assert got.count() == 20000


def test_timing_is_counted_once_per_batch(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("text"), F.lit("").alias("error")).coalesce(1)
    timed = stages.predict(df, "a", stages.Predictor(lambda t: t, batch_size=4), [F.col("text")])
    r = metrics.stage_stats(timed.select(F.lit("s").alias("stage"), "a.*"), "stage", "batch_ms", "batch_rows").first()
    assert (r.processed_count, r.batch_count) == (10, 3) and r.total_ms > 0
    assert r.ms_per_batch == pytest.approx(r.total_ms / 3) and r.ms_per_row == pytest.approx(r.total_ms / 10)


def test_model_is_set_up_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid
        from pathlib import Path

        Path(folder, f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return "model"

    predictor = stages.Predictor(lambda texts, model: [model] * len(texts), setup=load)
    df = spark.range(80).select(F.col("id").cast("string").alias("t"), F.lit("").alias("error")).repartition(24)
    got = stages.predict(df, "a", predictor, [F.col("t")]).select("a.text").collect()
    assert [r.text for r in got] == ["model"] * 80
    pids = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(pids) == len(set(pids)) < 24


def test_runs_and_agreement(spark):
    def run_answers(pairs):
        if any(run == 2 and text == "b" for text, run in pairs):
            raise ValueError("third run of b")
        return [f"['{text}', 'i{run}', 'x']" for text, run in pairs]

    df = spark.createDataFrame([("a", ""), ("b", ""), ("c", "boom")], "t string, error string")
    rows = stages.predict_runs(df, "responses", stages.Predictor(run_answers), F.col("t"), 3)
    got = {r.t: r for r in ensemble.ensemble(rows, "responses", "t").collect()}
    assert got["a"].ensembled_instruments == ["a", "i0", "i1", "i2", "x"] and got["a"].num_runs == 3
    assert got["b"].ensembled_instruments == ["b", "i0", "i1", "x"] and got["b"].num_runs == 2
    assert got["c"].ensembled_instruments == [] and got["c"].num_runs == 0
    in_row = {r.t: r.a for r in rows.select("t", ensemble.agreement_of(F.col("responses")).alias("a")).collect()}
    assert in_row == {"a": pytest.approx(2 / 3), "b": pytest.approx(2 / 3), "c": None}


def test_agreement_of_empty_and_hot_files(spark):
    few = spark.createDataFrame(
        [("e", "none"), ("e", "[]"), ("m", "['a', 'b']"), ("m", "none"), ("s", "['a', 'a']")], "f string, r string"
    )
    many = spark.range(6000).select(F.lit("hot").alias("f"), F.concat(F.lit("['x', 'i"), F.col("id"), F.lit("']")).alias("r"))
    got = {r.f: tuple(r)[1:] for r in ensemble.agreement(few.union(many), "f", "r").collect()}
    assert got == {"e": (2, 0, 0, None), "m": (2, 0, 2, 0.0), "s": (1, 1, 1, 1.0), "hot": (6000, 1, 2, 0.5)}
    counts = ensemble.ensemble_rows(many, "f", "r").filter("item = 'x'").first()
    assert counts.runs_with_item == 6000


def test_chats(spark):
    df = spark.createDataFrame([(b"12", "hi"), (None, None)], "a binary, t string")
    first = df.select(chat.first_step_chat("sys", "steps", F.col("a"), F.col("t")).alias("c")).collect()
    system, user = first[0].c
    assert system.role == "system" and system.content[0].text == "sys\n\nsteps"
    assert [p.type for p in user.content] == ["audio", "text"] and bytes(user.content[0].audio) == b"12"
    assert first[1].c[1].content == []
    second = df.select(chat.next_step_chat("sys", "A {x} {{}}", F.col("a"), "steps", x=F.col("t")).alias("c")).first()
    assert second.c[0].content[0].text == "sys" and second.c[1].content[1].text == "steps\n\nA hi {}"


def test_failed_runs_are_told(spark):
    def answer(batch):
        if any(run == 1 for _, run in batch):
            raise ValueError("no")
        return [str(x) for x, _ in batch]

    df = spark.createDataFrame([("x", "")], "t string, error string")
    row = stages.predict_runs(df, "responses", stages.Predictor(answer, batch_size=1), F.col("t"), 3).first()
    assert row.responses == ["x", "x"] and "run 1" in row.error and "run 0" not in row.error
