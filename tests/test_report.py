import json

from timbrel.sinks.tables import write_report


def _document(spark, tmp_path, rows, name):
    kind = "filename string, background array<string>, middle_ground array<string>, foreground array<string>, error string, id int"
    write_report(spark.createDataFrame(rows, kind), 1.0, 2.0, "id", f"{tmp_path}/{name}")
    parts = sorted((tmp_path / name).glob("part-*"))
    return json.loads("".join(p.read_text() for p in parts))


def test_report_with_repeated_and_null_keys(spark, tmp_path):
    one = ("f", ["a"], [], [], "")
    for n, ids in enumerate(([1, 1, 2], [None, None, 3], [None, 1, 1], [7], [])):
        found = _document(spark, tmp_path, [(*one, i) for i in ids], f"r{n}")
        assert len(found["results"]) == found["summary"]["total_files"] == len(ids)


def test_report_computes_its_input_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from timbrel.operators import positions

    def counted():
        calls = spark.sparkContext.accumulator(0)

        @F.udf("string")
        def answer(i):
            calls.add(1)
            return f"file {i}"

        empty = F.array().cast("array<string>")
        return calls, spark.range(40).select(
            F.col("id").cast("int"), answer("id").alias("filename"), F.lit("").alias("error"),
            *[empty.alias(n) for n in ("background", "middle_ground", "foreground")])

    calls, rows = counted()
    write_report(rows, 1.0, 2.0, "id", f"{tmp_path}/once")
    assert calls.value == 40
    parts = sorted((tmp_path / "once").glob("part-*"))
    assert len(json.loads("".join(p.read_text() for p in parts))["results"]) == 40

    calls, rows = counted()
    assert positions.skip_first(rows.select("filename", "id"), 5, "filename", "id").count() == 35
    assert calls.value == 40
