import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from timbrel.operators import positions, results, settled, stages, uploads


@pytest.mark.parametrize("ranges", [1, 2, 7, 64, 300])
def test_positions_equal_a_sort(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "b", None, "hot"]), rng.randrange(10**6), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n long, i int").repartition(5)
    got = positions.with_position(df, "k", "n", "i", ranges=ranges).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert sorted((r.position, (r.k, r.n, r.i)) for r in got) == list(enumerate(want))


def test_one_value_in_most_rows_is_split(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 8, 5).otherwise(F.col("id") % 3).alias("k"), "id")
    order = ("k", "id")
    bounds = positions._range_bounds(df, order, 8)
    assert len(bounds[0]) == 2
    sizes = df.groupBy(positions._range_of(df, order, bounds).alias("r")).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 8000
    last = positions.with_position(df, *order).agg(F.max("position"), F.count_distinct("position")).first()
    assert tuple(last) == (19999, 20000)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "a int")
    assert positions.with_position(empty, "a").count() == 0
    assert positions.with_position(spark.range(1), "id").first().position == 0


def test_batches_and_nth(spark):
    df = spark.range(1001).withColumn("name", F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 5, "0")))
    sizes = positions.with_batch_id(df, 4, "name").groupBy("batch_id").count().collect()
    assert len(sizes) == 251 and sorted(r["count"] for r in sizes) == [1] + [4] * 250
    assert sorted(r.id for r in positions.every_nth(df, 100, "name").collect()) == list(range(0, 1001, 100))


def test_top_per_group_beyond_the_limit(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"), ((F.col("id") * 7919) % 9001).alias("v"))
    got = positions.top_per_group(df, 1500, ["g"], "v")
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.v)
    for g, values in want.items():
        assert sorted(r.v for r in got.filter(F.col("g") == g).collect()) == sorted(values)[:1500]


def test_first_and_skip(spark):
    df = spark.createDataFrame([("x", 3), ("y", 1), ("x", 2)], "name string, pos int")
    assert positions.find_first(df, "name", "x", "pos").first().pos == 2
    assert positions.find_first(df, "name", "q", "pos").count() == 0
    assert sorted(r.pos for r in positions.skip_first(df, 1, "pos", "pos").collect()) == [2, 3]
    assert [r.pos for r in positions.first_rows(df, 2, "pos").collect()] == [1, 2]
    assert sorted(r.pos for r in positions.first_per_key(df, "name", "pos").collect()) == [1, 2]


def test_skip_first_keeps_other_rows_of_a_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 0)], "k string, at int")
    left = positions.skip_first(df, 2, "k", "at").collect()
    assert sorted((r.k, r.at) for r in left) == [("a", 2), ("b", 3), ("c", 4)]


def _answered(spark, folder, n=600):
    """Rows with the answer of a model that draws it, and the number of rows it was asked for."""

    def draw(texts):
        Path(folder, uuid.uuid4().hex).write_text(str(len(texts)))
        return [str(random.SystemRandom().random()) for _ in texts]

    rows = spark.range(0, n, 1, 4).select("id", F.col("id").cast("string").alias("t"), F.lit("").alias("error"))
    told = stages.predict(rows, "a", stages.Predictor(draw), [F.col("t")])
    return told.select("id", F.col("a.text").cast("double").alias("x")), lambda: sum(int(p.read_text()) for p in Path(folder).iterdir())


def test_positions_by_drawn_answers(spark, tmp_path):
    rows, asked = _answered(spark, tmp_path)
    placed = positions.with_position(rows, "x", "id").collect()
    assert sorted(r.position for r in placed) == list(range(600)) and asked() == 600
    assert [r.x for r in sorted(placed, key=lambda r: r.position)] == sorted(r.x for r in placed)


@pytest.mark.parametrize("use", ["skip", "prefix"])
def test_a_model_before_a_spread_join_is_asked_once(spark, tmp_path, use):
    rows, asked = _answered(spark, tmp_path)
    if use == "skip":
        assert results.skip_existing(rows, spark.range(0, 600, 2), "id").count() == 300
    else:
        by = rows.withColumn("request", F.col("id") % 3)
        assert uploads.accept_prefix(by, "request", "id", F.col("x") < 2).filter("accepted").count() == 600
    assert asked() == 600


def test_a_selection_from_a_table_is_not_written(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    chosen = orders.filter("o_totalprice > 10").select("o_orderkey", (F.col("o_custkey") + 1).alias("c"))
    assert settled.settled(chosen) is chosen
    for other in (chosen.withColumn("r", F.rand()), chosen.distinct(), chosen.join(orders.select("o_orderkey"), "o_orderkey")):
        again = settled.settled(other)
        assert again is not other and again.schema.names == other.schema.names and again.count() == again.distinct().count()
