from pyspark.sql import functions as F

from timbrel.functions import names
from timbrel.operators import results, uploads

MIB = 1024 * 1024


def test_validation_order_and_limits(spark):
    cases = [
        ("a.mp3", 1024, 200), ("A.FLAC", 1024, 200), ("noext", 1024, 400), ("a.txt", 200 * MIB, 400),
        ("a.wav", 100 * MIB, 200), ("a.wav", 100 * MIB + 1, 413), ("x.", 1, 400), (".ogg", 1, 200),
    ]
    df = spark.createDataFrame(cases, "name string, size long, want int")
    rows = df.select("*", uploads.validate_upload(F.col("name"), F.col("size")).alias("v")).collect()
    assert [r.v.code for r in rows] == [r.want for r in rows]
    assert [r.v.ok for r in rows] == [r.want == 200 for r in rows]
    good, bad = uploads.split_uploads(df, "name", "size")
    assert (good.count(), bad.count()) == (4, 4)
    good, bad = uploads.split_uploads(df, "name", "size", allowed=("txt", "wav"), max_bytes=150 * MIB)
    assert sorted(r.size for r in good.collect()) == [100 * MIB, 100 * MIB + 1]
    assert {r.code for r in bad.filter("name = 'a.txt'").collect()} == {413}


def test_prefix_of_a_request(spark):
    files = [("r", 1, True), ("r", 2, False), ("r", 3, True), ("s", 1, True), ("t", 1, False)]
    df = spark.createDataFrame(files, "request string, pos int, ok boolean")
    rows = uploads.accept_prefix(df, "request", "pos", F.col("ok")).collect()
    assert {(r.request, r.pos) for r in rows if r.accepted} == {("r", 1), ("s", 1)}


def test_one_request_holding_most_files(spark):
    files = spark.range(30000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("r"), F.col("id"))).alias("request"),
        F.col("id").alias("pos"),
        (F.col("id") != 15000).alias("ok"),
    )
    accepted = uploads.accept_prefix(files, "request", "pos", F.col("ok")).filter("accepted")
    hot = accepted.filter("request = 'hot'").agg(F.count("*"), F.max("pos")).first()
    assert tuple(hot) == (10000, 14998)
    assert accepted.filter("request <> 'hot'").count() == 10000


def test_names(spark):
    cases = {
        "a/b.c.mp3": ("b", "b.c", "mp3"), "x": ("x", "x", "mp3"), ".hid": ("", ".hid", "hid"),
        "d/a.": ("a", "a.", ""), "d/": ("", "", "mp3"),
    }
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    rows = df.select(
        "p",
        names.stem_to_first_dot(F.col("p")).alias("first"),
        names.stem_to_last_dot(F.col("p")).alias("last"),
        names.decoder_suffix(names.basename(F.col("p"))).alias("suffix"),
    )
    assert {r.p: tuple(r)[1:] for r in rows.collect()} == cases


def test_ids(spark):
    df = spark.createDataFrame([("a", "given"), ("b", ""), ("c", None)], "k string, song string")
    jobs = results.make_jobs(df, F.col("k"), F.col("k"), [F.col("k")], F.col("song")).collect()
    again = results.make_jobs(df, F.col("k"), F.col("k"), [F.col("k")], F.col("song")).collect()
    assert [(r.job_id, r.song_id) for r in jobs] == [(r.job_id, r.song_id) for r in again]
    assert jobs[0].song_id == "given" and all(r.song_id.startswith("trk_") for r in jobs[1:])
    assert all(len(r.job_id) == 16 and len(r.song_hash) == 64 for r in jobs)
    drawn = results.make_jobs(df, F.col("k"), F.col("k"), [F.col("k")], random_ids=True).collect()
    assert len({r.job_id for r in drawn}) == 3 and all(len(r.song_id) == 16 for r in drawn)
    shared = results.make_jobs(df, F.col("k"), F.col("k"), [F.col("k")], request=[F.lit("req")]).collect()
    assert len({r.job_id for r in shared}) == 1 and len({r.song_id for r in shared}) == 3


def test_completeness_with_repeats(spark):
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "job int")
    done = spark.createDataFrame([(1,), (1,), (2,), (9,)], "job int")
    assert tuple(results.completeness(jobs, done, "job").first()) == (3, 3, 1, False)
    assert [r.job for r in results.missing_results(jobs, done, "job").collect()] == [3]
    assert tuple(results.completeness(jobs.limit(0), done, "job").first()) == (0, 0, 0, True)
