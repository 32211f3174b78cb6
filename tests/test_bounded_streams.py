"""Row-bounded batches, bounded runs, iterators, warm-up, counts and missing jobs on streams."""

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbrel.sources import rows as sources
from timbrel.sources.media import stream_table
from timbrel.streaming import batches, counts, iterate, missing, runs, warmup

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def put(spark, path, start, n, files=1):
    rows = spark.range(start, start + n, numPartitions=files).select("id", F.concat(F.lit("t"), "id").alias("text"))
    rows.write.mode("append").parquet(str(path))


def numbered(spark, path):
    out = {}
    for r in batches.read_numbered(spark, f"{path}/table", SCHEMA).collect():
        assert r.text == f"t{r.id}"
        out.setdefault((r.batch, r.batch_rows), []).append(r.id)
    return out


def test_batches_of_rows_then_a_partial_one(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 25, files=4)
    end = batches.read_bounded(spark, f"{tmp_path}/in", f"{tmp_path}/run", SCHEMA, None, batch_size=10, parallelism=3)
    got = numbered(spark, f"{tmp_path}/run")
    assert end == 25 and [k for k in sorted(got)] == [(0, 10), (1, 10), (2, 5)]
    assert sorted(sum(got.values(), [])) == list(range(25))


def test_a_partial_batch_waits_for_its_time(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 3)
    query = batches.start_rows(spark, f"{tmp_path}/in", f"{tmp_path}/run", SCHEMA, batch_size=5, batch_timeout=60)
    try:
        deadline = time.time() + 20
        while not query.status["message"].startswith("Waiting") and time.time() < deadline:
            time.sleep(0.1)
        time.sleep(1)
        assert batches.offset_of(query) == 0  # three rows of five, and the time is not over
        put(spark, tmp_path / "in", 3, 4)
        runs.wait_for(lambda: batches.offset_of(query) == 5, query)
        time.sleep(0.5)
        assert batches.rows_read(query) == 5
    finally:
        query.stop()
    got = numbered(spark, f"{tmp_path}/run")
    assert list(got) == [(0, 5)]


def test_bounded_runs_are_exact_and_go_on(spark, tmp_path):
    """Each run takes exactly its bound, while files keep arriving; all rows come once."""
    put(spark, tmp_path / "in", 0, 40, files=3)
    stop = threading.Event()

    def produce():
        k = 40
        while not stop.is_set() and k < 80:
            put(spark, tmp_path / "in", k, 8)
            k += 8
            time.sleep(0.1)

    producer = threading.Thread(target=produce)
    producer.start()
    try:
        ends = [
            batches.read_bounded(spark, f"{tmp_path}/in", f"{tmp_path}/run", SCHEMA, n, batch_size=4, parallelism=2) for n in (7, 13)
        ]
    finally:
        producer.join()
        stop.set()
    assert ends == [7, 20]
    assert batches.read_bounded(spark, f"{tmp_path}/in", f"{tmp_path}/run", SCHEMA, 1000, batch_size=50) == 80
    got = numbered(spark, f"{tmp_path}/run")
    assert [n for _, n in sorted(got)][:6] == [4, 3, 4, 4, 4, 1]
    assert sorted(sum(got.values(), [])) == list(range(80))


def test_a_batch_that_failed_is_read_again(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 20, files=2)
    path, seen = f"{tmp_path}/run", []

    def run(fail):
        def sink(batch, i):
            ids = sorted(r.id for r in batch.collect())
            if fail and i == 1:
                raise RuntimeError("lost")
            seen.append((i, ids))

        stream = sources.stream_rows(spark, f"{tmp_path}/in", f"{path}/ledger", SCHEMA, batch_size=8, batch_timeout=0.1)
        return stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint").trigger(processingTime="0 seconds").start()

    first = run(True)
    with pytest.raises(Exception, match="lost"):
        first.awaitTermination()
    # files that come meanwhile are sorted in behind those already known
    put(spark, tmp_path / "in", 20, 4)
    second = run(False)
    try:
        runs.wait_for(lambda: batches.offset_of(second) == 24, second)
    finally:
        second.stop()
    assert [i for i, _ in seen] == [0, 1, 2] and sorted(sum((ids for _, ids in seen), [])) == list(range(24))


def test_slices_of_files(tmp_path):
    ledger = sources.Ledger(str(tmp_path / "none"), str(tmp_path / "ledger"))
    ledger.look()
    assert ledger.rows == 0 and ledger.slices(0, 0) == []
    ledger._append([["a", 3], ["b", 0], ["c", 4]])
    assert ledger.slices(0, 7) == [("a", 0, 3), ("c", 0, 4)]
    assert ledger.slices(2, 4) == [("a", 2, 3), ("c", 0, 1)] and ledger.slices(3, 7) == [("c", 0, 4)]


def test_types_row_groups_and_missing_columns(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"at": pa.array([datetime(2024, 1, 1) + timedelta(seconds=i) for i in range(50)]), "tags": [[str(i)] for i in range(50)]})
    (tmp_path / "in").mkdir()
    pq.write_table(table, tmp_path / "in" / "a.parquet", row_group_size=7)
    (tmp_path / "in" / "_hidden.parquet").write_bytes(b"not finished")
    schema = T.StructType([T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("at", T.TimestampNTZType()), T.StructField("new", T.DoubleType())])
    batches.read_bounded(spark, f"{tmp_path}/in", f"{tmp_path}/run", schema, 33, batch_size=20, parallelism=3)
    got = spark.read.parquet(f"{tmp_path}/run/table").collect()
    assert sorted((int(r.tags[0]), r.at, r.new) for r in got) == [(i, datetime(2024, 1, 1) + timedelta(seconds=i), None) for i in range(33)]


def test_iterator_gives_rows_before_the_producer_ends(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 5)
    stream = stream_table(spark, f"{tmp_path}/in", SCHEMA)
    got, later = [], 1
    results = iterate.iterate_stream(stream, f"{tmp_path}/run", size=2)
    for rows in results:
        got += [r.id for r in rows]
        assert len(rows) <= 2
        if len(got) == 5 * later and later < 3:
            put(spark, tmp_path / "in", 5 * later, 5)  # written only after all before has been given out
            later += 1
        if len(got) == 15:
            break
    results.close()
    assert sorted(got) == list(range(15))
    assert not [q for q in spark.streams.active]


def test_iterator_holds_the_source_back_and_goes_on(spark, tmp_path):
    for k in range(4):
        put(spark, tmp_path / "in", 3 * k, 3)
    stream = stream_table(spark, f"{tmp_path}/in", SCHEMA, max_files=1)
    results = iterate.iterate_batches(stream, f"{tmp_path}/run")
    number, first = next(results)
    time.sleep(1.5)
    assert number == 0 and first.count() == 3
    written = {p.name for p in (tmp_path / "run" / "table").iterdir()}
    assert written == {"batch=0"}  # the next batch waits for the consumer
    next(results)
    results.close()  # batch 1 was not finished
    seen = [(i, df.count()) for i, df in iterate.iterate_batches(stream, f"{tmp_path}/run", available_now=True)]
    assert seen == [(1, 3), (2, 3), (3, 3)]
    assert list(iterate.iterate_batches(stream, f"{tmp_path}/run", available_now=True)) == []


def test_iterator_raises_what_the_query_raises(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 3)
    broken = stream_table(spark, f"{tmp_path}/in", SCHEMA).select(F.raise_error(F.lit("bad row")).cast("string").alias("x"))
    with pytest.raises(Exception, match="bad row"):
        list(iterate.iterate_batches(broken, f"{tmp_path}/run", available_now=True))


WARM = "id bigint, k string, warm boolean, data array<string>"


@pytest.fixture
def state_store(spark):
    before = spark.conf.get(warmup.STATE_STORE[0])
    spark.conf.set(*warmup.STATE_STORE)
    yield
    spark.conf.set(warmup.STATE_STORE[0], before)


def test_warm_up_ends_by_rows_and_by_time(spark, tmp_path, state_store):
    def put_rows(rows):
        spark.createDataFrame(rows, WARM).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    put_rows([(1, "a", None, ["x", None]), (2, "a", True, None), (3, "b", False, None), (4, "b", True, []), (5, None, False, None)])
    stream = stream_table(spark, f"{tmp_path}/in", spark.createDataFrame([], WARM).schema)
    started = time.time()
    query = runs.start_table(warmup.warm_up(stream, "k", "warm", 2, timeout=8.0), f"{tmp_path}/out", every="0 seconds")

    def found():
        return {(r.id, r.warm_up, str(r.data)) for r in spark.read.schema("id bigint, k string, data array<string>, warm_up string").parquet(f"{tmp_path}/out/table").collect()}

    try:
        runs.wait_for(lambda: any(p["numInputRows"] for p in query.recentProgress), query)
        if time.time() - started < 6:
            assert found() == set()  # nothing is warm, no time is over
        put_rows([(6, "a", True, None), (7, "a", False, ["y"])])
        runs.wait_for(lambda: {1, 7} <= {i for i, _, _ in found()}, query)
        assert {x for x in found() if x[0] in (1, 7)} == {(1, "warm", "['x', None]"), (7, "warm", "['y']")}
        runs.wait_for(lambda: {3, 5} <= {i for i, _, _ in found()}, query)
        assert time.time() - started > 8
        put_rows([(8, "b", True, None), (9, "b", False, None)])
        runs.wait_for(lambda: 9 in {i for i, _, _ in found()}, query)
    finally:
        query.stop()
    assert {(i, w) for i, w, _ in found()} == {(1, "warm"), (7, "warm"), (3, "timeout"), (5, "timeout"), (9, "timeout")}


def test_counts_over_batches_and_a_repeated_one(spark, tmp_path):
    for k in range(3):
        rows = spark.range(10 * k, 10 * k + 10).select("id", F.when(F.col("id") % 5 == 0, "bad").otherwise("").alias("text"))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    seen = counts.RunCounts("files")
    spark.streams.addListener(seen)
    try:
        stream = stream_table(spark, f"{tmp_path}/in", SCHEMA, max_files=1)
        counted = counts.observe_counts(stream, "files", error="text", size=F.lit(3), quarantined=F.col("id") % 10 == 1)
        query = runs.start_table(counted, f"{tmp_path}/out", available_now=True)
        query.awaitTermination()
        runs.wait_for(lambda: str(query.id) in seen.ended)
    finally:
        spark.streams.removeListener(seen)
    want = {"total": 30, "ok": 21, "failed": 6, "quarantined": 3, "bytes": 90}
    assert {k: seen.totals[k] for k in counts.COUNTS} == want and seen.totals["batches"] == 3
    assert seen.frame(spark).first().asDict() == {**want, "batches": 3}

    class Event:  # the last batch once more, as after a restart
        class progress:
            id, batchId = query.id, 2
            observedMetrics = {"files": {"total": 10, "ok": 7, "failed": 2, "quarantined": 1, "bytes": 30}}

    seen.onQueryProgress(Event)
    assert seen.totals["total"] == 30


def test_missing_jobs_are_named_while_running(spark, tmp_path):
    zero = datetime(2024, 1, 1)

    def put_pairs(name, pairs):
        rows = spark.createDataFrame([(k, zero + timedelta(seconds=s)) for k, s in pairs], "job string, at timestamp")
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    put_pairs("jobs", [("a", 0), ("b", 1), ("c", 2)])
    put_pairs("results", [("a", 5), ("a", 6), ("c", 500)])  # twice; too late
    schema = spark.createDataFrame([], "job string, at timestamp").schema
    jobs, results = (stream_table(spark, f"{tmp_path}/{n}", schema) for n in ("jobs", "results"))
    jobs, results = jobs.withColumnRenamed("at", "sent"), results.withColumnRenamed("at", "done")
    found = missing.missing_on_stream(jobs, results, "job", "sent", "done", wait="60 SECONDS")
    query = runs.start_table(found, f"{tmp_path}/out", every="0 seconds")
    try:
        query.processAllAvailable()
        put_pairs("jobs", [("d", 400), ("e", 900)])
        put_pairs("results", [("d", 450), ("x", 900)])
        query.processAllAvailable()
        got = spark.read.schema(found.schema).parquet(f"{tmp_path}/out/table").collect()
        assert query.isActive
    finally:
        query.stop()
    assert sorted((r.job, r.missing) for r in got) == [("a", False), ("a", False), ("b", True), ("c", True), ("d", False)]


class _AtWork:
    """A query whose first batch takes as long as ``batch`` says and is followed by empty ones."""

    def __init__(self, batch):
        self.end, self.isActive = time.monotonic() + batch, True

    @property
    def status(self):
        return {"isTriggerActive": True}

    @property
    def lastProgress(self):
        over = time.monotonic() - self.end
        return None if over < 0 else {"batchId": int(over / 0.05), "numInputRows": int(over < 0.05)}


def test_a_long_batch_is_no_standstill():
    query = _AtWork(1.0)
    runs.wait_for(lambda: time.monotonic() > query.end + 0.1, query, seconds=0.4, pause=0.02)
    with pytest.raises(TimeoutError):
        runs.wait_for(lambda: False, query, seconds=0.4, pause=0.02)
    with pytest.raises(TimeoutError):
        runs.wait_for(lambda: False, seconds=0.1, pause=0.02)


class _Held(dict):
    writes = 0

    def updateValue(self, key, value):
        self[key], self.writes = value, self.writes + 1

    def getValue(self, key):
        return self[key]


class _Seen:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Handle:
    def __init__(self):
        self.seen, self.held, self.timers = _Seen(), _Held(), []

    def getValueState(self, name, schema):
        return self.seen

    def getMapState(self, name, key, value):
        return self.held

    def registerTimer(self, at):
        self.timers.append(at)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):
        return 0


@pytest.mark.parametrize("markers", [0, 1, 2])
def test_waiting_rows_share_entries_of_the_state(markers, monkeypatch):
    monkeypatch.setattr(warmup, "ENTRY", 5000)
    handle = _Handle()
    job = warmup.WarmUp(["id", "data"], T.StructType(), "warm", 2, 1000)
    job.init(handle)
    row = T.Row("id", "warm", "data")
    out = []
    for begin in (0, 3000):
        out += job.handleInputRows(("k",), iter([row(i, False, [f"d{i}"]) for i in range(begin, begin + 3000)]), handle)
    assert not out and 10 < handle.held.writes < 60  # not one for each row
    assert all(len(v[0]) < 5100 for v in handle.held.values())
    out += job.handleInputRows(("k",), iter([row(-1, True, None)] * markers), handle)
    out += job.handleInputRows(("k",), iter([row(6000, False, None)]), handle)
    assert bool(handle.timers) == (markers < 2)
    if handle.timers:
        out += job.handleExpiredTimer(("k",), handle, None)
    assert [(r.id, r.data) for r in out] == [(i, [f"d{i}"]) for i in range(6000)] + [(6000, None)]
    assert {r.warm_up for r in out} == {"warm" if markers == 2 else "timeout"} and not handle.held


@pytest.mark.parametrize("together", [1, 3, 100])
def test_batches_that_wait_are_taken_together(spark, tmp_path, together):
    """The same batches in fewer triggers; bounds and later runs stay exact."""
    put(spark, tmp_path / "in", 0, 57, files=5)
    settings = {"batch_size": 4, "parallelism": 3, "together": together}
    path = f"{tmp_path}/run"
    assert batches.read_bounded(spark, f"{tmp_path}/in", path, SCHEMA, 18, **settings) == 18
    first = spark.read.parquet(f"{path}/table").select("batch").distinct().count()
    assert first == {1: 5, 3: 3, 100: 2}[together]
    assert batches.read_bounded(spark, f"{tmp_path}/in", path, SCHEMA, None, **settings) == 57
    got = numbered(spark, path)
    assert [n for _, n in sorted(got)] == [4, 4, 4, 4, 2, *[4] * 9, 3] and [b for b, _ in sorted(got)] == list(range(15))
    assert sorted(sum(got.values(), [])) == list(range(57))
    if together == 100:  # batches are runs of neighbours in the order of the files
        ledger = sources.Ledger(f"{tmp_path}/in", f"{path}/ledger")
        order = sum((spark.read.parquet(p).toPandas()["id"].tolist() for p in ledger.paths), [])
        sizes = sorted(got)
        at = 0
        for key in sizes:
            assert sorted(got[key]) == sorted(order[at : at + key[1]])
            at += key[1]


def test_a_trigger_of_many_batches_that_failed_is_read_again(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 20, files=2)
    path, seen = f"{tmp_path}/run", []

    def run(fail):
        def sink(batch, i):
            rows = sorted((r.id, r[sources.FIRST]) for r in batch.collect())
            if fail:
                seen.append(rows)
                raise RuntimeError("lost")
            seen.append(rows)

        stream = sources.stream_rows(spark, f"{tmp_path}/in", f"{path}/ledger", SCHEMA, batch_size=8, batch_timeout=0.1, together=9)
        return stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint").trigger(processingTime="0 seconds").start()

    with pytest.raises(Exception, match="lost"):
        run(True).awaitTermination()
    second = run(False)
    try:
        runs.wait_for(lambda: batches.offset_of(second) == 20, second)
    finally:
        second.stop()
    assert seen[0] == seen[1] and sorted({f for _, f in sum(seen, [])}) == [0, 8, 16]
    assert sorted(i for i, _ in sum(seen[1:], [])) == list(range(20))


def test_together_needs_its_column(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 3)
    with pytest.raises(ValueError, match="told apart"):
        batches.start_rows(spark, f"{tmp_path}/in", f"{tmp_path}/run", SCHEMA, lambda rows: rows.select("id"), together=2)
    with pytest.raises(ValueError, match="no column"):
        schema = T.StructType([T.StructField(sources.FIRST, T.LongType())])
        batches.start_rows(spark, f"{tmp_path}/in", f"{tmp_path}/run", schema, together=2)
