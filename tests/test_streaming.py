from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from framefold.sources import id_table as T
from framefold.streaming import jobs as S

T0 = datetime(2024, 1, 1)
STATUS = "job_id string, status string, ts timestamp"


def land(spark, path, rows, schema=STATUS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def polls():
    def at(m):
        return T0 + timedelta(minutes=m)

    return [
        ("a", "IN_PROGRESS", at(0)), ("a", "SUCCEEDED", at(1)), ("a", "SUCCEEDED", at(2)),
        ("b", "FAILED", at(1)), ("c", "UNKNOWN", at(0)), ("c", "UNKNOWN", at(3)),
    ]


def stream(spark, path, schema=STATUS):
    return spark.readStream.schema(schema).parquet(path)


def test_terminal_jobs_once_across_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    land(spark, src, polls())
    for _ in range(2):
        S.publish_view(S.terminal_jobs(stream(spark, src)), out, ck, ["job_id"]).awaitTermination()
        # late repeats of a finished job, picked up by the second run: neither is its first end
        land(spark, src, [("a", s, T0 + timedelta(minutes=5)) for s in ("SUCCEEDED", "FAILED")])
        land(spark, src, [("d", "FAILED", T0 + timedelta(minutes=5))])
    got = [(r.job_id, r.status, r.ts) for r in S.read_view(spark, out, ["job_id"]).collect()]
    one, five = (T0 + timedelta(minutes=m) for m in (1, 5))
    assert sorted(got) == [("a", "SUCCEEDED", one), ("b", "FAILED", one), ("d", "FAILED", five)]


def test_status_view_and_stats_equal_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    land(spark, src, polls())
    for name, build, key in (
        ("view", S.status_view, ["job_id"]),
        ("stats", lambda d: S.stream_stats(d, ["status"]), ["status"]),
    ):
        out, ck = str(tmp_path / name), str(tmp_path / (name + "ck"))
        S.publish_view(build(stream(spark, src)), out, ck, key).awaitTermination()
        land(spark, src, [("c", "SUCCEEDED", T0 + timedelta(minutes=9))])
        S.publish_view(build(stream(spark, src)), out, ck, key).awaitTermination()
        got = {tuple(r) for r in S.read_view(spark, out, key).collect()}
        assert got == {tuple(r) for r in build(spark.read.schema(STATUS).parquet(src)).collect()}


def test_stalled_batch_and_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    land(spark, src, polls())
    batch = spark.read.schema(STATUS).parquet(src)
    now = F.lit(T0 + timedelta(hours=1))
    assert [r.job_id for r in S.stalled_jobs(batch, now, 600).collect()] == ["c"]
    assert S.stalled_jobs(batch, now, 7200).count() == 0

    def run():
        late = S.stalled_jobs_stream(stream(spark, src), 600, "0 seconds")
        S.drain(late, out, ck).awaitTermination()

    run()
    land(spark, src, [("e", "SUCCEEDED", T0 + timedelta(hours=2))])
    run()
    land(spark, src, [("f", "SUCCEEDED", T0 + timedelta(hours=3))])
    run()
    # polled again after it was reported: not reported again
    for hour in (4, 5, 6):
        land(spark, src, [("c", "UNKNOWN", T0 + timedelta(hours=hour))])
        run()
    got = spark.read.schema("job_id string, first_ts timestamp").parquet(out).collect()
    assert [(r.job_id, r.first_ts) for r in got] == [("c", T0)]


def test_terminal_jobs_with_expiry(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run(*rows):
        land(spark, src, [(j, s, T0 + timedelta(minutes=m)) for j, s, m in rows])
        query = S.drain(S.terminal_jobs_stream(stream(spark, src), "10 minutes", keep_seconds=3600), out, ck)
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    run(("a", "SUCCEEDED", 5), ("a", "SUCCEEDED", 6), ("b", "IN_PROGRESS", 5), ("c", "FAILED", 9))
    run(("a", "FAILED", 4))  # late by less than the delay: the first end by time
    run(*[(f"j{i}", "SUCCEEDED", 20) for i in range(50)])
    run(("a", "SUCCEEDED", 25))  # repeats of reported jobs
    before = run(("x", "IN_PROGRESS", 40), ("c", "FAILED", 30))
    run(("x", "IN_PROGRESS", 200))
    after = run(("x", "IN_PROGRESS", 201))
    got = sorted((r.job_id, r.status, r.ts) for r in spark.read.schema(STATUS).parquet(out).collect())
    want = [("a", "FAILED", 4), ("c", "FAILED", 9), *((f"j{i}", "SUCCEEDED", 20) for i in range(50))]
    assert got == sorted((j, s, T0 + timedelta(minutes=m)) for j, s, m in want)
    assert before >= 52 and after == 0


@pytest.mark.parametrize("name", ["terminal", "stalled"])
def test_jobs_share_calls_and_state_rows(spark, tmp_path, monkeypatch, name):
    """Many jobs of a bucket are told apart, each at its time, and cost one state row."""
    monkeypatch.setattr(S, "JOB_BUCKETS", 2)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run(*rows):
        land(spark, src, [(j, s, T0 + timedelta(minutes=m)) for j, s, m in rows])
        polls = stream(spark, src)
        if name == "terminal":
            told = S.terminal_jobs_stream(polls, "10 minutes", keep_seconds=3600)
        else:
            told = S.stalled_jobs_stream(polls, 600, "0 seconds", keep_seconds=3600)
        query = S.drain(told, out, ck)
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    status = "FAILED" if name == "terminal" else "UNKNOWN"
    assert run(*[(f"j{i}", status, i) for i in range(40)], ("x", "UNKNOWN", 39)) <= 2
    told = [r[0] for r in spark.read.parquet(out).select("job_id").collect()]
    assert sorted(told) == sorted(f"j{i}" for i in range(30))
    run(("j3", status, 41), ("y", "UNKNOWN", 60))  # remembered: not told again
    told = spark.read.parquet(out).where("job_id like 'j%'").select("job_id", F.col(f"`{'ts' if name == 'terminal' else 'first_ts'}`"))
    assert sorted(tuple(r) for r in told.collect()) == sorted((f"j{i}", T0 + timedelta(minutes=i)) for i in range(40))


def test_a_poll_without_a_time_ends_a_wait():
    stalls = S._Stalls(600, 3600)
    assert stalls.polled(None, "FAILED", None) is None
    assert stalls.polled((1, 2, False), "FAILED", None) == (1, 2, True)
    assert stalls.polled((1, 2, False), "UNKNOWN", None) == (1, 2, False)


def test_published_view_is_compacted(spark, tmp_path, monkeypatch):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    build = lambda: S.status_view(stream(spark, src))

    def publish():
        S.publish_view(build(), out, ck, ["job_id"], every=3).awaitTermination()

    def current():
        return {tuple(r) for r in S.read_view(spark, out, ["job_id"]).collect()}

    def truth():
        return {tuple(r) for r in S.status_view(spark.read.schema(STATUS).parquet(src)).collect()}

    for n in range(8):
        land(spark, src, [(f"j{n % 3}", "IN_PROGRESS", T0 + timedelta(minutes=n)), (f"k{n}", "FAILED", T0)])
        publish()
        assert current() == truth()
    assert S._pointer(spark, out) == 2
    read = {f.split("/out/")[1].split("/")[0] for f in S._view_rows(spark, out, 2).inputFiles()}
    assert read == {"gen=2", "base=2"}  # not the six batches before

    # a crash before the pointer moves leaves the old data valid; the batch is run again
    land(spark, src, [("j0", "FAILED", T0 + timedelta(minutes=30))])
    crash = lambda *_: 1 / 0
    with monkeypatch.context() as m:
        m.setattr(S, "_move_pointer", crash)
        with pytest.raises(Exception):
            publish()
    assert S._pointer(spark, out) == 2 and current() == truth()
    publish()
    assert S._pointer(spark, out) == 3 and current() == truth()


def test_fresh_rows_of_a_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "media_type string, campaign string, source string, source_id string, ts timestamp"
    T.create_id_table(spark, "ids_a", str(tmp_path / "ids"), 4)
    T.create_id_table(spark, "seen_a", str(tmp_path / "seen"), 4)
    index = [("video", "c", "s", "1"), ("video", "x", "s", "3"), ("video", "c", "s", "")]
    T.append_ids(spark.createDataFrame(index, "media_type string, campaign string, source string, source_id string"), "ids_a")

    def run(ids, name, seen=None):
        land(spark, src, [("video", "c", "s", i, T0 + timedelta(minutes=n)) for n, i in enumerate(ids)], schema)
        S.drain_fresh(stream(spark, src, schema), "ids_a", out + name, ck + name, seen).awaitTermination()
        return sorted(r.source_id for r in spark.read.parquet(out + name).collect())

    assert run(["1", "2", "2", "", "", "3"], "all") == ["", "", "2", "2", "3"]
    assert run(["2", "4", ""], "once", "seen_a") == ["", "", "", "2", "3", "4"]
    # a batch that is run again, as its commit was lost, gives the same rows
    commits = sorted((tmp_path / "ckonce" / "commits").glob("[0-9]*"))
    for file in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        file.unlink(missing_ok=True)
    assert run(["4", "5"], "once", "seen_a") == ["", "", "", "2", "3", "4", "5"]
    spark.sql("DROP TABLE ids_a")
    spark.sql("DROP TABLE seen_a")


def test_ids_are_joined_in_their_buckets(spark, tmp_path):
    T.create_id_table(spark, "ids_b", str(tmp_path / "ids"), 4)
    columns = "media_type string, campaign string, source string, source_id string"
    rows = [("video", f"c{i % 3}", "s", str(i) if i % 5 else "") for i in range(3000)]
    T.append_ids(spark.createDataFrame(rows[:2000], columns), "ids_b")
    T.append_ids(spark.createDataFrame(rows[1500:2500], columns), "ids_b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.createDataFrame(rows, columns)
        fresh = T.drop_known(batch, T.known_keys(spark, "ids_b"))
        want = [r for i, r in enumerate(rows) if i >= 2500 or r[3] == ""]
        assert sorted(tuple(r) for r in fresh.collect()) == sorted(want)
        lines = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert lines.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in lines
        few = spark.createDataFrame([("video", "c1", "s", "4")], columns).persist()
        narrowed = T.known_keys(spark, "ids_b", few)
        text = T.drop_known(few, narrowed)._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 4" in text and "campaign#" in text.split("PartitionFilters:")[1]
        assert narrowed.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE ids_b")


def test_id_keys_differ_for_different_ids(spark):
    rows = spark.createDataFrame([("a", "b", "c", "d"), ("ab", "", "c", "d"), ("a", "bc", "", "d")], list(T.ID_COLUMNS))
    assert rows.select(T.id_key()).distinct().count() == 3
