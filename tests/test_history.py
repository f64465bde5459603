"""Window timeline against a sequential fold over random histories."""

import json
import random

import pytest

from framefold.operators import history as H
from framefold.sources.executions import recover_order, scan_executions, scan_history

TASKS = ["IngestVideo", "CheckJobStatus", "Other"]
KEY = {
    "LambdaFunctionScheduled": "lambdaFunctionScheduled",
    "TaskScheduled": "taskScheduled",
    "LambdaFunctionSucceeded": "lambdaFunctionSucceeded",
    "TaskSucceeded": "taskSucceeded",
    "MapStateSucceeded": "mapStateSucceeded",
    "LambdaFunctionFailed": "lambdaFunctionFailed",
    "TaskFailed": "taskFailed",
    "ExecutionFailed": "executionFailed",
    "MapIterationStarted": "mapIterationStarted",
    "MapIterationSucceeded": "mapIterationSucceeded",
    "MapIterationFailed": "mapIterationFailed",
    "TaskStateEntered": "stateEntered",
    "TaskStateExited": "stateExited",
    "MapStateEntered": "mapStateEntered",
    "WaitStateEntered": "waitStateEntered",
    "WaitStateExited": "waitStateExited",
}


def random_event(rng, i):
    kind = rng.choice(
        [*KEY, "LambdaFunctionStarted", "TaskStarted", "ExecutionStarted", "ExecutionSucceeded"]
        + ["TaskStateEntered"] * 4
    )
    d = {}
    if kind == "TaskStateEntered":
        d = {"name": rng.choice(TASKS)}
    elif kind == "MapStateEntered":
        jobs = [{"job_id": str(k)} for k in range(rng.randrange(3))]
        d = {"name": H.MAP_STATE, "input": json.dumps({"rekognition": {"jobs": jobs}})}
    elif kind == "WaitStateEntered":
        d = {"seconds": rng.choice([0, 30])}
    elif kind.endswith("Scheduled"):
        d = {"resource": rng.choice(["", "arn:lambda:f1", "arn:LAMBDA:f2", "arn:batch:x"])}
    elif kind in ("LambdaFunctionSucceeded", "TaskSucceeded"):
        d = rng.choice([{}, {"output": "{}"}, {"output": '{"a":1}'}, {"output": "oops"}, {"output": "0"}])
    elif kind == "MapStateSucceeded":
        d = {"output": json.dumps([1] * rng.randrange(3))}
    elif kind.startswith("MapIteration"):
        d = {"index": rng.randrange(2)}
    if kind.endswith("Failed") and rng.random() < 0.5:
        d.update(error="E" + str(i), cause="C" + str(i))
    event = {"id": i, "type": kind, "timestamp": 1700000000 + i}
    if kind in KEY:
        event[KEY[kind] + "EventDetails"] = d
    return event


def fold(events):
    """The timeline rules read one event at a time."""
    steps, its, current, execs = {}, [], None, 0

    def end(s, ok, t, d):
        s["status"], s["completed_at"] = ("SUCCEEDED" if ok else "FAILED"), t
        if not ok:
            s["error"], s["cause"] = d.get("error", "Unknown error"), d.get("cause", "")

    def parsed(text, broken):
        try:
            return json.loads(text) if text else {}
        except ValueError:
            return broken

    for e in events:
        kind, t = e["type"], e["timestamp"]
        d = e.get(KEY.get(kind, "") + "EventDetails", {})
        mine = steps.get(current) if current else None
        running = mine is not None and mine["status"] == "RUNNING"
        if kind in ("ExecutionStarted", "ExecutionSucceeded", "ExecutionFailed"):
            execs += 1
        elif kind in ("TaskStateEntered", "MapStateEntered"):
            current = d["name"]
            steps.setdefault(
                current, {"status": "RUNNING", "entered_at": t, "order": execs + len(steps)}
            )
        elif kind == "TaskStateExited":
            current = None
        elif kind == "LambdaFunctionScheduled":
            if running and not mine.get("lambda") and "lambda" in d["resource"].lower():
                mine["lambda"] = d["resource"].split(":")[-1]
        elif kind == "TaskScheduled":
            if running and not mine.get("lambda") and d["resource"]:
                mine["resource"] = d["resource"]
        elif kind in ("LambdaFunctionStarted", "TaskStarted"):
            if running:
                mine.setdefault("started_at", t)
        elif kind == "LambdaFunctionSucceeded":
            if mine is not None:
                end(mine, True, t, d)
                out = parsed(d.get("output", "{}"), {"raw_output": d.get("output")})
                if out:
                    mine["output"] = out
        elif kind == "TaskSucceeded":
            if running:
                end(mine, True, t, d)
                out = parsed(d.get("output", "{}"), {})
                if out:
                    mine["output"] = out
        elif kind in ("LambdaFunctionFailed", "TaskFailed"):
            if running:
                end(mine, False, t, d)
        elif kind == "MapStateSucceeded":
            if H.MAP_STATE in steps:
                end(steps[H.MAP_STATE], True, t, d)
                n = len(json.loads(d["output"]))
                if n:
                    steps[H.MAP_STATE]["output"] = {"completed_count": n}
        elif kind == "WaitStateEntered":
            if d["seconds"]:
                steps.setdefault(
                    "WaitForJob",
                    {"status": "RUNNING", "entered_at": t, "order": execs + len(steps)},
                )
        elif kind == "WaitStateExited":
            if "WaitForJob" in steps:
                end(steps["WaitForJob"], True, t, d)
        elif kind == "MapIterationStarted":
            if H.MAP_STATE in steps:
                its.append({"index": d["index"], "id": e["id"], "status": "RUNNING"})
        elif kind in ("MapIterationSucceeded", "MapIterationFailed"):
            first = next((x for x in its if x["index"] == d["index"]), None)
            if first is not None:
                end(first, kind.endswith("Succeeded"), t, d)
    return steps, its


FIELDS = ("status", "entered_at", "started_at", "completed_at", "lambda", "resource", "error", "cause")


@pytest.fixture(scope="module")
def histories():
    rng = random.Random(11)
    return {
        f"arn:execution:{k}": [random_event(rng, i) for i in range(rng.randrange(4, 60))]
        for k in range(120)
    }


@pytest.fixture(scope="module")
def landed(spark, histories):
    rows = [(arn, json.dumps(e)) for arn, events in histories.items() for e in events]
    random.Random(3).shuffle(rows)
    return scan_history(spark.createDataFrame(rows, "execution_arn string, body string")).cache()


@pytest.mark.parametrize("segment_size", [1, 3, 7, 65536])
def test_steps_match_fold(landed, histories, segment_size):
    got = {}
    rows = H.steps(landed, segment_size=segment_size).where("state_name is not null").collect()
    for r in rows:
        out = {f: r[f] for f in FIELDS if r[f] is not None}
        for f in ("entered_at", "started_at", "completed_at"):
            if f in out:
                out[f] = int(out[f].timestamp())
        if r.output is not None:
            out["output"] = json.loads(r.output)
        out["order"] = r.order
        if r.completed_at is not None:
            assert r.duration == out["completed_at"] - out["entered_at"]
        got.setdefault(r.execution_arn, {})[r.state_name] = out
    assert len(rows) == sum(map(len, got.values()))
    for arn, events in histories.items():
        assert got.get(arn, {}) == fold(events)[0], arn


def test_order_is_recovered_from_times(spark, histories):
    """Without the ids of some events, buckets of a few seconds give the timeline of the whole log."""
    rows = [
        (arn, json.dumps({k: v for k, v in e.items() if k != "id" or (n + len(events)) % 3}))
        for arn, events in histories.items()
        for n, e in enumerate(events)
    ]
    random.Random(4).shuffle(rows)
    raw = spark.createDataFrame(rows, "execution_arn string, body string")
    events = recover_order(scan_history(raw, missing_id=None), bucket_seconds=10)
    got = {}
    for r in H.steps(events, segment_size=5).where("state_name is not null").collect():
        got.setdefault(r.execution_arn, {})[r.state_name] = (r.status, r.order, r.error, int(r.entered_at.timestamp()))
    for arn, log in histories.items():
        want = {k: (s["status"], s["order"], s.get("error"), s["entered_at"]) for k, s in fold(log)[0].items()}
        assert got.get(arn, {}) == want, arn


def test_iterations_match_fold(landed, histories):
    pairs = H.pair_iterations(landed)
    got = {}
    for r in pairs.collect():
        out = {"index": r["index"], "id": r.id, "status": r.status}
        if r.completed_at is not None:
            out["completed_at"] = int(r.completed_at.timestamp())
        if r.error is not None:
            out.update(error=r.error, cause=r.cause)
        got.setdefault(r.execution_arn, []).append(out)
    want = {arn: fold(events)[1] for arn, events in histories.items()}
    for arn in histories:
        assert sorted(got.get(arn, []), key=lambda x: x["id"]) == want[arn], arn
    progress = {r.execution_arn: (r.succeeded, r.total) for r in H.iteration_progress(pairs).collect()}
    for arn, its in want.items():
        if its:
            assert progress[arn] == (sum(i["status"] == "SUCCEEDED" for i in its), len(its))


def test_terminal_rows_order_and_names(spark):
    events = [
        {"id": 3, "type": "ExecutionFailed", "timestamp": 1700000009.5},
        {"type": "ExecutionStarted", "timestamp": 1700000000000},
        {"id": 1, "type": "MapStateEntered", "timestamp": "2023-11-14T22:13:20Z",
         "stateEnteredEventDetails": {"name": H.MAP_STATE, "input": '{"rekognition":{"jobs":[1,2]}}'}},
        {"id": 2, "type": "WaitStateEntered", "timestamp": "x",
         "stateEnteredEventDetails": {"name": "Pause", "seconds": 5}},
    ]
    raw = spark.createDataFrame([("a", json.dumps(e)) for e in events], "execution_arn string, body string")
    rows = H.order_steps(H.steps(scan_history(raw))).collect()
    assert [(r.step, r.order, r.status) for r in rows] == [
        ("Execution Started", 0, "SUCCEEDED"),
        ("Process Rekognition Jobs (Map State)", 1, "RUNNING"),
        ("Wait 5s", 2, "RUNNING"),
        ("Execution Failed", 9999, "FAILED"),
    ]
    assert rows[1].details == "Map State: Processing 2 job(s)" and rows[2].details == "Waiting 5 seconds"
    assert (rows[3].error, rows[3].cause) == ("Unknown error", "")
    assert [r.entered_at and r.entered_at.timestamp() for r in rows] == [
        1700000000.0, 1700000000.0, None, 1700000009.5,
    ]
    assert [r.jobs for r in H.fanout(scan_history(raw)).collect()] == [2]


def test_enrich_fills_only_missing_output(spark):
    steps = spark.createDataFrame(
        [("a", "IngestVideo", None), ("a", "IndexVideo", '{"x":1}'), ("b", "FinalizeResults", None),
         ("a", "CheckJobStatus", None)],
        "execution_arn string, state_name string, output string",
    )
    execs = scan_executions(
        spark.createDataFrame(
            [("a", "", '{"ingested_count":2,"source_counts":{"s":2},"metadata":[{"t":1}]}'), ("b", None, "bad")],
            "arn string, input string, output string",
        )
    )
    got = {r.state_name: r.output and json.loads(r.output) for r in H.enrich_steps(steps, execs).collect()}
    assert got["IngestVideo"] == {
        "ingested_count": 2, "source_counts": {"s": 2}, "metadata_by_source": {}, "metadata": [{"t": 1}],
    }
    assert got["IndexVideo"] == {"x": 1} and got["CheckJobStatus"] is None
    assert got["FinalizeResults"] == {"processed_count": 0, "results": []}
