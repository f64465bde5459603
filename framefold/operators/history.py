"""Step timelines from execution events.

The events of one execution are an ordered log, and one execution may hold a
large part of all events. Order-dependent work therefore runs on *segments*
(``id`` ranges of one execution) whose size is bounded; what a segment needs
from earlier ones is computed on summary rows of segments.

A timeline is a reduction: every event is tagged once with the step it belongs
to, as far as its own segment tells, and added to one summary row per segment
and tag. Summaries combine associatively (minima and maxima by event id), so
the few rows of an execution's segments are resolved by a running maximum over
earlier segments and combined once more. The events are read and shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold.constants import (
    EXECUTION_STEPS,
    LAMBDA_TEXT,
    LAST_ORDER,
    MAP_LIST_TEXT,
    MAP_STATE,
    MAP_TEXT,
    RESOURCE_TEXT,
    STATE_NAMES,
    STATE_TEXT,
    UNKNOWN_ERROR,
    WAIT_DETAILS,
    WAIT_STATE,
    WAIT_STEP,
)
from framefold.functions.documents import is_truthy_json
from framefold.functions.text import has, segment
from framefold.functions.times import step_duration

ARN = "execution_arn"
SEGMENT_SIZE = 65536

ENTERED = ("TaskStateEntered", "MapStateEntered")
STARTED = ("LambdaFunctionStarted", "TaskStarted")
FAILED = ("LambdaFunctionFailed", "TaskFailed")
TERMINAL = ("LambdaFunctionSucceeded", "MapStateSucceeded", "TaskSucceeded", *FAILED)
# These overwrite whatever the step's status was; the other terminal events only end a running step.
OVERWRITING = ("LambdaFunctionSucceeded", "MapStateSucceeded")
UNNAMED = (
    "LambdaFunctionScheduled",
    "TaskScheduled",
    "LambdaFunctionSucceeded",
    "TaskSucceeded",
    *STARTED,
    *FAILED,
)


def _is(*types: str) -> Column:
    return F.col("type").isin(*types)


def _state() -> Column:
    return F.nullif(F.coalesce("name", F.lit("")), F.lit(""))


def _waits() -> Column:
    return (F.col("type") == "WaitStateEntered") & (F.coalesce("seconds", F.lit(0.0)) != 0)


def state_entries(history: DataFrame) -> DataFrame:
    """Events that can open a step, with the step they name."""
    named = F.when(_is(*ENTERED), _state()).when(_waits(), F.coalesce("name", F.lit(WAIT_STATE)))
    return history.withColumn("state_name", named).where(F.col("state_name").isNotNull())


def first_visit(history: DataFrame) -> DataFrame:
    """First entry per execution and state: id, time, type, seconds, input.

    A minimum per key, so repeated visits collapse before the shuffle.
    """
    first = F.min(F.struct("id", "type", "ts", "seconds", "input")).alias("_first")
    return (
        state_entries(history).groupBy(ARN, "state_name").agg(first).select(ARN, "state_name", "_first.*")
    )


def _segment(segment_size: int) -> Column:
    return F.floor(F.col("id") / F.lit(segment_size)).cast("bigint")


def _marker() -> Column:
    """What an event says about the current state: the state entered, or none after an exit."""
    return F.when(_is(*ENTERED), F.struct(_state().alias("state"))).when(
        _is("TaskStateExited"), F.struct(F.lit(None).cast("string").alias("state"))
    )


def attribute_events(history: DataFrame, segment_size: int = SEGMENT_SIZE) -> DataFrame:
    """Add ``state_name``: the state entered most recently, NULL after its exit.

    A running "last marker" per segment, started from the last marker of the
    earlier segments of the execution. It costs one shuffle of the events; what
    is joined to them is one row per segment.
    """
    events = history.withColumns({"segment": _segment(segment_size), "_marker": _marker()})
    within = (
        Window.partitionBy(ARN, "segment")
        .orderBy("id", "type")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(ARN)
        .orderBy("segment")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marked_at = F.when(F.col("_marker").isNotNull(), F.struct("id", "type"))
    carried = (
        events.groupBy(ARN, "segment")
        .agg(F.max_by("_marker", marked_at).alias("_tail"))
        .select(ARN, "segment", F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    )
    running = events.withColumn("_local", F.last("_marker", ignorenulls=True).over(within))
    return (
        running.join(carried, [ARN, "segment"], "left")
        .withColumn("state_name", F.coalesce("_local", "_carry")["state"])
        .drop("_marker", "_local", "_carry")
    )


# How an event is tagged: execution rows, entries and waits under their own name, exits, facts of the state
# entered before in the segment, facts of the state carried into it, results of the map step.
_MARK, _OWN, _EXIT, _FACT, _CARRIED, _MAP = "mark", "own", "exit", "fact", "carried", "map"


def segment_summaries(
    history: DataFrame,
    map_state: str = MAP_STATE,
    names: Mapping[str, str] = STATE_NAMES,
    segment_size: int = SEGMENT_SIZE,
) -> DataFrame:
    """One row per execution, segment and tag with all facts a timeline needs of its events.

    ``part`` counts, within a segment, the first marker, the first map result before and the first after an entry
    of a map step: these end what can be summed up for a step without knowing earlier segments. Rows of a part come
    before those of the next one. ``seen`` tells a map result that follows such an entry in its segment.
    """
    entered, marks = _is(*ENTERED), _is("ExecutionStarted", "ExecutionSucceeded", "ExecutionFailed")
    waits, results = _is("WaitStateEntered", "WaitStateExited"), _is("MapStateSucceeded")
    own = F.when(entered, _state()).when(waits, F.coalesce("name", F.lit(WAIT_STATE)))
    lambda_name = F.when(
        (F.col("type") == "LambdaFunctionScheduled") & has(F.lower("resource"), "lambda"),
        F.nullif(segment("resource", ":", -1), F.lit("")),
    )
    events = history.where(entered | marks | waits | results | _is(*UNNAMED, "TaskStateExited")).select(
        ARN,
        *_fact_columns(),
        "seconds",
        _segment(segment_size).alias("segment"),
        own.alias("_own"),
        _marker().alias("_marker"),
        F.when(_is("MapStateEntered") & _is_object("input"), fanout_entering("input")).alias("jobs"),
        lambda_name.alias("_lambda"),
        F.when(entered & _is_map(_state(), map_state, names), F.col("id")).alias("_map_entry"),
    )
    order = Window.partitionBy(ARN, "segment").orderBy("id", "type")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    result_id = F.when(results, F.col("id"))
    running = events.select(
        "*",
        F.last("_marker", ignorenulls=True).over(earlier).alias("_local"),
        F.min("_map_entry").over(earlier).alias("_entry"),
        F.min(result_id).over(earlier).alias("_first_result"),
        F.max(result_id).over(earlier).alias("_last_result"),
        F.count(F.when(marks, True)).over(earlier).alias("_marks"),
        F.row_number().over(order).alias("_row"),
    )
    kind = (
        F.when(marks, _MARK)
        .when(entered | waits, _OWN)
        .when(_is("TaskStateExited"), _EXIT)
        .when(results, _MAP)
        .when(F.col("_local").isNull(), _CARRIED)
        .otherwise(_FACT)
    )
    unseen = F.col("_first_result").isNotNull() & (F.col("_entry").isNull() | (F.col("_first_result") < F.col("_entry")))
    flags = (F.col("_local").isNotNull(), unseen, F.coalesce(F.col("_last_result") >= F.col("_entry"), F.lit(False)))
    key = [ARN, "segment", "kind", "part", "seen", "state_name", "mark"]
    tagged = running.withColumns(
        {
            "kind": kind,
            "part": F.when(kind.isin(_FACT, _CARRIED, _MAP), sum((f.cast("int") for f in flags), F.lit(0))),
            "seen": results & F.col("_entry").isNotNull(),
            "state_name": F.when(entered | waits, F.col("_own")).when(kind == _FACT, F.col("_local.state")),
            "mark": F.when(marks, F.col("_row")),
        }
    ).where((F.col("kind") != _FACT) | F.col("state_name").isNotNull())
    stops = F.when(_is(*TERMINAL) | F.col("_lambda").isNotNull(), F.col("id"))
    open_resource = F.when(
        (F.col("type") == "TaskScheduled")
        & (F.col("resource") != "")
        & ((F.col("id") < F.col("_stop")) | F.col("_stop").isNull()),
        F.struct("id", "resource"),
    )
    opens = (entered & F.col("state_name").isNotNull()) | _waits()
    return (
        tagged.withColumn("_stop", F.min(stops).over(Window.partitionBy(*key)))
        .groupBy(*key)
        .agg(
            F.min(_at(opens, "type", "ts", "seconds", "jobs", F.col("_marks").alias("marks"))).alias("opening"),
            F.max(_at(_is("WaitStateExited"), "ts")).alias("left"),
            F.max(_at(F.col("_marker").isNotNull(), "type")).alias("marker"),
            F.min(_at(_is(*TERMINAL), "type", "ts", "error", "cause", "output")).alias("term"),
            F.max(_at(_is(*OVERWRITING), "ts")).alias("done"),
            F.max(_at(_is(*OVERWRITING) & F.col("output").isNotNull(), "output")).alias("out"),
            F.min(_at(_is(*STARTED) & F.col("ts").isNotNull(), "ts")).alias("start"),
            F.min(_at(F.col("_lambda").isNotNull(), "_lambda")).alias("lam"),
            F.max(open_resource).alias("res"),
            F.min(_at(marks, "type", "ts", "error", "cause")).alias("execution"),
        )
    )


def _combined(summaries: DataFrame, map_state: str, names: Mapping[str, str]) -> DataFrame:
    """One row per execution and step, and one per execution row, from the summaries of all segments.

    Facts carried into a segment go to the last state marked in an earlier one; map results go to the map step
    visited first, if that was before. A resource counts up to the segment and part in which the step first ended.
    """
    execution = Window.partitionBy(ARN)
    before = execution.orderBy("segment").rangeBetween(Window.unboundedPreceding, -1)
    marked = F.when(F.col("marker").isNotNull(), F.struct("segment", "marker", "state_name"))
    is_map = _is_map(F.col("state_name"), map_state, names) & F.col("opening.type").isin(*ENTERED)
    target = F.when((F.col("kind") == _OWN) & is_map, F.struct(F.col("opening.id").alias("id"), "segment", "state_name"))
    resolved = summaries.select(
        "*",
        F.max(marked).over(before).alias("_carry"),
        F.coalesce(F.count("mark").over(before), F.lit(0)).alias("_marks"),
        F.min(target).over(execution).alias("_target"),
    )
    visited = F.col("seen") | (F.col("_target.segment") < F.col("segment"))
    state = (
        F.when(F.col("kind").isin(_OWN, _FACT), F.col("state_name"))
        .when(F.col("kind") == _CARRIED, F.col("_carry.state_name"))
        .when((F.col("kind") == _MAP) & visited, F.col("_target.state_name"))
    )
    place = F.struct("segment", "part")
    stopped = F.when(F.col("term").isNotNull() | F.col("lam").isNotNull(), place)
    opening = F.when(
        F.col("opening").isNotNull(), F.col("opening").withField("marks", F.col("opening.marks") + F.col("_marks"))
    )
    return (
        resolved.withColumns({"state_name": state, "opening": opening})
        .where(F.col("state_name").isNotNull() | F.col("mark").isNotNull())
        .withColumn("_stop", F.min(stopped).over(Window.partitionBy(ARN, "state_name")))
        .withColumn("_row", F.when(F.col("mark").isNotNull(), F.struct("segment", "mark")))
        .groupBy(ARN, "state_name", "_row")
        .agg(
            *(F.min(c).alias(c) for c in ("opening", "term", "start", "lam", "execution")),
            *(F.max(c).alias(c) for c in ("left", "done", "out")),
            F.max(F.when(F.col("_stop").isNull() | (place <= F.col("_stop")), F.col("res"))).alias("res"),
        )
    )


def _timeline(history: DataFrame, map_state: str, names: Mapping[str, str], segment_size: int) -> DataFrame:
    """Every row of the timeline: task, map and wait steps and execution rows."""
    combined = _combined(segment_summaries(history, map_state, names, segment_size), map_state, names)
    is_mark, is_wait = F.col("execution").isNotNull(), F.col("opening.type") == "WaitStateEntered"
    visits = Window.partitionBy(ARN).orderBy(F.col("opening.id").asc_nulls_last(), "state_name")
    number = (F.row_number().over(visits) - 1 + F.col("opening.marks")).cast("int")
    running = F.col("term").isNull()
    gone = F.col("left.id") > F.col("opening.id")

    def before_end(fact: str) -> Column:
        return running | (F.col(f"{fact}.id") < F.col("term.id"))

    def of_step(value: Column) -> Column:
        return F.when(~is_mark & ~is_wait, value)

    seconds = F.col("opening.seconds")
    wait_text = F.when(seconds == F.floor(seconds), seconds.cast("bigint").cast("string")).otherwise(seconds.cast("string"))
    lambda_col = F.when(before_end("lam"), F.col("lam._lambda"))
    resource_col = F.col("res.resource")
    started = F.when(
        F.col("opening.type") == "MapStateEntered",
        F.when(F.col("opening.jobs").isNotNull(), F.format_string(MAP_TEXT, "opening.jobs")).otherwise(MAP_LIST_TEXT),
    ).otherwise(F.concat(F.lit(STATE_TEXT), "state_name"))
    ended_well = F.col("term.type") == "TaskSucceeded"
    done = F.col("done").isNotNull()
    event = F.col("execution.type")
    failed = event == "ExecutionFailed"
    return (
        combined.where(is_mark | F.col("opening").isNotNull())
        .withColumn("order", F.when(is_mark, F.when(event == "ExecutionStarted", 0).otherwise(LAST_ORDER)).otherwise(number))
        .select(
            ARN,
            "state_name",
            F.when(is_mark, _execution_step(event))
            .when(is_wait, F.format_string(WAIT_STEP, wait_text))
            .otherwise(_display("state_name", names))
            .alias("step"),
            F.when(is_mark, F.when(failed, "FAILED").otherwise("SUCCEEDED"))
            .when(is_wait, F.when(gone, "SUCCEEDED").otherwise("RUNNING"))
            .when(done | ended_well, "SUCCEEDED")
            .when(running, "RUNNING")
            .otherwise("FAILED")
            .alias("status"),
            F.coalesce("execution.id", "opening.id").alias("first_id"),
            F.when(is_mark, F.col("execution.ts")).otherwise(F.col("opening.ts")).alias("entered_at"),
            of_step(F.when(before_end("start"), F.col("start.ts"))).alias("started_at"),
            F.when(is_wait, F.when(gone, F.col("left.ts")))
            .when(~is_mark, F.when(done, F.col("done.ts")).otherwise(F.col("term.ts")))
            .alias("completed_at"),
            of_step(lambda_col).alias("lambda"),
            of_step(resource_col).alias("resource"),
            of_step(F.coalesce("out.output", F.when(ended_well, F.col("term.output")))).alias("output"),
            F.when(is_mark, F.when(failed, F.coalesce("execution.error", F.lit(UNKNOWN_ERROR))))
            .when(~is_wait, F.col("term.error"))
            .alias("error"),
            F.when(is_mark, F.when(failed, F.coalesce("execution.cause", F.lit(""))))
            .when(~is_wait, F.col("term.cause"))
            .alias("cause"),
            F.when(is_wait, F.format_string(WAIT_DETAILS, wait_text))
            .when(~is_mark, F.when(lambda_col.isNotNull(), F.concat(F.lit(LAMBDA_TEXT), lambda_col))
                  .when(resource_col.isNotNull(), F.concat(F.lit(RESOURCE_TEXT), resource_col))
                  .otherwise(started))
            .alias("details"),
            "order",
            (~is_mark & ~is_wait).alias("_is_state"),
        )
    )


def state_steps(
    history: DataFrame,
    map_state: str = MAP_STATE,
    names: Mapping[str, str] = STATE_NAMES,
    segment_size: int = SEGMENT_SIZE,
) -> DataFrame:
    """One row per execution and visited task or map state.

    status: SUCCEEDED after any overwriting success, else by the first terminal
    event, else RUNNING. completed_at: the last overwriting success, else the
    first terminal event. started_at, lambda and resource come from before the
    first terminal event; error and cause from that event.
    """
    return _timeline(history, map_state, names, segment_size).where("_is_state").drop("_is_state", "order")


def _fact_columns() -> list:
    failed = _is(*FAILED, "ExecutionFailed")
    return [
        "id",
        "type",
        "ts",
        "resource",
        F.when(failed, F.col("error")).alias("error"),
        F.when(failed, F.col("cause")).alias("cause"),
        success_output().alias("output"),
    ]


def _at(condition: Column, *fields: str | Column) -> Column:
    return F.when(condition, F.struct("id", *fields))


def success_output() -> Column:
    """JSON text of what a success adds to its step, NULL when it adds nothing.

    A function result that is no JSON is kept under ``raw_output``; a map result
    counts its items.
    """
    text = F.col("output")
    broken = F.try_parse_json(text).isNull()
    completed = fanout_completed("output")
    return (
        F.when(
            F.col("type") == "MapStateSucceeded",
            F.when(completed > 0, F.to_json(F.struct(completed.alias("completed_count")))),
        )
        .when(~is_truthy_json(text), F.lit(None))
        .when(
            F.col("type") == "LambdaFunctionSucceeded",
            F.when(broken, F.to_json(F.struct(text.alias("raw_output")))).otherwise(text),
        )
        .when(F.col("type") == "TaskSucceeded", F.when(~broken, text))
    )


def _is_object(text: str) -> Column:
    shape = F.schema_of_variant(F.try_parse_json(F.coalesce(text, F.lit("{}"))))
    return F.coalesce(shape.startswith("OBJECT"), F.lit(False))


def fanout_entering(input_text: str) -> Column:
    """Number of jobs a map state starts with; 0 when there is no such list."""
    doc = F.try_parse_json(F.coalesce(input_text, F.lit("{}")))
    jobs = F.try_variant_get(doc, "$.rekognition.jobs", "array<variant>")
    return F.coalesce(F.array_size(jobs), F.lit(0)).cast("bigint")


def fanout_completed(output_text: str) -> Column:
    """Number of items a map state ended with; 0 when the result is no list."""
    items = F.try_variant_get(F.try_parse_json(output_text), "$", "array<variant>")
    return F.coalesce(F.array_size(items), F.lit(0)).cast("bigint")


def fanout(history: DataFrame) -> DataFrame:
    """Jobs entering and completed, per map event."""
    entered = history.where(_is("MapStateEntered")).select(
        ARN, "id", F.lit("entered").alias("phase"), fanout_entering("input").alias("jobs")
    )
    done = history.where(_is("MapStateSucceeded")).select(
        ARN, "id", F.lit("completed").alias("phase"), fanout_completed("output").alias("jobs")
    )
    return entered.unionByName(done)


def wait_spans(history: DataFrame) -> DataFrame:
    """Wait states with a duration: first entry, and the last exit after it."""
    name = F.coalesce("name", F.lit(WAIT_STATE))
    exits = F.when(_is("WaitStateExited"), F.struct("id", "ts"))
    entry = F.when(_waits(), F.struct("id", "ts", "seconds"))
    spans = (
        history.where(_is("WaitStateEntered", "WaitStateExited"))
        .groupBy(ARN, name.alias("state_name"))
        .agg(F.min(entry).alias("entry"), F.max(exits).alias("exit"))
        .where(F.col("entry").isNotNull())
    )
    left = F.col("exit.id") > F.col("entry.id")
    return spans.select(
        ARN,
        "state_name",
        F.when(left, "SUCCEEDED").otherwise("RUNNING").alias("status"),
        F.col("entry.id").alias("first_id"),
        F.col("entry.ts").alias("entered_at"),
        F.when(left, F.col("exit.ts")).alias("completed_at"),
        F.col("entry.seconds").alias("seconds"),
    )


def _execution_step(kind: Column) -> Column:
    started, done, failed = EXECUTION_STEPS
    return F.when(kind == "ExecutionStarted", started).when(kind == "ExecutionFailed", failed).otherwise(done)


def terminal_rows(history: DataFrame) -> DataFrame:
    """Execution-level rows: started, completed, failed with error and cause."""
    kind = F.col("type")
    failed = kind == "ExecutionFailed"
    return history.where(_is("ExecutionStarted", "ExecutionSucceeded", "ExecutionFailed")).select(
        ARN,
        F.col("id").alias("first_id"),
        _execution_step(kind).alias("step"),
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("status"),
        F.col("ts").alias("entered_at"),
        F.when(failed, F.coalesce("error", F.lit(UNKNOWN_ERROR))).alias("error"),
        F.when(failed, F.coalesce("cause", F.lit(""))).alias("cause"),
        F.when(kind == "ExecutionStarted", F.lit(0)).otherwise(F.lit(LAST_ORDER)).alias("order"),
    )


def step_orders(
    history: DataFrame, visits: DataFrame | None = None, segment_size: int = SEGMENT_SIZE
) -> DataFrame:
    """Order number per visited state: the rows (states and execution rows) opened before it.

    States are few per execution and are numbered directly. Execution rows are
    counted per segment first: whole segments before the state's come as a
    running sum, those of its own segment by an equi-join inside it.
    """
    visits = first_visit(history) if visits is None else visits
    seg = F.floor(F.col("id") / F.lit(segment_size)).cast("bigint").alias("segment")
    rank = F.row_number().over(Window.partitionBy(ARN).orderBy("id", "state_name")) - 1
    opened = visits.select(ARN, "state_name", "id", seg, rank.alias("_rank"))
    marks = history.where(_is("ExecutionStarted", "ExecutionSucceeded", "ExecutionFailed")).select(
        ARN, F.col("id").alias("_mark"), seg
    )
    earlier = Window.partitionBy(ARN).orderBy("segment").rangeBetween(Window.unboundedPreceding, -1)
    per_segment = marks.groupBy(ARN, "segment").agg(F.count(F.lit(1)).alias("_n"))
    whole = (
        opened.unionByName(per_segment, allowMissingColumns=True)
        .withColumn("_whole", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where(F.col("state_name").isNotNull())
        .drop("_n")
    )
    own = (
        opened.join(marks, [ARN, "segment"])
        .where(F.col("_mark") < F.col("id"))
        .groupBy(ARN, "state_name")
        .agg(F.count(F.lit(1)).alias("_own"))
    )
    number = F.col("_rank") + F.col("_whole") + F.coalesce("_own", F.lit(0))
    return whole.join(own, [ARN, "state_name"], "left").select(
        ARN, "state_name", number.cast("int").alias("order")
    )


def steps(
    history: DataFrame,
    map_state: str = MAP_STATE,
    names: Mapping[str, str] = STATE_NAMES,
    segment_size: int = SEGMENT_SIZE,
) -> DataFrame:
    """The whole timeline: execution rows, task, map and wait steps with order and duration."""
    return (
        _timeline(history, map_state, names, segment_size)
        .drop("_is_state")
        .withColumn("duration", step_duration("entered_at", "started_at", "completed_at"))
    )


def order_steps(df: DataFrame) -> DataFrame:
    """Sort for display: by execution, order, time (missing first)."""
    return df.orderBy(ARN, "order", F.col("entered_at").asc_nulls_first(), "first_id")


def pair_iterations(history: DataFrame, map_state: str = MAP_STATE) -> DataFrame:
    """Map iterations with their end.

    Starts count once the map state was entered. An end goes to the first start
    with its index; an end without one is ignored. The last end sets status and
    time, the last failed end sets error and cause.
    """
    entered = (
        history.where(_is(*ENTERED) & (F.col("name") == map_state))
        .groupBy(ARN)
        .agg(F.min("id").alias("_since"))
    )
    iterations = (
        history.where(_is("MapIterationStarted", "MapIterationSucceeded", "MapIterationFailed"))
        .join(entered, ARN)
        .where(F.col("id") > F.col("_since"))
        .select(ARN, "index", "id", "type", "ts", "error", "cause")
    )
    start = F.col("type") == "MapIterationStarted"
    failed = F.col("type") == "MapIterationFailed"
    ends = iterations.groupBy(ARN, "index").agg(
        F.min(F.when(start, F.col("id"))).alias("id"),
        F.max(_at(~start, "type", "ts")).alias("end"),
        F.max(_at(failed, "error", "cause")).alias("fail"),
    )
    mine = F.col("end.id") > F.col("id")
    return (
        iterations.where(start)
        .select(ARN, "index", "id", F.col("ts").alias("started_at"))
        .join(ends, [ARN, "index", "id"], "left")
        .select(
            ARN,
            "index",
            "id",
            "started_at",
            F.when(mine & (F.col("end.type") == "MapIterationSucceeded"), "SUCCEEDED")
            .when(mine, "FAILED")
            .otherwise("RUNNING")
            .alias("status"),
            F.when(mine, F.col("end.ts")).alias("completed_at"),
            F.when(F.col("fail.id") > F.col("id"), F.col("fail.error")).alias("error"),
            F.when(F.col("fail.id") > F.col("id"), F.col("fail.cause")).alias("cause"),
        )
    )


def iteration_progress(iterations: DataFrame) -> DataFrame:
    return iterations.groupBy(ARN).agg(
        F.count_if(F.col("status") == "SUCCEEDED").alias("succeeded"),
        F.count(F.lit(1)).alias("total"),
    )


def _is_map(state: Column, map_state: str, names: Mapping[str, str]) -> Column:
    """Whether map results may belong to the task or map state: it has that name or is shown as a map."""
    return (state == map_state) | has(_display(state, names), "Map")


def _display(state: str | Column, names: Mapping[str, str]) -> Column:
    """Display name of a state, the raw name where none is known."""
    state = F.col(state) if isinstance(state, str) else state
    if not names:
        return state
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, state), state)


def name_states(df: DataFrame, names: Mapping[str, str] = STATE_NAMES) -> DataFrame:
    return df.withColumn("step", _display("state_name", names))


def enrich_steps(steps_df: DataFrame, executions: DataFrame) -> DataFrame:
    """Fill the output of the four reporting steps from the execution output where they have none.

    ``executions`` carries ``arn`` and the parsed ``output`` of ``scan_executions``.
    """
    o = F.col("_o")
    none = F.array().cast("array<variant>")
    zero = F.lit(0).cast("bigint")
    empty = F.parse_json(F.lit("{}"))
    no_sources = F.from_json(F.lit("{}"), "map<string,array<variant>>")
    by_state = {
        "IngestVideo": F.struct(
            F.coalesce(o["ingested_count"], zero).alias("ingested_count"),
            F.coalesce(o["source_counts"], empty).alias("source_counts"),
            F.coalesce(o["metadata_by_source"], no_sources).alias("metadata_by_source"),
            F.coalesce(o["metadata"], none).alias("metadata"),
        ),
        "StartRekognitionJobs": F.struct(F.coalesce(o["rekognition"]["jobs"], none).alias("jobs")),
        "FinalizeResults": F.struct(
            F.coalesce(o["finalization"]["processed_count"], zero).alias("processed_count"),
            F.coalesce(o["finalization"]["results"], none).alias("results"),
        ),
        "IndexVideo": F.struct(
            F.coalesce(o["indexing"]["indexed_count"], zero).alias("indexed_count")
        ),
    }
    fill = F.lit(None).cast("string")
    for state, value in by_state.items():
        fill = F.when(F.col("state_name") == state, F.to_json(value)).otherwise(fill)
    outputs = executions.select(F.col("arn").alias(ARN), F.col("output").alias("_o"))
    return (
        steps_df.join(outputs, ARN, "left")
        .withColumn("output", F.coalesce("output", fill))
        .drop("_o")
    )
