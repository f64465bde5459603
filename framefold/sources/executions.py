"""Execution lists and execution histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold import schemas
from framefold.constants import (
    KNOWN_EXECUTION_STATUSES,
    STEP_PREFIX_OTHER,
    STEP_PREFIXES,
    UNKNOWN_ERROR,
)
from framefold.functions.documents import parse_once
from framefold.functions.text import col
from framefold.functions.times import display_ts, event_time


def scan_executions(df: DataFrame) -> DataFrame:
    """Parse the ``input`` and ``output`` texts; missing, empty or broken ones are empty objects."""
    return df.withColumns(
        {
            "input": F.from_json(_object_text("input"), schemas.EXECUTION_INPUT),
            "output": F.from_json(_object_text("output"), schemas.EXECUTION_OUTPUT),
        }
    )


def _object_text(name: str) -> Column:
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), F.lit("{}"))


def flatten_executions(df: DataFrame) -> DataFrame:
    """One flat row per execution, defaults applied."""
    none = F.array().cast("array<variant>")
    no_sources = F.from_json(F.lit("{}"), "map<string,array<variant>>")
    return df.select(
        display_ts("start").alias("timestamp"),
        "start",
        F.coalesce("input.campaign", F.lit("unknown")).alias("campaign"),
        F.coalesce("input.batch_size_video", F.lit(0).cast("bigint")).alias("batch_size"),
        "status",
        F.coalesce("output.finalization.processed_count", F.lit(0).cast("bigint")).alias(
            "files_processed"
        ),
        "arn",
        F.coalesce("output.metadata", none).alias("ingested_videos"),
        F.coalesce("output.metadata_by_source", no_sources).alias("ingested_by_source"),
        F.coalesce("output.finalization.results", none).alias("processed_videos"),
    )


def execution_status_label(status) -> Column:
    """The status where it is a known one, else OTHER."""
    c = col(status)
    return F.when(c.isin(*KNOWN_EXECUTION_STATUSES), c).otherwise("OTHER")


def step_status_label(status) -> Column:
    c = col(status)
    label = F.lit(STEP_PREFIX_OTHER)
    for word, prefix in STEP_PREFIXES.items():
        label = F.when(c == word, prefix).otherwise(label)
    return label


def scan_history(raw: DataFrame, body: str = "body", missing_id: int | None = 0) -> DataFrame:
    """Flat history events of raw event documents, one row each.

    Columns: execution_arn, id (``missing_id`` when missing; None for ``recover_order``), type, ts, name, input, seconds,
    resource, output, error, cause, index. The order of events is carried by
    ``id``. Timelines read the result several times: land it as a table first
    (``land_history``), so that the documents are parsed once.
    """
    e = F.col("_e")

    def detail(field: str, *events: str) -> Column:
        return F.coalesce(*[e[f"{name}EventDetails"][field] for name in events])

    def of(field: str, default: str, **by_type: str) -> Column:
        """The field of the detail object belonging to the event's own type."""
        out = F.lit(None).cast("string")
        for event_type, name in by_type.items():
            value = F.coalesce(e[f"{name}EventDetails"][field], F.lit(default))
            out = F.when(e["type"] == event_type, value).otherwise(out)
        return out

    failures = {
        "LambdaFunctionFailed": "lambdaFunctionFailed",
        "TaskFailed": "taskFailed",
        "ExecutionFailed": "executionFailed",
        "MapIterationFailed": "mapIterationFailed",
    }
    return parse_once(raw, body, schemas.HISTORY_EVENT, "_e").select(
        "execution_arn",
        F.coalesce(e["id"], F.lit(missing_id).cast("bigint")).alias("id"),
        F.coalesce(e["type"], F.lit("")).alias("type"),
        any_time(e["timestamp"]).alias("ts"),
        detail(
            "name",
            "mapStateEntered",
            "waitStateEntered",
            "waitStateExited",
            "stateEntered",
            "stateExited",
        ).alias("name"),
        detail("input", "mapStateEntered", "stateEntered").alias("input"),
        detail("seconds", "waitStateEntered", "stateEntered").alias("seconds"),
        of(
            "resource",
            "",
            LambdaFunctionScheduled="lambdaFunctionScheduled",
            TaskScheduled="taskScheduled",
        ).alias("resource"),
        of(
            "output",
            "{}",
            LambdaFunctionSucceeded="lambdaFunctionSucceeded",
            TaskSucceeded="taskSucceeded",
            MapStateSucceeded="mapStateSucceeded",
        ).alias("output"),
        of("error", UNKNOWN_ERROR, **failures).alias("error"),
        of("cause", "", **failures).alias("cause"),
        F.coalesce(
            detail("index", "mapIterationStarted", "mapIterationSucceeded", "mapIterationFailed"),
            F.lit(0).cast("bigint"),
        ).alias("index"),
    )


#: Event types of one instant in the order in which they happen; others come in between.
EVENT_ORDER = (
    ("ExecutionStarted",),
    ("TaskStateEntered", "MapStateEntered", "WaitStateEntered"),
    ("MapIterationStarted",),
    ("LambdaFunctionScheduled", "TaskScheduled"),
    ("LambdaFunctionStarted", "TaskStarted"),
    ("LambdaFunctionFailed", "TaskFailed", "LambdaFunctionSucceeded", "TaskSucceeded"),
    ("MapIterationFailed", "MapIterationSucceeded"),
    ("MapStateSucceeded",),
    ("TaskStateExited", "WaitStateExited"),
    ("ExecutionFailed", "ExecutionSucceeded"),
)


def recover_order(history: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """``history`` with new ids for executions in which an event has none; other executions keep theirs.

    Their events are numbered from 1 by time (missing times first), then by the order in which events of one instant
    happen (``EVENT_ORDER``), then by type. Numbers are given inside buckets of time, so that a long execution is no
    single group; what comes before a bucket is summed up on one row per bucket.
    """
    ranks = [F.lit(x) for n, types in enumerate(EVENT_ORDER) for t in types for x in (t, n)]
    rank = F.coalesce(F.try_element_at(F.create_map(*ranks), F.col("type")), F.lit(len(EVENT_ORDER) // 2))
    bucket = F.coalesce(F.floor(F.unix_seconds("ts") / bucket_seconds), F.lit(-(1 << 62)))
    events = history.withColumn("_bucket", bucket)
    key = ["execution_arn", "_bucket"]
    execution = Window.partitionBy("execution_arn")
    sizes = events.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.bool_or(F.col("id").isNull()).alias("_lost"))
    before = execution.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *key,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.bool_or("_lost").over(execution).alias("_lost"),
    )
    inside = Window.partitionBy(*key).orderBy(F.col("ts").asc_nulls_first(), rank, "type")
    numbered = events.withColumn("_nth", F.row_number().over(inside)).join(sizes, key)
    new_id = F.when(F.col("_lost"), F.col("_before") + F.col("_nth")).otherwise(F.col("id"))
    return numbered.withColumn("id", new_id).select(*history.columns)


def land_history(history: DataFrame, path: str) -> DataFrame:
    """Write flat history events and read them back."""
    history.write.mode("overwrite").parquet(path)
    return history.sparkSession.read.schema(history.schema).parquet(path)


def any_time(text) -> Column:
    """Time of an event stamp: an epoch number in s or ms, else a timestamp text, else NULL."""
    text = col(text)
    number = text.try_cast("double")
    return F.when(number.isNotNull(), event_time(number)).otherwise(F.try_to_timestamp(text))
