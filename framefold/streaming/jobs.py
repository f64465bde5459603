"""Streaming ingest, job tracking, duplicate suppression, upsert and statistics.

Each function turns a streaming DataFrame into another, or starts the query that
drains it. State and checkpoints live in the folder the caller names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from framefold.constants import TERMINAL_JOB_STATUSES
from framefold.operators.ranking import latest
from framefold.sources.id_table import ID_COLUMNS, append_ids, drop_known, known_keys
from framefold.sources.index_table import append_index

#: Batches that a published view gathers before they are compacted.
COMPACT_EVERY = 16

#: Jobs of the timed streams share a state row by their hash; one is small up to many millions of jobs.
JOB_BUCKETS = 1 << 14


# Stream workers need not be able to import this package: what they run is sent by value.
register_pickle_by_value(sys.modules[__name__])


def stream_ingest(spark: SparkSession, folder: str, keep: str, body: str = "body") -> DataFrame:
    """Stream of landed JSON lines: the ``keep`` columns (DDL) and the response text in ``body``."""
    schema = StructType.fromDDL(f"{keep}, {body} string")
    return spark.readStream.schema(schema).json(folder)


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append everything available now to ``path`` and stop; the file sink writes each row once."""
    return (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def terminal_jobs(status: DataFrame, job: str = "job_id", ts: str = "ts") -> DataFrame:
    """The first terminal status of each job by time; batch or streaming (update mode, see ``publish_view``).

    A minimum per job: repeats collapse before the shuffle, so a job that is reported very often is one
    row per task, and the state holds one small row per finished job. A job changes again only if an
    earlier report of its end comes late.
    """
    first = F.min(F.struct(ts, "status")).alias("_first")
    done = status.where(F.col("status").isin(*TERMINAL_JOB_STATUSES))
    return done.groupBy(job).agg(first).select(job, "_first.status", f"_first.{ts}")


class _JobBucket:
    """The jobs of one bucket: polls change their states, event time reports and forgets them; see ``_by_buckets``."""

    def __init__(self, keep_seconds: int):
        self.keep_ms = keep_seconds * 1000

    def step(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        jobs = {job: tuple(kept) for job, *kept in zip(*state.get)} if state.exists else {}
        if not state.hasTimedOut:
            for frame in frames:
                frame = frame.sort_values("ts")  # polls without a time come last
                times = frame["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
                timed = frame["ts"].notna().tolist()
                for job, status, at, known in zip(frame["job_id"].tolist(), frame["status"].tolist(), times, timed):
                    kept = self.polled(jobs.get(job), status, at if known else None)
                    if kept is not None:
                        jobs[job] = kept
        now, told = state.getCurrentWatermarkMs(), []
        for job, kept in [(j, k) for j, k in jobs.items() if self.due(k) <= now]:
            if not kept[-1]:
                told.append((job, *self.report(kept)))
                jobs[job] = kept = self.reported(kept)
            if self.due(kept) <= now:
                del jobs[job]
        if told:
            yield pd.DataFrame(told, columns=self.columns)
        if not jobs:
            if state.exists:
                state.remove()
            return
        state.update((list(jobs), *map(list, zip(*jobs.values()))))
        # A timeout is due when the watermark is beyond it.
        state.setTimeoutTimestamp(max(min(map(self.due, jobs.values())) - 1, now, 1))


class _FirstEnds(_JobBucket):
    """Per job: report its first terminal status by time once no earlier one can come, forget it later."""

    columns = ["job_id", "status", "ts"]
    kept = "job array<string>, first_us array<bigint>, status array<string>, last_ms array<bigint>, told array<boolean>"

    def polled(self, kept, status, at):
        if kept is None:
            return at, status, at // 1000, False
        first, ended, last, told = kept
        if not told and (at, status) < (first, ended):
            first, ended = at, status
        return first, ended, max(last, at // 1000), told

    def due(self, kept) -> int:
        return kept[2] + self.keep_ms if kept[3] else kept[0] // 1000

    def report(self, kept):
        return kept[1], pd.Timestamp(kept[0], unit="us")

    def reported(self, kept):
        return *kept[:3], True


def _by_buckets(status: DataFrame, bucket: _JobBucket, out: str) -> DataFrame:
    """Run ``bucket`` over ``status``, with its jobs in ``JOB_BUCKETS`` buckets by their hash.

    A call and a state row serve all jobs of a bucket, which is what a job costs otherwise: the calls of a batch are at
    most as many as the buckets. State comes with the rows and holds only jobs that are not forgotten.
    """
    hashed = status.withColumn("bucket", F.pmod(F.xxhash64("job_id"), F.lit(JOB_BUCKETS)))
    return hashed.groupBy("bucket").applyInPandasWithState(
        bucket.step, out, bucket.kept, "append", GroupStateTimeout.EventTimeTimeout
    )


def terminal_jobs_stream(status: DataFrame, delay: str, keep_seconds: int = 7 * 86400) -> DataFrame:
    """Streaming form with bounded state: a job is reported once, with its first terminal status by time.

    It is reported when event time has passed that status by ``delay``, so reports that are late by less cannot change
    it. A job is remembered until ``keep_seconds`` after its last terminal report, so later repeats do not report it
    anew; then its state goes. Only terminal polls reach the state. ``status`` has job_id, status, ts.
    """
    # A condition on the time as well stays above the watermark, so that all polls move it.
    ended_at = F.when(F.col("status").isin(*TERMINAL_JOB_STATUSES), F.col("ts"))
    polls = status.select("job_id", "status", "ts").withWatermark("ts", delay).where(ended_at.isNotNull())
    return _by_buckets(polls, _FirstEnds(keep_seconds), "job_id string, status string, ts timestamp")


def status_view(status: DataFrame, job: str = "job_id", ts: str = "ts") -> DataFrame:
    """Latest status and number of polls per job; batch or streaming (update or complete mode)."""
    newest = F.max_by(F.struct("status", ts), F.struct(ts, "status")).alias("_last")
    return (
        status.groupBy(job)
        .agg(newest, F.count(F.lit(1)).alias("polls"))
        .select(job, "_last.status", F.col(f"_last.{ts}").alias("last_ts"), "polls")
    )


def stalled_jobs(status: DataFrame, now, max_wait_seconds: int, job: str = "job_id", ts: str = "ts"):
    """Jobs without a terminal status whose first report is older than the limit (batch form)."""
    terminal = F.col("status").isin(*TERMINAL_JOB_STATUSES)
    seen = status.groupBy(job).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.bool_or(terminal).alias("_done")
    )
    waited = F.timestamp_diff("SECOND", F.col("first_ts"), now)
    return seen.where(~F.col("_done") & (waited > max_wait_seconds)).drop("_done")


class _Stalls(_JobBucket):
    """Per job: report once when the limit passes without a terminal status, forget ended and reported jobs later."""

    columns = ["job_id", "first_ts"]
    kept = "job array<string>, first_ms array<bigint>, last_ms array<bigint>, closed array<boolean>"

    def __init__(self, max_wait_seconds: int, keep_seconds: int):
        super().__init__(keep_seconds)
        self.max_wait_ms = max_wait_seconds * 1000

    def polled(self, kept, status, at):
        if at is None:  # it can end a wait, not begin one
            return kept and (*kept[:2], kept[2] or status in TERMINAL_JOB_STATUSES)
        first, last, closed = kept or (at // 1000, at // 1000, False)
        return min(first, at // 1000), max(last, at // 1000), closed or status in TERMINAL_JOB_STATUSES

    def due(self, kept) -> int:
        return kept[1] + self.keep_ms if kept[2] else kept[0] + self.max_wait_ms

    def report(self, kept):
        return (pd.Timestamp(kept[0], unit="ms"),)

    def reported(self, kept):
        return kept[0], max(kept[1], kept[0] + self.max_wait_ms), True


def stalled_jobs_stream(
    status: DataFrame, max_wait_seconds: int, delay: str, keep_seconds: int = 7 * 86400
) -> DataFrame:
    """Streaming form: a job is reported once, when event time passes its limit without a terminal status.

    Ended and reported jobs are remembered for ``keep_seconds`` after their last report, so that later polls do
    not open them anew. ``status`` has job_id, status, ts.
    """
    polls = status.select("job_id", "status", "ts").withWatermark("ts", delay)
    return _by_buckets(polls, _Stalls(max_wait_seconds, keep_seconds), "job_id string, first_ts timestamp")


def drain_fresh(
    stream: DataFrame, ids: str, path: str, checkpoint: str, seen: str | None = None
) -> StreamingQuery:
    """Append to ``path`` the stream's rows whose id is not in the id table ``ids``; rows with an empty id pass.

    Each micro-batch is stored once and reads of the table only what its campaigns and ids can match. It is a batch
    plan, so a hot id is split by AQE and needs no copies of the table. With ``seen``, a second id table, of rows that
    repeat an id within the stream one passes: ids written by earlier batches are known from there. A batch that is run
    again after a failure writes its own folder again, and does not take its own ids for earlier ones.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            fresh = drop_known(batch, known_keys(spark, ids, batch))
            if seen is not None:
                has_id = F.coalesce(F.col("source_id") != "", F.lit(False))
                earlier = known_keys(spark, seen, batch, before=number)
                first = drop_known(fresh.where(has_id), earlier).dropDuplicates(list(ID_COLUMNS))
                fresh = first.unionByName(fresh.where(~has_id))
            fresh.write.mode("overwrite").parquet(f"{path}/batch={number}")
            if seen is not None:
                append_ids(spark.read.schema(batch.schema).parquet(f"{path}/batch={number}"), seen, number)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], newest: Sequence[str]
) -> StreamingQuery:
    """Append each micro-batch's newest row per key to the index.

    A batch that is run again after a failure appends equal rows; readers keep
    one per key, so the result is the same.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_index(latest(batch, key, newest), path)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_stats(stream: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running counts per group; partial counts are combined before the shuffle."""
    return stream.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def publish_view(
    view: DataFrame, path: str, checkpoint: str, key: Sequence[str], every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Write the changed rows of an aggregate, batch by batch, and compact them; see ``read_view``.

    Batches are written to the folder of their generation, ``every`` batches long; a batch that is run again writes its
    own folder again. At the end of a generation the newest row per key of the base and the generation becomes the next
    base, in a folder of its own, and then the pointer moves on. Of its two slots the older one is written, so a crash at
    any place leaves a valid pointer to complete data. Folders of earlier generations are not read any more.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        generation = number // every
        if _pointer(spark, path) > generation:  # run again after its generation was compacted
            return
        _batch_rows(batch, number).write.mode("overwrite").parquet(f"{path}/gen={generation}/batch={number}")
        if number % every == every - 1:
            compact_view(spark, path, key)

    return (
        view.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batch_rows(batch: DataFrame, number: int) -> DataFrame:
    return batch.withColumn("_batch", F.lit(number).cast("bigint"))


def compact_view(spark: SparkSession, path: str, key: Sequence[str]) -> None:
    """Close the current generation of a published view: its newest rows become the base of the next one."""
    generation = _pointer(spark, path)
    rows = _view_rows(spark, path, generation)
    latest(rows, key, ["_batch"]).write.mode("overwrite").parquet(f"{path}/base={generation + 1}")
    # The next generation's folder is there before readers look for it.
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/gen={generation + 1}/batch=none")
    _move_pointer(spark, path, generation + 1)


def _slots(path: str) -> list[str]:
    return [f"{path}/pointer={slot}" for slot in (0, 1)]


def _pointer(spark: SparkSession, path: str) -> int:
    """The current generation: the higher of the complete slots, 0 before the first compaction."""
    found = [0]
    for slot in _slots(path):
        try:
            found += [r.generation for r in spark.read.schema("generation bigint").parquet(slot).collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return max(found)


def _move_pointer(spark: SparkSession, path: str, generation: int) -> None:
    spark.range(generation, generation + 1, 1, 1).select(F.col("id").alias("generation")).write.mode("overwrite").parquet(
        _slots(path)[generation % 2]
    )


def _view_rows(spark: SparkSession, path: str, generation: int) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/gen={generation}")
    if generation:
        rows = rows.unionByName(spark.read.parquet(f"{path}/base={generation}"))
    return rows


def read_view(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Current rows of a published view: each key's newest row in the base and the batches after it.

    A read costs the base and fewer than ``every`` batches, however many were published.
    """
    rows = _view_rows(spark, path, _pointer(spark, path))
    return latest(rows, key, ["_batch"]).drop("_batch")
