"""Equi-joins of the batch.

No side is broadcast by hint: Spark broadcasts one only when its measured size
is below the threshold, and splits skewed partitions of the larger side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.operators.ranking import latest

SPREAD = 1024


def existing_ids(
    index: DataFrame, keys: Sequence[str] = ("media_type", "campaign", "source", "source_id")
) -> DataFrame:
    """Distinct non-empty ids already indexed; duplicates are dropped before the shuffle."""
    return index.where(F.col("source_id") != "").select(*keys).distinct()


def drop_indexed(
    candidates: DataFrame,
    index: DataFrame,
    keys: Sequence[str] = ("media_type", "campaign", "source"),
    source_id: str = "source_id",
) -> DataFrame:
    """Candidates whose id is not indexed yet; an empty id never matches.

    Rows with an empty id may be many, so they are spread over the join's
    partitions instead of meeting in one.
    """
    known = existing_ids(index, (*keys, source_id)).withColumnRenamed(source_id, "_id")
    known = known.withColumn("_empty", F.lit(False))
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string")
    empty = F.coalesce(F.col(source_id) == "", F.lit(True))
    left = candidates.withColumns(
        {"_empty": empty, "_id": F.when(empty, spread).otherwise(F.col(source_id))}
    )
    return left.join(known, [*keys, "_id", "_empty"], "left_anti").select(*candidates.columns)


def join_jobs(assets: DataFrame, jobs: DataFrame, key: str = "s3_key") -> DataFrame:
    """Assets with their detection job; assets without a key are left out."""
    started = jobs.select(
        "job_id",
        F.col("status").alias("job_status"),
        F.col("video_s3_key").alias(key),
        "video_s3_bucket",
    )
    return assets.where(F.col(key) != "").join(started, key, "inner")


def match_jobs(assets: DataFrame, jobs: DataFrame, key: str = "s3_key") -> tuple[DataFrame, DataFrame]:
    """Assets with their job, and those that got none with the reason; one join serves both."""
    started = jobs.select("job_id", F.col("video_s3_key").alias(key))
    matched = assets.join(started, key, "left")
    missing = F.coalesce(F.col("job_id") == "", F.lit(True))
    return matched.where(~missing), matched.where(missing).withColumn("reason", F.lit("no job"))


def join_responses(
    jobs: DataFrame, responses: DataFrame, key: str = "job_id"
) -> tuple[DataFrame, DataFrame]:
    """Jobs with their response pages, and jobs without any."""
    missing = jobs.join(responses.select(key).distinct(), key, "left_anti")
    return jobs.join(responses, key, "inner"), missing.withColumn("reason", F.lit("no response"))


def latest_status(events: DataFrame, key: str = "job_id", order: Sequence[str] = ("ts",)):
    return latest(events, [key], order)


def join_status(jobs: DataFrame, events: DataFrame, key: str = "job_id", order=("ts",)):
    """Every job with its latest status, NULL when never polled."""
    status = latest_status(events, key, order)
    return jobs.join(status, key, "left")


def reconcile(raw: DataFrame, processed: DataFrame, by: str = "source") -> DataFrame:
    """Counts of both sides per source; each side is aggregated before the join."""
    left = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw"))
    right = processed.groupBy(by).agg(F.count(F.lit(1)).alias("processed"))

    def zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint")).alias(name)

    return left.join(right, by, "full").select(by, zero("raw"), zero("processed"))
