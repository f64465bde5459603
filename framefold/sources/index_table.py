"""The media index.

Updates are appended and the newest row per key wins when reading, so an upsert
costs as much as its batch, not as much as the table. The key includes the
partition columns; a filter on them prunes folders before the newest-row step.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold import schemas
from framefold.functions.documents import json_or_empty
from framefold.functions.times import add_days_epoch, iso_ts
from framefold.operators.ranking import latest

PARTITIONS = ("media_type", "campaign")
KEY = (*PARTITIONS, "s3_key")
NEWEST = ("processed_at", "metadata", "processed_key", "ingested_at")


def stamp_index(df: DataFrame, now: Column, ttl_days: int = 365) -> DataFrame:
    """Add processed_at (ISO text) and ttl (epoch seconds) of ``now``."""
    return df.withColumns({"processed_at": iso_ts(now), "ttl": add_days_epoch(now, ttl_days)})


def append_index(rows: DataFrame, path: str) -> None:
    """Append index rows; rebalancing splits a hot campaign over several files."""
    (
        rows.hint("rebalance", *PARTITIONS)
        .write.mode("append")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_index(
    spark: SparkSession,
    path: str,
    campaign: str | None = None,
    media_type: str | None = None,
    key: Sequence[str] = KEY,
    now: Column | int | None = None,
) -> DataFrame:
    """Newest row per key with metadata decoded; campaign and type prune partitions.

    With ``now`` (epoch seconds) keys whose newest row has expired are left out.
    """
    stored = filter_index(_log(spark, path), campaign, media_type)
    return decode_metadata(_current(stored, key, now))


def read_indexed_ids(
    spark: SparkSession,
    path: str,
    campaigns: Collection[str] | None = None,
    media_type: str | None = None,
    now: Column | int | None = None,
) -> DataFrame:
    """Distinct (media_type, campaign, source, source_id) of the index, for duplicate suppression.

    An id is known by any of its rows, so no newest row is looked for and only these columns are read.
    With ``now`` an id is known as long as one of its rows has not expired.
    """
    stored = filter_index(_log(spark, path), None, media_type)
    if campaigns is not None:
        stored = stored.where(F.col("campaign").isin(*campaigns))
    if now is not None:
        stored = unexpired(stored, now)
    return stored.where(F.col("source_id") != "").select("media_type", "campaign", "source", "source_id").distinct()


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_schema(spark)).parquet(path)


def _current(stored: DataFrame, key: Sequence[str], now: Column | int | None) -> DataFrame:
    newest = latest(stored, key, NEWEST)
    return newest if now is None else unexpired(newest, now)


def _schema(spark: SparkSession):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schemas.INDEX)


def decode_metadata(df: DataFrame, column: str = "metadata") -> DataFrame:
    return df.withColumn("metadata_doc", json_or_empty(column))


def upsert_index(
    existing: DataFrame,
    updates: DataFrame,
    key: Sequence[str] = KEY,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """Existing and new rows with put-item semantics: the newest per key stays."""
    return latest(existing.unionByName(updates, allowMissingColumns=True), key, newest)


def compact_index(
    spark: SparkSession, path: str, out_path: str, key: Sequence[str] = KEY, now: Column | int | None = None
) -> None:
    """Rewrite the newest rows to a new folder, with ``now`` the unexpired ones only; readers switch when it is complete."""
    append_index(_current(_log(spark, path), key, now), out_path)


def filter_index(
    df: DataFrame, campaign: str | None = None, media_type: str | None = None
) -> DataFrame:
    if campaign:
        df = df.where(F.col("campaign") == campaign)
    if media_type:
        df = df.where(F.col("media_type") == media_type)
    return df


def query_index(
    df: DataFrame,
    campaign: str | None = None,
    media_type: str | None = None,
    limit: int | None = 100,
    now: Column | int | None = None,
) -> DataFrame:
    """Filter first, with ``now`` also expired records, then the newest ``limit`` records."""
    found = filter_index(df, campaign, media_type)
    if now is not None:
        found = unexpired(found, now)
    if limit is None:
        return found
    return found.orderBy(F.col("processed_at").desc(), "s3_key").limit(limit)


def unexpired(df: DataFrame, now_epoch: Column | int) -> DataFrame:
    now = now_epoch if isinstance(now_epoch, Column) else F.lit(now_epoch)
    return df.where(F.col("ttl") > now)
