"""Object listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold.functions.text import ends, has, segment, starts
from framefold.sources.executions import any_time
from framefold.sources.listing import ObjectListing


def scan_objects(spark: SparkSession, root: str, prefix: str | None = None, depth: int = 2) -> DataFrame:
    """key, length and modification time of all objects below ``root``; an absent folder has none.

    A prefix ending in ``/`` narrows the listing itself; the rest of it filters keys. The executors list the folders
    that lie ``depth`` levels below the prefix, each in a task of its own.
    """
    spark.dataSource.register(ObjectListing)
    folder = (prefix or "").rpartition("/")[0]
    listed = spark.read.format(ObjectListing.name()).options(path=root, folder=folder, depth=depth).load()
    return list_keys(listed, "key", prefix)


def scan_inventory(inventory: DataFrame, prefix: str | None = None) -> DataFrame:
    """The same from landed inventory rows (``key, size, last_modified``), as stores deliver them: no listing at all."""
    listed = inventory.select("key", F.col("size").cast("bigint").alias("length"), any_time("last_modified").alias("modified"))
    return list_keys(listed, "key", prefix)


def list_keys(df: DataFrame, key: str, prefix: str | None = None) -> DataFrame:
    """Keys below a prefix, directory markers left out."""
    kept = df.where(~ends(key, "/"))
    return kept.where(starts(key, prefix)) if prefix else kept


def with_file_size(df: DataFrame, size: str, content_length) -> DataFrame:
    """file_size: the declared size when there is one, else the length of the bytes."""
    return df.withColumn("file_size", F.coalesce(F.col(size), content_length).cast("bigint"))


def source_flags(
    df: DataFrame, key: str, sources: Sequence[str], exact: bool = False
) -> DataFrame:
    """One boolean ``is_<source>`` per source.

    By default a key belongs to every source it mentions; ``exact`` looks only
    at the source segment.
    """
    test = (
        (lambda s: F.coalesce(segment(key, "/", 3) == s, F.lit(False)))
        if exact
        else (lambda s: has(key, s))
    )
    return df.withColumns({f"is_{s}": test(s) for s in sources})
