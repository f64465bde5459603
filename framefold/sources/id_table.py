"""Indexed ids stored for duplicate suppression.

The table is partitioned by media type and campaign and bucketed by one key made of all id columns. Candidates
hashed by the same key meet their bucket in place: an anti join shuffles the batch and only reads the table. A
small batch reads no more than the partitions of its campaigns and the buckets of its keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold.operators.joins import existing_ids

ID_COLUMNS = ("media_type", "campaign", "source", "source_id")
PARTITIONS = ("media_type", "campaign", "batch")
BUCKETS = 64
#: Keys, and campaigns, of a batch up to which they are named in the filters of the table's scan.
NAMED = 1000


def id_key(columns: Sequence[str] = ID_COLUMNS) -> Column:
    """One text for all id columns, different for different ids: each part follows its length."""
    return F.concat(*[F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)) for c in columns])


def create_id_table(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Name the table stored at ``path``, which may be empty yet; sessions that read it name it alike."""
    columns = "id_key STRING, media_type STRING, campaign STRING, batch BIGINT"
    none = spark.createDataFrame([], columns)
    none.write.mode("append").partitionBy(*PARTITIONS).parquet(path)  # the folder
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}) "
        f"CLUSTERED BY (id_key) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def append_ids(rows: DataFrame, name: str, batch: int | None = None, buckets: int = BUCKETS) -> None:
    """Add the non-empty ids of index rows; an id may be added again. One task writes all of a bucket.

    Ids of a numbered ``batch`` replace what was written for it before, so that it can be run again.
    """
    keyed = existing_ids(rows, ID_COLUMNS).select(
        id_key().alias("id_key"), "media_type", "campaign", F.lit(-1 if batch is None else batch).cast("bigint").alias("batch")
    )
    mode = "static" if batch is None else "dynamic"
    writer = keyed.repartition(buckets, "id_key").write.option("partitionOverwriteMode", mode)
    writer.insertInto(name, overwrite=batch is not None)


def known_keys(
    spark: SparkSession, name: str, batch: DataFrame | None = None, before: int | None = None
) -> DataFrame:
    """``id_key`` of the table's ids, with ``before`` of lower batch numbers only.

    With ``batch`` only of those partitions and buckets that its ids can be in.
    Up to ``NAMED`` different campaigns, and keys, are looked up in the batch and named in the scan; beyond that the
    scan is not narrowed by them. The batch is read for it, so keep it stored.
    """
    ids = spark.table(name)
    if before is not None:
        ids = ids.where(F.col("batch") < before)
    if batch is not None:
        some = existing_ids(batch, ID_COLUMNS)
        campaigns = [r[0] for r in some.select("campaign").distinct().limit(NAMED + 1).collect()]
        if len(campaigns) <= NAMED:
            ids = ids.where(F.col("campaign").isin(campaigns))
        keys = [r[0] for r in some.select(id_key()).limit(NAMED + 1).collect()]
        if len(keys) <= NAMED:
            ids = ids.where(F.col("id_key").isin(keys))
    return ids.select("id_key")


def drop_known(candidates: DataFrame, keys: DataFrame, spread: int = 1024) -> DataFrame:
    """Candidates whose id is not among ``keys``; an empty id never matches.

    Rows with an empty id may be many, so they get keys of their own kind, which spread them.
    """
    empty = F.coalesce(F.col("source_id") == "", F.lit(True))
    none = F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(spread)).cast("string"))
    keyed = candidates.withColumn("id_key", F.when(empty, none).otherwise(F.coalesce(id_key(), none)))
    return keyed.join(keys, "id_key", "left_anti").select(*candidates.columns)
