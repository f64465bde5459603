"""Counts, batch envelopes and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framefold.constants import BOTH_SOURCES_TEXT
from framefold.functions.text import ends, has, starts


def source_dim(spark: SparkSession, sources: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, sources))).alias("source"))


def source_counts(assets: DataFrame, sources: Sequence[str], source: str = "source") -> DataFrame:
    """Rows per source; listed sources without rows count zero."""
    counted = assets.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("ingested_count")
    )
    zero = source_dim(assets.sparkSession, sources).withColumn(
        "ingested_count", F.lit(0).cast("bigint")
    )
    return (
        counted.unionByName(zero)
        .groupBy("source")
        .agg(F.sum("ingested_count").alias("ingested_count"))
    )


def total_ingested(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("ingested_count"), F.lit(0)).alias("ingested_count"))


def numbered(df: DataFrame, group: Sequence[str], chunk: str, order: Sequence[str], name: str = "pos") -> DataFrame:
    """Number the rows of each group from 0, by ``chunk`` and then by ``order``.

    Rows are ranked inside their chunk, such as one response; a chunk's first number is the sum of the
    counts of the chunks before it. So a group with much of the data is ranked in as many parts as it has chunks.
    """
    counts = df.groupBy(*group, chunk).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*group, chunk, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    within = Window.partitionBy(*group, chunk).orderBy(*order)
    keys = [*group, chunk]
    firsts = firsts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_first")
    ranked = df.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(firsts, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    return joined.withColumn(name, F.col("_first") + F.col("_rank")).drop(
        "_first", "_rank", *[f"_k{i}" for i in range(len(group) + 1)]
    )


def metadata_by_source(
    assets: DataFrame,
    batch: Sequence[str],
    pos: str,
    fields: Sequence[str],
    chunk_size: int = 1000,
) -> DataFrame:
    """Ordered metadata lists per batch and source, in chunks of at most ``chunk_size``.

    ``pos`` numbers the assets of a group; batches up to the chunk size give one row.
    """
    chunk = F.floor(F.col(pos) / F.lit(chunk_size)).cast("bigint").alias("chunk")
    item = F.struct(F.col(pos).alias("pos"), F.struct(*fields).alias("item"))
    return (
        assets.groupBy(*batch, "source", chunk)
        .agg(F.array_sort(F.collect_list(item)).alias("_items"))
        .select(*batch, "source", "chunk", F.transform("_items", lambda x: x["item"]).alias("items"))
    )


def batch_result(
    assets: DataFrame,
    batch_size: int,
    sources: Sequence[str],
    video_source: str | None = None,
    batch: str = "campaign",
    batches: DataFrame | None = None,
) -> DataFrame:
    """Envelope per batch: size, source description, total and counts per source.

    ``batches`` lists batches that must have an envelope even if they found nothing; its column
    ``batch_size``, if there is one, overrides the common size.
    """
    zero = F.lit(0).cast("bigint")
    counts = assets.groupBy(batch).agg(
        F.count(F.lit(1)).alias("ingested_count"),
        *[F.count_if(F.col("source") == s).alias(f"_{i}") for i, s in enumerate(sources)],
    )
    size = F.lit(batch_size).cast("bigint")
    if batches is not None:
        asked = batches.select(batch, *[c for c in batches.columns if c == "batch_size"]).dropDuplicates([batch])
        counts = counts.join(asked, batch, "full")
        if "batch_size" in batches.columns:
            size = F.coalesce(F.col("batch_size").cast("bigint"), size)
    pairs = [x for i, s in enumerate(sources) for x in (F.lit(s), F.coalesce(f"_{i}", zero))]
    return counts.select(
        batch,
        size.alias("batch_size"),
        F.lit(video_source or BOTH_SOURCES_TEXT).alias("video_source"),
        F.coalesce("ingested_count", zero).alias("ingested_count"),
        F.create_map(*pairs).alias("source_counts"),
    )


def batch_documents(envelopes: DataFrame, lists: DataFrame, batch: str = "campaign") -> DataFrame:
    """Envelopes with the metadata lists of ``metadata_by_source``, one row per batch and chunk."""
    nested = lists.groupBy(batch, "chunk").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "items")))).alias(
            "metadata_by_source"
        )
    )
    return envelopes.join(nested, batch, "left").withColumn(
        "metadata", F.flatten(F.map_values("metadata_by_source"))
    )


def outcome_counts(flagged: DataFrame, batch: str, ok: str = "ok") -> DataFrame:
    """Successes and rejects per batch, from one flag per row."""
    return flagged.groupBy(batch).agg(
        F.count_if(ok).alias("processed_count"), F.count_if(~F.col(ok)).alias("rejected_count")
    )


def lake_stats(
    objects: DataFrame, index: DataFrame, sources: Sequence[str], exact: bool = False
) -> DataFrame:
    """One row: raw and processed totals, and both per source.

    Raw counts objects below each source's folder; processed counts index
    records mentioning the source, and the processed total counts all records.
    """

    raw_key, done_key = F.col("_raw"), F.col("_done")

    def in_folder(s: str) -> Column:
        return starts(raw_key, f"media-raw/video/{s}/") & ~ends(raw_key, "/")

    def mentions(s: str) -> Column:
        return starts(done_key, f"media-raw/video/{s}/") if exact else has(done_key, s)

    def side(df: DataFrame, key: str, name: str, other: str) -> DataFrame:
        present = F.coalesce(F.col(key), F.lit("")).alias(name)
        return df.select(present, F.lit(None).cast("string").alias(other))

    both = side(objects, "key", "_raw", "_done").unionByName(side(index, "s3_key", "_done", "_raw"))
    counted = both.agg(
        F.count("_done").alias("processed_total"),
        *[F.count_if(in_folder(s)).alias(f"raw_{s}") for s in sources],
        *[F.count_if(mentions(s)).alias(f"processed_{s}") for s in sources],
    )
    total = sum((F.col(f"raw_{s}") for s in sources[1:]), F.col(f"raw_{sources[0]}"))
    return counted.withColumn("raw_total", total)


def source_rollup(df: DataFrame, source: str = "source") -> DataFrame:
    """Counts per source and in total (source NULL)."""
    return df.rollup(source).agg(F.count(F.lit(1)).alias("n"))


def campaigns_in(df: DataFrame) -> DataFrame:
    return df.select("campaign").distinct().orderBy("campaign")


def any_running(df: DataFrame, status: str = "status") -> DataFrame:
    flag = F.bool_or(F.col(status) == "RUNNING")
    return df.agg(F.coalesce(flag, F.lit(False)).alias("any_running"))
