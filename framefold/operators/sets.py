"""Unions and the campaign catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framefold.constants import PREDEFINED_CAMPAIGNS, RETIRED_SOURCES, SOURCES
from framefold.functions.text import segment, starts


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a source lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def campaign_catalogue(
    keys: DataFrame,
    key: str = "key",
    predefined: Sequence[str] = PREDEFINED_CAMPAIGNS,
    source_names: Sequence[str] = (*SOURCES, *RETIRED_SOURCES),
) -> DataFrame:
    """Campaigns seen in raw keys, without source names and blanks, plus the predefined ones."""
    seen = (
        keys.where(starts(key, "media-raw/video/"))
        .select(segment(key, "/", 4).alias("campaign"))
        .where((F.col("campaign") != "") & ~F.col("campaign").isin(*source_names))
        .distinct()
    )
    fixed = keys.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, predefined))).alias("campaign")
    )
    return seen.union(fixed).distinct().orderBy("campaign")
