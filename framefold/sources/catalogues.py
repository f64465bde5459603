"""Catalogue responses to candidates.

Every step is a narrow projection, filter or explode; only the quota shuffles,
and it ranks inside each map partition before it does.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold import schemas
from framefold.constants import (
    CATALOGUE_A,
    CATALOGUE_B,
    CATALOGUE_B_LICENCE,
    DEFAULT_MIME,
    LICENCE_PREFIX,
    MIME_PREFIX,
    RENDITIONS,
)
from framefold.functions.documents import any_match
from framefold.functions.text import starts
from framefold.operators.ranking import quota_limit


def scan_catalogue_a(raw: DataFrame, body: str = "body") -> DataFrame:
    """One row per page, in response order; a response without pages gives none."""
    keep = [c for c in raw.columns if c != body]
    parsed = F.from_json(body, schemas.CATALOGUE_A_BODY)
    return raw.select(
        *keep, F.posexplode(parsed["query"]["pages"]).alias("pos", "page_id", "page")
    )


def scan_catalogue_b(raw: DataFrame, body: str = "body") -> DataFrame:
    """One row per hit, in response order; a response without hits gives none."""
    keep = [c for c in raw.columns if c != body]
    parsed = F.from_json(body, schemas.CATALOGUE_B_BODY)
    return raw.select(*keep, F.posexplode(parsed["hits"]).alias("pos", "hit"))


def unreadable(raw: DataFrame, body: str = "body") -> DataFrame:
    """Responses whose body is no JSON, without the body, and the reason."""
    bad = F.try_parse_json(body).isNull()
    return raw.where(bad).drop(body).withColumn("reason", F.lit("unreadable response"))


def first_imageinfo(pages: DataFrame) -> DataFrame:
    """Pages with at least one media description, the first as column ``info``."""
    info = F.get("page.imageinfo", F.lit(0))
    return pages.where(F.array_size("page.imageinfo") > 0).withColumn("info", info)


def filter_mime(df: DataFrame, mime: str = "info.mime", prefix: str = MIME_PREFIX) -> DataFrame:
    return df.where(starts(mime, prefix))


def filter_license(
    df: DataFrame, categories: str = "page.categories", prefix: str = LICENCE_PREFIX
) -> DataFrame:
    return df.where(any_match(categories, lambda cat: starts(cat["title"], prefix)))


def candidates_a(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    def extra(key: str) -> Column:
        return text(F.try_element_at("info.extmetadata", F.lit(key))["value"])

    title = text(F.col("page.title"))
    return df.select(
        *keep,
        "pos",
        F.lit(CATALOGUE_A).alias("source"),
        title.alias("source_id"),
        title.alias("title"),
        text(F.col("info.url")).alias("url"),
        F.coalesce("info.size", F.lit(0).cast("bigint")).alias("size"),
        text(F.col("info.mime")).alias("mime"),
        extra("Artist").alias("author"),
        extra("License").alias("license"),
        extra("ImageDescription").alias("description"),
        F.lit(None).cast("double").alias("duration"),
    )


def choose_rendition(hits: DataFrame, order: Iterable[str] = RENDITIONS) -> DataFrame:
    """Add url and size of the first rendition *present*; drop rows whose url is empty."""
    videos = F.col("hit.videos")
    chosen = F.lit(None)
    for name in reversed(list(order)):
        chosen = F.when(
            F.map_contains_key(videos, name), F.try_element_at(videos, F.lit(name))
        ).otherwise(chosen)
    return (
        hits.withColumn("_rendition", chosen)
        .withColumns(
            {
                "url": F.coalesce(F.col("_rendition")["url"], F.lit("")),
                "size": F.coalesce(F.col("_rendition")["size"], F.lit(0).cast("bigint")),
            }
        )
        .drop("_rendition")
        .where(F.col("url") != "")
    )


def candidates_b(df: DataFrame, keep: Iterable[str], campaign: str = "campaign") -> DataFrame:
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    return df.select(
        *keep,
        "pos",
        F.lit(CATALOGUE_B).alias("source"),
        F.coalesce(F.col("hit.id").cast("string"), F.lit("")).alias("source_id"),
        F.coalesce("hit.tags", campaign).alias("title"),
        "url",
        "size",
        F.lit(DEFAULT_MIME).alias("mime"),
        text("hit.user").alias("author"),
        F.lit(CATALOGUE_B_LICENCE).alias("license"),
        text("hit.tags").alias("description"),
        F.coalesce("hit.duration", F.lit(0.0)).alias("duration"),
    )


def read_catalogue_a(
    raw: DataFrame, quota: int | None = None, campaign: str = "campaign"
) -> DataFrame:
    """Licensed media of catalogue A: filter, then limit."""
    keep = [c for c in raw.columns if c != "body"]
    pages = filter_license(filter_mime(first_imageinfo(scan_catalogue_a(raw))))
    if quota is not None:
        pages = quota_limit(pages, quota, [campaign], _response_order(keep, campaign))
    return candidates_a(pages, keep)


def read_catalogue_b(
    raw: DataFrame, quota: int | None = None, campaign: str = "campaign"
) -> DataFrame:
    """Playable hits of catalogue B: limit, then filter, so fewer may come back."""
    keep = [c for c in raw.columns if c != "body"]
    hits = scan_catalogue_b(raw)
    if quota is not None:
        hits = quota_limit(hits, quota, [campaign], _response_order(keep, campaign))
    return candidates_b(choose_rendition(hits), keep, campaign)


def _response_order(keep: list[str], campaign: str) -> list[str]:
    return [c for c in keep if c != campaign] + ["pos"]


@dataclass(frozen=True)
class Source:
    """An adapter: raw responses to candidates; ``requires`` names what it needs to be used."""

    name: str
    read: Callable[..., DataFrame]
    requires: str | None = None


_REGISTRY: dict[str, Source] = {}


def register_source(name: str, read: Callable[..., DataFrame], requires: str | None = None) -> None:
    """Add or replace an adapter; ``read(raw, quota=None)`` must use native expressions only."""
    _REGISTRY[name] = Source(name, read, requires)


def registered_sources() -> dict[str, Source]:
    return dict(_REGISTRY)


def select_sources(requested: str | None, available: Collection[str] = ()) -> list[Source]:
    """Adapters of a batch.

    No or an unknown name means all of them; one whose requirement is not in
    ``available`` is skipped.
    """
    wanted = (requested or "").lower()
    chosen = [_REGISTRY[wanted]] if wanted in _REGISTRY else list(_REGISTRY.values())
    return [s for s in chosen if s.requires is None or s.requires in available]


register_source(CATALOGUE_A, read_catalogue_a)
register_source(CATALOGUE_B, read_catalogue_b, requires="catalogue_b_key")
