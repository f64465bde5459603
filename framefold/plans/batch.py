"""The batch flow over landed data, all campaigns at once."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.constants import BATCH_TS_FORMAT
from framefold.functions.keys import processed_key, raw_key, record_id
from framefold.functions.text import default_if_empty
from framefold.operators.aggregates import batch_result, outcome_counts
from framefold.operators.detections import analysis_parts, reduce_pages, summarize_reduced
from framefold.operators.gates import rejects, require
from framefold.operators.joins import drop_indexed, join_responses, match_jobs
from framefold.operators.ranking import per_source_quota
from framefold.operators.sets import union_sources
from framefold.sources.catalogues import select_sources, unreadable
from framefold.sources.detections import gate_succeeded, parse_responses, succeeded
from framefold.sources.index_table import stamp_index
from framefold.sources.objects import with_file_size


def to_assets(
    candidates: DataFrame, batch_ts: Column, media_type: str = "video", keep: Sequence[str] = ()
) -> DataFrame:
    """Candidates as stored assets: defaults applied, storage key built. ``keep`` names further columns that stay."""
    title = F.coalesce("title", F.lit("untitled"))
    key = raw_key(
        "source", "source_id", title, "campaign", batch_ts, "mime", "url", media_type
    )
    return candidates.select(
        "campaign",
        "source",
        title.alias("title"),
        F.col("url").alias("file_url"),
        F.coalesce("license", F.lit("")).alias("license"),
        F.coalesce("author", F.lit("")).alias("author"),
        F.coalesce("description", F.lit("")).alias("description"),
        "duration",
        F.col("size").alias("file_size"),
        key.alias("s3_key"),
        batch_ts.alias("ingested_at"),
        "source_id",
        *keep,
    )


def with_object_sizes(assets: DataFrame, objects: DataFrame) -> DataFrame:
    """``file_size`` of the stored object where the catalogue gave none (null or 0); ``objects`` has key and length."""
    lengths = objects.select(F.col("key").alias("s3_key"), F.col("length").alias("_length"))
    declared = F.when(F.col("file_size") > 0, F.col("file_size"))
    sized = with_file_size(assets.join(lengths, "s3_key", "left").withColumn("_size", declared), "_size", F.col("_length"))
    return sized.select(*assets.columns)


@dataclass(frozen=True)
class BatchResult:
    """``envelopes`` and ``counts`` have one row per campaign; every asset is in ``index`` or in ``rejects``.

    ``analyses`` holds the texts of one document per video, for ``write_analysis``.
    """

    assets: DataFrame
    analyses: DataFrame
    index: DataFrame
    rejects: DataFrame
    counts: DataFrame
    envelopes: DataFrame | None = None


def ingest(
    responses: Mapping[str, DataFrame],
    index: DataFrame,
    batch_size: int,
    batch_ts: Column,
    requested: str | None = None,
    available: Collection[str] = (),
    media_type: str = "video",
) -> DataFrame | None:
    """Landed responses per source to new assets; None when no source is left.

    The quota limits what a source returns before duplicates are removed.
    """
    chosen = [s for s in select_sources(requested, available) if s.name in responses]
    if not chosen:
        return None
    quota = per_source_quota(batch_size, len(chosen))
    found = union_sources([s.read(responses[s.name], quota) for s in chosen])
    known = index.where(F.col("media_type") == media_type)
    fresh = drop_indexed(found, known, ["campaign", "source"])
    return to_assets(fresh, batch_ts, media_type)


def finish(
    assets: DataFrame,
    jobs: DataFrame,
    responses: DataFrame,
    now: Column,
    media_type: str = "video",
    store: Callable[[str, DataFrame], DataFrame] | None = None,
) -> BatchResult:
    """Assets with their jobs and detection responses to analyses, index rows and rejects.

    ``jobs`` has one row per job_id, ``responses`` one per job_id and page. An asset without key or job,
    an unanswered or a failed job becomes a reject; the others go on.
    """
    # Repeats inside a batch share their storage key: one stored object, one index row.
    keyed, no_key = require(assets, ["s3_key"])
    stored = keyed.select("s3_key", "campaign", "source", "source_id", "ingested_at").dropDuplicates(["s3_key"])
    started, no_job = match_jobs(stored.select("s3_key", "campaign"), jobs)
    started = started.select("job_id", "s3_key", "campaign")
    pages = parse_responses(responses)
    if store is not None:
        started, pages = store("jobs", started), store("pages", pages)
    answered, unanswered = join_responses(started, pages)
    done, failed = gate_succeeded(answered)
    reduced = reduce_pages(done, ["s3_key", "page"], texts=True)
    if store is not None:
        reduced = store("reduced", reduced)
    summaries = summarize_reduced(reduced, "s3_key", "page")
    documents = analysis_parts(reduced, summaries, "s3_key", "page")
    indexed = stored.join(summaries, "s3_key").select(
        record_id(F.lit(media_type), "campaign", "ingested_at").alias("id"),
        F.lit(media_type).alias("media_type"),
        "campaign",
        "s3_key",
        processed_key("s3_key").alias("processed_key"),
        "ingested_at",
        F.to_json(
            F.struct("total_labels", "top_labels", "duration", "has_moderation_issues"),
            {"ignoreNullFields": "false"},
        ).alias("metadata"),
        "source",
        default_if_empty("source_id", "").alias("source_id"),
    )
    found_as = F.concat_ws("/", "campaign", "source", F.nullif("source_id", F.lit("")))
    dropped = union_sources(
        [
            rejects("start", no_key.withColumn("found_as", found_as), "found_as"),
            rejects("start", no_job, "s3_key"),
            rejects("finalize", unanswered, "s3_key"),
            rejects("finalize", failed, "s3_key").distinct(),
        ]
    )
    # One row per job: it counts as processed if a page of it succeeded, as the index does.
    flags = answered.groupBy("job_id", "campaign").agg(F.bool_or(succeeded()).alias("ok"))
    lost = [d.select("campaign", F.lit(False).alias("ok")) for d in (no_key, no_job, unanswered)]
    counts = outcome_counts(union_sources([flags.select("campaign", "ok"), *lost]), "campaign")
    return BatchResult(assets, documents, stamp_index(indexed, now), dropped, counts)


def run_batch(
    responses: Mapping[str, DataFrame],
    index: DataFrame,
    jobs: DataFrame | Callable[[DataFrame], DataFrame],
    detections: DataFrame | Callable[[DataFrame], DataFrame],
    batch_size: int,
    now: Column,
    requested: str | None = None,
    available: Collection[str] = (),
    store: Callable[[str, DataFrame], DataFrame] | None = None,
    objects: DataFrame | None = None,
) -> BatchResult | None:
    """The whole flow; None when no source is available.

    ``index`` needs only the four id columns of ``read_indexed_ids``. Every campaign with a response has an
    envelope, also if it found nothing; a response that is no JSON becomes a reject. ``objects`` (key,
    length) gives sizes that the catalogue lacks.

    ``store(name, df)`` may write a stage's table and return it as read back, so
    that several outputs do not repeat the stages before it. ``jobs`` and
    ``detections`` may be functions of the assets.
    """
    batch_ts = F.date_format(now, BATCH_TS_FORMAT)
    assets = ingest(responses, index, batch_size, batch_ts, requested, available)
    if assets is None:
        return None
    if objects is not None:
        assets = with_object_sizes(assets, objects)
    if store is not None:
        assets = store("assets", assets)
    started = jobs(assets) if callable(jobs) else jobs
    answers = detections(assets) if callable(detections) else detections
    result = finish(assets, started, answers, now, store=store)
    chosen = [s.name for s in select_sources(requested, available) if s.name in responses]
    campaigns = union_sources([responses[s].select("campaign") for s in chosen]).distinct()
    envelopes = batch_result(assets, batch_size, chosen, requested, batches=campaigns)
    broken = [
        rejects("ingest", unreadable(responses[s]).withColumn("at", F.concat_ws("/", "campaign", F.lit(s), "response")), "at")
        for s in chosen
    ]
    return replace(result, envelopes=envelopes, rejects=union_sources([result.rejects, *broken]))
