"""Per-video summaries and label arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold.operators.ranking import top_k

_KEEP_NULLS = {"ignoreNullFields": "false"}


def label_counts(detections: DataFrame, video: str, pos: str) -> DataFrame:
    """Detections per video; a video whose only row has no position counts zero."""
    return detections.groupBy(video).agg(F.count(pos).alias("total_labels"))


def top_labels(
    detections: DataFrame,
    video: str,
    order: Sequence[str],
    k: int = 10,
    distinct_names: bool = False,
) -> DataFrame:
    """Long form: the k most confident detections per video with their rank."""
    return top_k(
        detections.where(F.col(order[-1]).isNotNull()),
        [video],
        "confidence",
        order,
        k,
        "name" if distinct_names else None,
    )


def summarize(
    detections: DataFrame, responses: DataFrame, video: str, order: Sequence[str], k: int = 10
) -> DataFrame:
    """One row per video: total_labels, top_labels, duration, has_moderation_issues.

    ``detections`` is the long form with ``order`` (page, position) columns,
    ``responses`` one row per response page with duration and moderation_labels.
    Counts and flags are pre-aggregated, the ranking keeps k rows per video and
    partition, so no group of detections is ever gathered; the array holds k
    entries. Both sides of the joins are already partitioned by video.
    """
    per_video = responses.groupBy(video).agg(*_page_facts())
    counted = per_video.join(label_counts(detections, video, order[-1]), video, "left")
    return _with_top(counted, top_labels(detections, video, order, k), video)


def reduce_pages(pages: DataFrame, keep: Sequence[str], k: int = 10, texts: bool = False) -> DataFrame:
    """What a summary needs of each response page: ``duration, flagged, n_labels, best``.

    ``best`` holds the page's k most confident labels with their place. With ``texts`` the page's labels and
    moderation labels follow as JSON texts without the outer brackets, for ``analysis_parts``. Land the result
    where it is used twice: one parse then serves summaries and documents, and a summary reads only its few columns.
    """
    ranked = F.slice(F.sort_array(F.transform("labels", _placed)), 1, k)
    best = F.transform(
        ranked, lambda x: F.struct(x["pos"].alias("pos"), x["name"].alias("name"), (-x["down"]).alias("confidence"))
    )
    return pages.select(
        *keep,
        "duration",
        (F.array_size("moderation_labels") > 0).alias("flagged"),
        F.array_size("labels").cast("bigint").alias("n_labels"),
        best.alias("best"),
        *([_inner_json("labels"), _inner_json("moderation_labels")] if texts else []),
    )


def _inner_json(column: str) -> Column:
    """The brackets are cut by bytes: characters would have to be counted from the start."""
    text = F.to_json(column, _KEEP_NULLS)
    return F.substring(text.cast("binary"), F.lit(2), F.octet_length(text) - 2).cast("string").alias(column)


def summarize_reduced(reduced: DataFrame, video: str, page: str, k: int = 10) -> DataFrame:
    """``summarize`` of reduced pages; videos without a label have a count of 0 and no top labels.

    The shuffles grow with pages, not with detections: counts and flags are summed before them, and k rows per
    video and partition are ranked after them.
    """
    counted = reduced.groupBy(video).agg(
        F.sum("n_labels").alias("total_labels"),
        F.max("duration").alias("duration"),
        F.coalesce(F.bool_or("flagged"), F.lit(False)).alias("has_moderation_issues"),
    )
    best = reduced.select(video, page, F.inline("best"))
    return _with_top(counted, top_labels(best, video, [page, "pos"], k), video)


def summarize_pages(pages: DataFrame, video: str, page: str, k: int = 10) -> DataFrame:
    """``summarize`` straight from parsed response pages."""
    return summarize_reduced(reduce_pages(pages, [video, page], k), video, page, k)


def _placed(label, i):
    """Struct that sorts by confidence descending, then response position."""
    return F.struct(
        (-label["confidence"]).alias("down"), i.alias("pos"), label["name"].alias("name")
    )


def _page_facts():
    flagged = F.bool_or(F.array_size("moderation_labels") > 0)
    return (
        F.max("duration").alias("duration"),
        F.coalesce(flagged, F.lit(False)).alias("has_moderation_issues"),
    )


def _with_top(counted: DataFrame, top: DataFrame, video: str) -> DataFrame:
    best = (
        top.groupBy(video)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "name", "confidence"))).alias("_top"))
        .select(video, F.transform("_top", _without_rank).alias("top_labels"))
    )
    no_labels = F.array().cast("array<struct<name:string,confidence:double>>")
    return counted.join(best, video, "left").select(
        video,
        F.coalesce("total_labels", F.lit(0).cast("bigint")).alias("total_labels"),
        F.coalesce("top_labels", no_labels).alias("top_labels"),
        "duration",
        "has_moderation_issues",
    )


def _without_rank(label):
    return F.struct(label["name"].alias("name"), label["confidence"].alias("confidence"))


def label_array(
    detections: DataFrame, video: str, chunk: str, pos: Sequence[str]
) -> DataFrame:
    """Label arrays per (video, chunk) in response order.

    ``chunk`` must bound the rows of a group, as a response page does, so a video
    with any number of labels becomes several rows, never one oversized array.
    """
    fields = ["name", "confidence", "timestamp", "instances"]
    label = F.struct(*[c for c in fields if c in detections.columns])
    placed = F.collect_list(F.struct(F.struct(*pos).alias("pos"), label.alias("l")))
    ordered = F.array_sort(placed, _by_position)
    return (
        detections.where(F.col(pos[-1]).isNotNull())
        .groupBy(video, chunk)
        .agg(ordered.alias("_labels"))
        .select(video, chunk, F.transform("_labels", lambda x: x["l"]).alias("labels"))
    )


def _by_position(a, b):
    """Instances have no order, so only positions are compared."""
    return F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)


def analysis_parts(
    reduced: DataFrame, summaries: DataFrame, video: str, page: str, name: str = "video_s3_key"
) -> DataFrame:
    """The texts that make up one JSON document per video, one after the other: ``video, section, text``.

    A document holds the video's key under ``name``, duration, all labels and moderation labels in response order,
    and the summary. ``reduced`` are pages of ``reduce_pages`` with texts. Pages and summaries are shuffled once to the
    video's partition, where a page gives two texts, and the frame three; they are sorted there, on disk where they are many. So no
    document is ever held as a whole, whatever the number of its labels. ``write_analysis`` writes them.
    """
    key = F.to_json(F.struct(F.col(video).alias(name), "duration"), _KEEP_NULLS)
    summary = F.struct("total_labels", "top_labels", "duration", "has_moderation_issues")

    def text(section: int, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), value.alias("text"))

    head = F.concat(F.substring(key, F.lit(1), F.length(key) - 1), F.lit(',"labels":['))
    tail = F.concat(F.lit('],"summary":'), F.to_json(summary, _KEEP_NULLS), F.lit("}\n"))
    page_type = reduced.schema[page].dataType
    # Both sides are spread alike, so their union needs no shuffle of its own.
    frame = summaries.repartition(video).select(
        video,
        F.lit(None).cast(page_type).alias(page),
        F.inline(F.array(text(0, head), text(2, F.lit('],"moderation_labels":[')), text(4, tail))),
    )
    body = (
        reduced.select(video, page, "labels", "moderation_labels")
        .where("labels <> '' OR moderation_labels <> ''")
        .repartition(video)
        .select(video, page, F.inline(F.array(text(1, F.col("labels")), text(3, F.col("moderation_labels")))))
        .where("text <> ''")
    )
    before = F.lag("section").over(Window.partitionBy(video).orderBy("section", page))
    follows = (F.col("section") % 2 == 1) & (F.col("section") == F.col("_before"))
    return (
        frame.unionByName(body)
        .withColumn("_before", before)
        .sortWithinPartitions(video, "section", page)
        .select(video, "section", F.when(follows, F.concat(F.lit(","), "text")).otherwise(F.col("text")).alias("text"))
    )
