"""Detection responses."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold import schemas
from framefold.constants import UNKNOWN_ERROR
from framefold.functions.documents import parse_once
from framefold.functions.times import ms_to_sec


def parse_responses(raw: DataFrame, body: str = "body") -> DataFrame:
    """Parse each response page once: status, message, duration, labels, moderation.

    ``labels`` is the page's normalised label array; a page without labels keeps
    an empty array, so its job is not lost.
    """
    return _parsed(raw, body, schemas.DETECTION_BODY, normalized_label, _no_labels())


def parse_label_facts(raw: DataFrame, body: str = "body") -> DataFrame:
    """The same with labels of name and confidence only, as summaries need them."""

    def label(r: Column) -> Column:
        return F.struct(_name(r).alias("name"), _confidence(r).alias("confidence"))

    none = F.array().cast("array<struct<name:string,confidence:double>>")
    return _parsed(raw, body, schemas.DETECTION_FACTS, label, none)


def _parsed(
    raw: DataFrame, body: str, ddl: str, label: Callable[[Column], Column], no_labels: Column
) -> DataFrame:
    keep = [c for c in raw.columns if c != body]
    r = F.col("_r")
    none = F.array().cast("array<variant>")
    return parse_once(raw, body, ddl, "_r").select(
        *keep,
        r["JobStatus"].alias("status"),
        r["StatusMessage"].alias("message"),
        ms_to_sec(r["VideoMetadata"]["DurationMillis"]).alias("duration"),
        F.coalesce(F.transform(r["Labels"], label), no_labels).alias("labels"),
        F.coalesce(r["ModerationLabels"], none).alias("moderation_labels"),
    )


def parse_status(raw: DataFrame, body: str = "body") -> DataFrame:
    """Only status and message of each response page: the parser skips the labels."""
    keep = [c for c in raw.columns if c != body]
    r = F.col("_r")
    return parse_once(raw, body, schemas.DETECTION_STATUS, "_r").select(
        *keep, r["JobStatus"].alias("status"), r["StatusMessage"].alias("message")
    )


def succeeded(status: str = "status") -> Column:
    return F.coalesce(F.col(status) == "SUCCEEDED", F.lit(False))


def gate_flags(df: DataFrame, status: str = "status", message: str = "message") -> DataFrame:
    """The gate in one pass: ``ok``, and ``reason`` where it is false."""
    reason = F.when(~succeeded(status), F.coalesce(message, F.lit(UNKNOWN_ERROR)))
    return df.withColumns({"ok": succeeded(status), "reason": reason})


def land_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write parsed pages and read them back, so that several outputs share one parse."""
    pages.write.mode("overwrite").parquet(path)
    return pages.sparkSession.read.schema(pages.schema).parquet(path)


def normalized_label(raw: Column) -> Column:
    """name '' / confidence 0 / timestamp in seconds or NULL / instances [] by default."""
    return F.struct(
        _name(raw).alias("name"),
        _confidence(raw).alias("confidence"),
        ms_to_sec(raw["Timestamp"]).alias("timestamp"),
        F.coalesce(raw["Label"]["Instances"], F.array().cast("array<variant>")).alias("instances"),
    )


def _name(raw: Column) -> Column:
    return F.coalesce(raw["Label"]["Name"], F.lit(""))


def _confidence(raw: Column) -> Column:
    return F.coalesce(raw["Label"]["Confidence"], F.lit(0.0))


def _no_labels() -> Column:
    return F.array().cast(
        "array<struct<name:string,confidence:double,timestamp:double,instances:array<variant>>>"
    )


def scan_detections(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per detection of parsed pages; a page without any keeps one row with pos NULL."""
    return pages.select(*keys, F.posexplode_outer("labels").alias("pos", "label")).select(
        *keys, "pos", "label.*"
    )


def gate_succeeded(
    df: DataFrame, status: str = "status", message: str = "message"
) -> tuple[DataFrame, DataFrame]:
    """Rows with status SUCCEEDED, and the others with a reason."""
    ok = succeeded(status)
    rejects = df.where(~ok).withColumn("reason", F.coalesce(message, F.lit(UNKNOWN_ERROR)))
    return df.where(ok), rejects
