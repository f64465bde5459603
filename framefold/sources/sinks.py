"""Asset, analysis and notification outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.constants import SUBJECT_PREFIX


def write_assets(assets: DataFrame, path: str, mode: str = "append") -> None:
    """Asset rows by source and campaign; a hot campaign is split over files, small ones merged."""
    (
        assets.hint("rebalance", "source", "campaign")
        .write.mode(mode)
        .partitionBy("source", "campaign")
        .parquet(path)
    )


def write_analysis(parts: DataFrame, path: str, mode: str = "append", compression: str = "none") -> None:
    """One JSON document per video and line, from its texts in order (``analysis_parts``).

    The texts are written as they come, set apart by a blank, which JSON allows between its tokens; the last text of a
    document ends its line. No document is put together in memory. NULL fields are written. ``compression`` is
    a codec of Spark's text files; Spark reads them alike.
    """
    parts.select("text").write.mode(mode).option("lineSep", " ").option("compression", compression).text(path)


def notifications(df: DataFrame, prefix: str = SUBJECT_PREFIX) -> DataFrame:
    """Outbox rows (subject, message) of pipeline_type, campaign, status, execution_arn, error."""
    fields = ["pipeline_type", "campaign", "status", "execution_arn"]
    keep_nulls = {"ignoreNullFields": "false"}
    plain = F.to_json(F.struct(*fields), keep_nulls)
    failed = F.to_json(F.struct(*fields, "error"), keep_nulls)
    has_error: Column = F.coalesce(F.col("error") != "", F.lit(False))
    return df.select(
        F.format_string("%s %s: %s", F.lit(prefix), F.upper("pipeline_type"), F.col("status")).alias(
            "subject"
        ),
        F.when(has_error, failed).otherwise(plain).alias("message"),
    )
