"""Storage keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.constants import PROCESSED_ROOT, PROCESSED_SUFFIX, RAW_ROOT
from framefold.functions.text import (
    build,
    col,
    infer_ext,
    replace_all,
    safe_title,
    segment,
    segment_count,
)


def file_name(source, source_id, title) -> Column:
    source_id = F.coalesce(col(source_id), F.lit(""))
    middle = F.when(source_id != "", F.concat(source_id, F.lit("_"))).otherwise("")
    return F.concat(col(source), F.lit("_"), middle, safe_title(title))


def raw_key(source, source_id, title, campaign, batch_ts, mime, url, media_type="video") -> Column:
    """``media-raw/<type>/<source>/<campaign>/<batch time>/<file>.<ext>``."""
    return F.concat(
        F.lit(f"{RAW_ROOT}/{media_type}/"),
        build(source, campaign, batch_ts, file_name(source, source_id, title), sep="/"),
        F.lit("."),
        infer_ext(mime, url),
    )


def processed_key(key) -> Column:
    """Twin key of the analysis document; every occurrence is replaced."""
    out = replace_all(key, RAW_ROOT, PROCESSED_ROOT)
    for ext in (".mp4", ".webm"):
        out = replace_all(out, ext, PROCESSED_SUFFIX)
    return out


def parse_key(df: DataFrame, key: str) -> DataFrame:
    """Add key_source, key_campaign, key_ingested_at ('' when too short) and key_file."""
    return df.withColumns(
        {
            "key_source": segment(key, "/", 3),
            "key_campaign": segment(key, "/", 4),
            "key_ingested_at": F.when(
                segment_count(key, "/") >= 2, segment(key, "/", -2)
            ).otherwise(""),
            "key_file": segment(key, "/", -1),
        }
    )


def record_id(media_type, campaign, ingested_at) -> Column:
    return build(media_type, campaign, replace_all(ingested_at, "_", ""), sep="#")


def execution_id(arn) -> Column:
    return segment(arn, ":", -1)
