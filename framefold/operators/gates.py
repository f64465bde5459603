"""Required-field gate (P18) and the rejects layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have every column non-empty, and the rest with the missing ones named."""
    missing = F.concat_ws(",", *[F.when(_empty(c), F.lit(c)) for c in cols])
    bad = _empty(cols[0])
    for c in cols[1:]:
        bad = bad | _empty(c)
    return df.where(~bad), df.where(bad).withColumn("reason", F.concat(F.lit("missing "), missing))


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string") == "", F.lit(True))


def rejects(stage: str, df: DataFrame, key: str) -> DataFrame:
    """Common layout of rejected rows: stage, key, reason."""
    return df.select(F.lit(stage).alias("stage"), F.col(key).alias("key"), "reason")
