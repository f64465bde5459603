"""Top-k, quotas and newest-row operators.

All are ``row_number() <= k`` with a literal k. Spark then keeps only k rows per
key in every map partition before the shuffle (WindowGroupLimit), so a key that
holds a third of all rows sends at most k rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def _ranked(df: DataFrame, keys: Sequence, order: Sequence, k: int, name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def top_k(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    pos: Sequence[str],
    k: int = 10,
    name: str | None = None,
    rank: str = "rank",
) -> DataFrame:
    """The k highest ``by`` per group, ties in ``pos`` order, with their rank.

    ``name`` keeps only the best row per name first (distinct names).
    """
    order = [F.col(by).desc(), *pos]
    if name is not None:
        df = _ranked(df, [*group, name], order, 1, _RN).drop(_RN)
    return _ranked(df, group, order, k, rank)


def quota_limit(
    df: DataFrame, quota: int, partition: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first ``quota`` rows per partition."""
    return _ranked(df, partition, order, quota, _RN).drop(_RN)


def per_source_quota(batch: int, n_sources: int) -> int:
    return max(1, batch // n_sources)


def filter_then_limit(df, condition: Column, quota: int, partition, order) -> DataFrame:
    return quota_limit(df.where(condition), quota, partition, order)


def limit_then_filter(df, condition: Column, quota: int, partition, order) -> DataFrame:
    return quota_limit(df, quota, partition, order).where(condition)


def recent(df: DataFrame, n: int, start: str = "start", tie: str = "arn") -> DataFrame:
    """The n latest rows; planned as a top-n without a full sort."""
    return df.orderBy(F.col(start).desc(), F.col(tie).desc()).limit(n)


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, NULLs last."""
    newest = [F.col(c).desc_nulls_last() for c in order]
    return _ranked(df, key, newest, 1, _RN).drop(_RN)


def browse(df: DataFrame, source: str, order: Sequence[str | Column], per_source: int = 20):
    return quota_limit(df, per_source, [source], order)
