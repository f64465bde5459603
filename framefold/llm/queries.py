"""The queries of the corpus operators and their reference SQL."""

from __future__ import annotations

from framefold.llm import (  # noqa: F401
    fingerprints,
    language,
    line_quality,
    mixing,
    packing,
    periodic_runs,
    pii,
    positional_index,
    sharding,
    simhash_dedup,
    token_alignment,
    toxicity,
    unigram_lattice,
)
from framefold.llm.common import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
