"""Periodic runs of words and texts without their repetitions.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that cannot be
extended on either side. The suffixes of a text are united into classes by decreasing length of their
longest common prefix, over a union-find whose classes keep their positions in order. Two positions
``i < j`` that become neighbours when classes are united at prefix length ``l`` have exactly that common
prefix; at a distance ``d = j - i`` of at most ``l`` the words ``i`` to ``j + l - 1`` have the smallest
period ``d``. Such a pair is a run if the words before ``i`` and ``j`` differ.

A run of at least ``min_words`` words and ``min_periods`` periods needs ``l >= (min_periods - 1) * d`` and
``l + d >= min_words``, so only common prefixes of at least ``min_words * (min_periods - 1) / min_periods``
words are united. Texts without such a repeat are told by the classes of their word groups of doubled
length and never sorted; most texts are of that kind.

Texts are worked on in pieces of a few megabytes of an Arrow batch, each text in one task. Memory follows
the piece or, where a single text is longer, that text: some 100 bytes a word, and 4 more for each doubling
of its longest repeat.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold.llm.common import documents, query
from framefold.llm.words import UNSPACED, Words, pieces

MIN_WORDS, MIN_PERIODS = 24, 3

RUNS = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def texts_with_repeats(codes: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the texts in which some group of ``length`` words, or of the power of two below, occurs twice."""
    rank = pd.factorize(doc * (np.int64(codes.max(initial=0)) + 1) + codes)[0]
    at, size = np.arange(len(codes)), 1
    while True:
        at = at[np.bincount(rank[at], minlength=1)[rank[at]] > 1] if len(at) else at
        if 2 * size > length or not len(at):
            return np.unique(doc[at])
        alive = np.full(len(codes) + size, -1)
        alive[at] = rank[at]
        at = at[(alive[at + size] >= 0)]
        rank = np.full(len(codes), -1)
        rank[at] = pd.factorize(alive[at] * len(codes) + alive[at + size])[0]
        size *= 2


def suffix_neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of all suffixes, and the length of their common prefix."""
    n = len(codes)
    ranks, size = [np.unique(codes, return_inverse=True)[1]], 1
    while n and ranks[-1].max() < n - 1:
        follow = np.zeros(n, np.int64)
        follow[:-size] = ranks[-1][size:] + 1
        ranks.append(np.unique(ranks[-1] * np.int64(n + 1) + follow, return_inverse=True)[1])
        ranks[-2] = ranks[-2].astype(np.int32)
        size *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    left, right = order[:-1], order[1:]
    common = np.zeros(max(n - 1, 0), np.int64)
    for rank in reversed(ranks[:-1]):
        size //= 2
        a, b = left + common, right + common
        inside = np.maximum(a, b) < n
        equal = np.zeros(len(a), bool)
        equal[inside] = rank[a[inside]] == rank[b[inside]]
        common[equal] += size
    return left, right, common


class _Classes:
    """Union-find over positions; every class keeps its positions in order."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.setdefault(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def unite(self, x: int, y: int) -> list[tuple[int, int]]:
        """Unite two classes; the pairs of positions that are neighbours from now on."""
        x, y = self.find(x), self.find(y)
        large, small = self.members.pop(x, None) or [x], self.members.pop(y, None) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        fresh = []
        before = -1
        for k, value in enumerate(small):
            at = bisect_left(large, value)
            if at and large[at - 1] > before:
                fresh.append((large[at - 1], value))
            if at < len(large) and (k + 1 == len(small) or large[at] < small[k + 1]):
                fresh.append((value, large[at]))
            before = value
        if len(small) == 1 and large[-1] > small[0]:
            large.insert(bisect_left(large, small[0]), small[0])
        else:
            ordered = large[-1] < small[0]
            large += small
            if not ordered:
                large.sort()
        self.parent[y] = x
        self.members[x] = large
        return fresh


def runs_of(codes: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers, by start, then period.

    Words of different texts must have different numbers; then several texts may stand one after the other.
    """
    least = -(-min_words * (min_periods - 1) // min_periods)
    left, right, common = suffix_neighbours(codes)
    edges = np.flatnonzero(common >= max(least, 1))
    edges = edges[np.argsort(-common[edges], kind="stable")]
    classes, runs = _Classes(), []
    for x, y, prefix in zip(left[edges].tolist(), right[edges].tolist(), common[edges].tolist()):
        for i, j in classes.unite(x, y):
            period = j - i
            if (
                (min_periods - 1) * period <= prefix
                and prefix + period >= min_words
                and (i == 0 or codes[i - 1] != codes[j - 1])
            ):
                runs.append((i, prefix + period, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of_texts(words: Words, min_words: int, min_periods: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, counted from its first word."""
    codes, _ = words.encode()
    n_docs = len(words.first) - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n_docs)]
    doc = np.repeat(np.arange(n_docs), np.diff(words.first))
    repeats = texts_with_repeats(codes, doc, max(1, -(-min_words * (min_periods - 1) // min_periods)))
    if not len(repeats):
        return found
    at = np.flatnonzero(np.isin(doc, repeats))
    own = doc[at] * (np.int64(codes.max()) + 1) + codes[at]
    for start, length, period in runs_of(own, min_words, min_periods):
        k = doc[at[start]]
        found[k].append((int(at[start] - words.first[k]), length, period))
    return found


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds (start, length, period) in words, counted from 0, ordered
    by start, then period; ``collapsed`` the words that no run repeats, joined by one space: a word goes if some
    run contains it after that run's first period. A null, empty or blank text has no words, no runs and an empty
    ``collapsed``. Repeated rows give repeated results; an empty table gives none. Other columns are not read.
    ``min_periods`` is at least 2.
    """
    if min_periods < 2:
        raise ValueError("a run has at least two periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = Words(batch.column("text"), UNSPACED)
            runs = runs_of_texts(words, min_words, min_periods)
            change = np.zeros(len(words.starts) + 1, np.int64)
            for k, of in enumerate(runs):
                for start, length, period in of:
                    change[words.first[k] + start + period] += 1
                    change[words.first[k] + start + length] -= 1
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(words.first)),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in of] for of in runs], kind),
                    words.joined(np.cumsum(change)[:-1] == 0),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(find, RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; one text in ten repeats a block of its own words from some word on to its end.

    With ``h`` the crc32 of the id as text and ``g = floor(h / 10)``, texts of ``n > 0`` words with ``h % 10 = 0``
    repeat their ``p = 1 + floor((n - a) / (3 + g % 8))`` words from word ``a = g % n`` on.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    planted = docs.select("doc_id", "text", F.floor(h / 10).cast("bigint").alias("g"), (h % 10 == 0).alias("chosen"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    n = F.nullif(F.size(words), F.lit(0))
    a = (F.col("g") % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8)).cast("int")
    block = F.slice(words, a + 1, p)
    repeated = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.array_join(F.concat(F.slice(words, F.lit(1), a), repeated), " ")
    return planted.select("doc_id", F.when(F.col("chosen") & (n > 0), text).otherwise(F.col("text")).alias("text"))


def _greater(x: Column, y: Column) -> Column:
    """Order by exact length / period downwards, then start, then period."""
    ratio = y["length"] * x["period"] - x["length"] * y["period"]
    return F.signum(
        F.when(ratio != 0, ratio).when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
    ).cast("int")


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    best = F.get(F.array_sort("runs", _greater), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
