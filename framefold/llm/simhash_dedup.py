"""Near-duplicates by 64-bit SimHash within a small Hamming distance, found by anchor points.

Anchors are the words of a covering code: two blocks of 23 bits, each covered by the
binary Golay code (every word lies within 3 bits of exactly one code word), and 18 bits
covered by a single word. A fingerprint has one home, its nearest anchor. It also visits
every anchor within the covering radius plus the threshold: fingerprints at most
``distance`` apart differ by k bits in one block and at most ``distance - k`` in the
other, so the second one lies within 3 + k and 3 + distance - k of the first one's home.
Comparing each anchor's homes with its visitors therefore finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query
from framefold.llm.components import connected_components

SHINGLE_WORDS = 3
DISTANCE = 2
#: Homes of an anchor up to which homes and visitors are compared directly.
DIRECT_HOMES = 64

# The generator polynomial and the length of the perfect binary Golay code.
GOLAY_GENERATOR = 0b101011100011
GOLAY_BITS = 23
GOLAY_RADIUS = 3

_HASHES_AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text.

    ASCII letters are lower-cased, words are separated by ASCII white space, shingles are
    hashed by XXH64 with seed 42 and count as often as they occur. A bit is set if more than half
    of the hashes have it. Fewer words than a shingle has count as one shingle; none gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    hashes = np.fromiter((digest(joined[s:e], 42) for s, e in spans), np.uint64, n)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _HASHES_AT_ONCE):
        part = hashes[at : at + _HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` is the fingerprint as a signed bigint.

    A null text counts as empty. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint_of(t.as_py(), shingle_words) for t in batch.column(2)]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(signed)], names=["doc_id", "text_hash", "fp"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, fp bigint"
    )


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: the words as polynomials modulo the generator."""
    out = words.astype(np.int64).copy()
    for bit in range(GOLAY_BITS - 1, 10, -1):
        out ^= ((out >> bit) & 1) * (GOLAY_GENERATOR << (bit - 11))
    return out


class CoveringCode:
    """For each syndrome, the errors of weight up to radius + distance, lightest first."""

    def __init__(self, distance: int):
        errors = [0]
        weights = [0]
        for weight in range(1, GOLAY_RADIUS + distance + 1):
            for bits in combinations(range(GOLAY_BITS), weight):
                errors.append(sum(1 << b for b in bits))
                weights.append(weight)
        syndromes = _remainder(np.array(errors))
        self.distance = distance
        self.errors: list[np.ndarray] = []
        self.within: list[list[int]] = []
        for s in range(2048):
            at = np.flatnonzero(syndromes == s)
            self.errors.append(np.array(errors)[at])
            w = np.array(weights)[at]
            self.within.append([int((w <= GOLAY_RADIUS + k).sum()) for k in range(distance + 1)])

    def anchors(self, block: int, syndrome: int) -> np.ndarray:
        """Names (upper 12 bits) of the code words around a block, nearest first."""
        return (block ^ self.errors[syndrome]) >> 11

    def rows(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, index of the fingerprint, is home) for homes and visits of unsigned fingerprints."""
        mask = np.uint64((1 << GOLAY_BITS) - 1)
        first = (fps & mask).astype(np.int64)
        second = ((fps >> np.uint64(GOLAY_BITS)) & mask).astype(np.int64)
        s1, s2 = _remainder(first).tolist(), _remainder(second).tolist()
        anchors, sizes = [], []
        for a, b, sa, sb in zip(first.tolist(), second.tolist(), s1, s2):
            left = self.anchors(a, sa) << 12
            right = self.anchors(b, sb)
            parts = []
            done = 0
            for k in range(self.distance + 1):
                upto = self.within[sa][k]
                parts.append((left[done:upto, None] | right[None, : self.within[sb][self.distance - k]]).ravel())
                done = upto
            anchors += parts
            sizes.append(sum(map(len, parts)))
        count = np.array(sizes, dtype=np.int64)
        index = np.repeat(np.arange(len(fps)), count)
        home = np.zeros(int(count.sum()), dtype=bool)
        home[np.cumsum(count) - count] = True  # the nearest anchor of both blocks comes first
        return np.concatenate(anchors) if anchors else np.zeros(0, np.int64), index, home


_CODES: dict[int, CoveringCode] = {}


def covering_code(distance: int) -> CoveringCode:
    """One code table per worker."""
    if distance not in _CODES:
        _CODES[distance] = CoveringCode(distance)
    return _CODES[distance]


def anchor_rows(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``anchor, fp, home``: each fingerprint at its home and at every other anchor that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = covering_code(distance)
        for batch in batches:
            signed = batch.column(0).to_numpy()
            for at in range(0, len(signed), 4096):
                part = signed[at : at + 4096]
                anchor, index, home = code.rows(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(part[index]), pa.array(home)],
                    names=["anchor", "fp", "home"],
                )

    return classes.select("fp").mapInArrow(run, "anchor int, fp bigint, home boolean")


def _ball_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links ``a, b`` that join all distinct ``fps`` within ``distance`` of each other, without pairing a group.

    Two fingerprints at most 2 bits apart share a point within 1 bit of both, and fingerprints that share
    such a point are at most 2 bits apart. A point has at most 65 fingerprints, whatever the data. For a
    distance of 1 the point must be one of the two fingerprints.
    """
    flipped = F.expr("transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))")
    points = fps.select("fp", F.explode(F.concat(F.array("fp"), flipped)).alias("point"))
    around = points.groupBy("point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    hub = F.array_min("fps")
    if distance == 1:
        around = around.where(F.array_contains("fps", F.col("point")))
        hub = F.col("point")
    return around.select(hub.alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()


def links(classes: DataFrame, distance: int = DISTANCE, direct_homes: int = DIRECT_HOMES) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints ``fp`` of ``classes`` (landed), enough to connect
    whatever is connected by steps of at most ``distance`` (0, 1 or 2) bits; every link is true.

    Anchors with up to ``direct_homes`` homes compare them with all visitors. At a fuller anchor homes
    and visitors are linked over the points around them, in groups of at most 65. Spark takes the visits,
    some 60 rows a fingerprint, for as few as the fingerprints, so their join is hinted: they are never broadcast.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distance must be 0, 1 or 2")
    rows = anchor_rows(classes, distance)
    homes = land(rows.where("home").select("anchor", "fp"), "homes")
    full = land(homes.groupBy("anchor").count().where(F.col("count") > direct_homes).select("anchor"), "full")
    some = homes.join(full, "anchor", "left_anti").select("anchor", F.col("fp").alias("a"))
    direct = (
        some.hint("merge").join(rows.select("anchor", F.col("fp").alias("b")).hint("merge"), "anchor")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    crowded = rows.join(full, "anchor", "left_semi").select("fp").distinct()
    return direct.union(_ball_links(crowded, distance)) if distance else direct


def group_documents(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, root`` of every row.

    Fingerprints at most ``distance`` bits apart are linked; ``component_id`` is the smallest id of the
    connected documents, null where all their ids are null; ``root`` names the component. Empty and null
    texts have fingerprint 0 and are linked like others. Equal fingerprints are compared once. Repeated
    rows get equal results, an empty table none; columns other than ``doc_id`` and ``text`` are not read.
    """
    rows = land(fingerprints(docs, shingle_words), "fingerprints")
    classes = land(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    stars = connected_components(links(classes, distance)).withColumnRenamed("node", "fp")
    rooted = classes.join(stars, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each group: the one with the smallest id.

    Among rows that share that id the one with the smallest text hash stays, and of equal rows one.
    Columns stay as they are.
    """
    grouped = group_documents(docs, shingle_words, distance)
    first = (
        grouped.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("text_hash").alias("_hash"), F.min("component_id").alias("_id"))
        .select("_id", "_hash")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # its columns cannot clash in there
    hashed = docs.select(row.alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_h"))
    same = F.col("_doc").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    kept = hashed.join(first, same, "left_semi")
    return kept.dropDuplicates(["_doc", "_h"]).select("_row.*")


@query("op10_simhash_near_dedup")
def _(spark, sf):
    """Fingerprint and component of every document: 3-word shingles, links at 2 differing bits or fewer."""
    return group_documents(documents(spark, sf), SHINGLE_WORDS, DISTANCE).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
