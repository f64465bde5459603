"""SimHash fingerprints of whole documents and the exact search for near ones in tables of blocks.

Terms are words and runs of two and three words. A term weighs the logarithm of its count, longer terms
more, and votes with its signed hash bits. For the search the bits are cut into blocks: fingerprints within
the radius differ in at most ``radius // BLOCKS`` bits of one block at least, so a table for each block, keyed
by its bits, holds every such pair if the queries look up all keys that few bits away.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query

BITS = 128
#: Weight of terms of one, two and three words.
TERM_WEIGHTS = (0.25, 0.75, 1.0)
RADIUS = 17
#: Blocks that the bits are cut into for the search; none crosses the middle.
BLOCKS = 6

_WORDS: dict[bytes, int] = {}
_KNOWN_WORDS = 500_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word; a worker remembers the words it has met."""
    known = _WORDS
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(known) > _KNOWN_WORDS:
            known.clear()
        known.update((w, xxhash.xxh64_intdigest(w)) for w in words if w not in known)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[salt]
    return x ^ (x >> np.uint64(29))


def fingerprint_of(text: str | None) -> int:
    """``BITS``-bit SimHash of a whole text; equal texts have equal ones. No words give 0."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return 0
    h = _word_hashes(words)
    terms = [_mixed(h, 0)]
    if len(h) > 1:
        terms.append(_mixed(terms[0][:-1] + _mixed(h[1:], 1), 0))
    if len(h) > 2:
        terms.append(_mixed(terms[1][:-1] + _mixed(h[2:], 2), 1))
    votes = np.zeros(BITS)
    for hashes, weight in zip(terms, TERM_WEIGHTS):
        distinct, counts = np.unique(hashes, return_counts=True)
        strength = (weight * (1 + np.log(counts))).astype(np.float32)
        for at in range(0, len(distinct), 1 << 14):
            part = distinct[at : at + (1 << 14)]
            wide = np.stack([_mixed(part, i % 3) ^ (part * _MIX[(i + 1) % 3]) for i in range(BITS // 64)], axis=1)
            bits = np.unpackbits(wide.astype("<u8").view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
            weights = strength[at : at + (1 << 14)]
            votes += 2 * (weights @ bits.astype(np.float32)) - weights.sum()
    return int.from_bytes(np.packbits(votes > 0, bitorder="little").tobytes(), "little")


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1 - (a ^ b).bit_count() / BITS


def as_text(fingerprint: int) -> str:
    return f"{fingerprint:0{BITS // 4}x}"


def edited(text: str, following: str) -> str:
    """``text`` with its last half of code points replaced by as many, or all, from the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(text: str, fp: int, following: str, following_fp: int) -> tuple:
    """edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    new = edited(text, following)
    new_fp = fp if new == text else fingerprint_of(new)
    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
    return digest, as_text(fp), as_text(new_fp), likeness(fp, new_fp), likeness(fp, following_fp)


_RESULT = "edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_SCHEMA = f"part int, head boolean, tail boolean, doc_id bigint, text string, n_chars bigint, {_RESULT}"
_TYPES = [
    pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.string(), pa.int64(),
    pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
]


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars`` and the fingerprints of each text and of its edited text, with their likeness.

    The next document is the one that follows in ascending (id, text hash), null ids last; after the last
    comes the first, so a single document follows itself. A null text counts as empty, repeated rows each have
    a row, and an empty table has none. Texts are shuffled once, into ranges of ids, and read in order; only the
    first and the last document of each range meet those of other ranges afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before: tuple | None = None  # the document whose next one is awaited
        head = True
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                fp = fingerprint_of(text)
                if before is not None:
                    i, t, f = before
                    rows.append((part, head, False, i, t if head else None, len(t), *_row(t, f, text, fp)))
                    head = False
                before = (doc_id, text, fp)
            yield _batch(rows, _TYPES, _names(_SCHEMA))
        if before is not None:
            i, t, f = before
            yield _batch([(part, head, True, i, t, len(t), None, as_text(f), None, None, None)], _TYPES, _names(_SCHEMA))

    keyed = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_h"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_h").asc()]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows = land(ranged.mapInArrow(run, _SCHEMA), "fingerprints")
    columns = ["doc_id", "n_chars", *_names(_RESULT)]
    return rows.where(~F.col("tail")).select(*columns).union(_range_ends(rows).select(*columns))


def _range_ends(rows: DataFrame) -> DataFrame:
    """The last document of each range with the first one of the next range; one row per range."""
    heads = rows.where("head").select("part", F.col("text").alias("following"), F.col("fingerprint").alias("following_fp"))
    parts = heads.select("part")
    after = Window.orderBy("part")  # over the numbers of the ranges only
    first = F.min("part").over(Window.partitionBy())
    turns = parts.select("part", F.coalesce(F.lead("part").over(after), first).alias("next"))
    ends = (
        rows.where("tail")
        .select("part", "doc_id", "text", "n_chars", "fingerprint")
        .join(turns, "part")
        .join(heads.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "n_chars", "text", "fingerprint", "following", "following_fp")
    )
    schema = f"doc_id bigint, n_chars bigint, {_RESULT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (r["doc_id"], r["n_chars"], *_row(r["text"], int(r["fingerprint"], 16), r["following"], int(r["following_fp"], 16)))
                for r in batch.to_pylist()
            ]
            yield _batch(rows, [pa.int64(), pa.int64(), *_TYPES[6:]], _names(schema))

    return ends.mapInArrow(run, schema)


def _halves(fingerprint: str) -> tuple[Column, Column]:
    """The first and the last 64 bits as signed numbers."""
    return tuple(F.conv(F.substring(fingerprint, at, 16), 16, -10).cast("bigint") for at in (1, 17))


def _blocks(high: Column, low: Column) -> list[tuple[Column, int]]:
    """The blocks as numbers, with their widths."""
    out = []
    for i in range(BLOCKS):
        start, end = i * BITS // BLOCKS, (i + 1) * BITS // BLOCKS
        half, last = (high, 64) if start < 64 else (low, 128)
        bits = F.shiftrightunsigned(half, last - end).bitwiseAND(F.lit((1 << (end - start)) - 1).cast("bigint"))
        out.append((bits, end - start))
    return out


def find_near(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``query, fingerprint, distance``: every distinct fingerprint within ``radius`` (0 to 23) of each distinct query.

    Both tables have a ``fingerprint`` of 128 bits as hexadecimal text. Each fingerprint has one key for each block;
    a query looks up, for each block, the keys within ``radius // BLOCKS`` bits. A pair that several blocks find counts
    for the first of them.
    """
    if not 0 <= radius < 4 * BLOCKS:
        raise ValueError(f"radius must be 0 to {4 * BLOCKS - 1}")
    apart = radius // BLOCKS

    def halved(df: DataFrame, name: str) -> DataFrame:
        high, low = _halves("fingerprint")
        return df.select("fingerprint").distinct().select(high.alias(f"{name}_high"), low.alias(f"{name}_low"))

    def masks(width: int) -> Column:
        chosen = [sum(1 << b for b in bits) for n in range(apart + 1) for bits in combinations(range(width), n)]
        return F.expr("array(" + ", ".join(f"{m}L" for m in chosen) + ")")

    def keyed(df: DataFrame, name: str, keys) -> DataFrame:
        blocks = _blocks(F.col(f"{name}_high"), F.col(f"{name}_low"))
        each = [keys(bits + F.lit(i << 32).cast("bigint"), width) for i, (bits, width) in enumerate(blocks)]
        return df.select("*", F.explode(F.concat(*each)).alias("key"))

    def text(name: str) -> Column:
        return F.lower(F.concat(*[F.lpad(F.hex(f"{name}_{half}"), 16, "0") for half in ("high", "low")]))

    rows = keyed(halved(fingerprints, "row"), "row", lambda key, _: F.array(key))
    asks = keyed(halved(queries, "ask"), "ask", lambda key, width: F.transform(masks(width), key.bitwiseXOR))
    high, low = (F.col(f"row_{half}").bitwiseXOR(F.col(f"ask_{half}")) for half in ("high", "low"))
    finders = [F.when(F.bit_count(bits) <= apart, F.lit(i)) for i, (bits, _) in enumerate(_blocks(high, low))]
    return (
        # Both sides grow with the corpus; the exploded one must not be taken for small.
        asks.hint("merge").join(rows.hint("merge"), "key")
        .withColumn("distance", F.bit_count(high) + F.bit_count(low))
        .where((F.col("distance") <= radius) & (F.coalesce(*finders) == F.shiftright("key", 32)))
        .select(text("ask").alias("query"), text("row").alias("fingerprint"), "distance")
    )


def near_counts(rows: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint, n_near``: documents of ``rows`` within ``radius`` of each query fingerprint, its own included."""
    sizes = rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("size"))
    return (
        find_near(rows, queries, radius)
        .join(sizes, "fingerprint")
        .groupBy(F.col("query").alias("fingerprint"))
        .agg(F.sum("size").alias("n_near"))
    )


@query("op9_simhash_fingerprints")
def _(spark, sf):
    """Fingerprints of every text and its edited text; ids divisible by 50 also look up all documents near them."""
    rows = land(fingerprints(documents(spark, sf)), "rows")
    asks = rows.where(F.col("doc_id") % 50 == 0)
    near = near_counts(rows, asks)
    return rows.join(near, "fingerprint", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        F.when(F.col("doc_id") % 50 == 0, F.col("n_near")).alias("n_near"),
    )
