"""Shuffled shards: a two-pass external shuffle of whole records.

The first pass counts; the second scatters records into buckets of about
``bucket_bytes`` by a seeded hash, shuffles each bucket in memory (Fisher-Yates,
seeded) and writes it. The buckets one after the other are one permutation of the
table, and shard k of n takes its k-th part, so shard sizes differ by one row at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framefold.llm.common import documents, land, query
from framefold.session import scratch_dir

SHARDS = 8
SEED = 20_240_501
BUCKET_BYTES = 16 << 20
#: Buckets are numbered on in blocks of so many.
BLOCK = 1024
#: Hashes of repeated records that are broadcast at most.
REPEATS = 1_000_000

_BUCKET, _FIRST, _AT, _SHARD, _SLOT, _COPY = (f"__{n}" for n in ("bucket", "first", "at", "shard", "slot", "copy"))


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0 to n - 1: from the end, each place swaps with one at or before it."""
    order = np.arange(n)
    swaps = rng.integers(0, np.arange(n, 0, -1), endpoint=False) if n else []
    for i, j in zip(range(n - 1, 0, -1), swaps):
        order[i], order[j] = order[j], order[i]
    return order


def _record_bytes(docs: DataFrame) -> Column:
    """Bytes of the texts of a record, and a few for each other field."""
    texts = (T.StringType, T.BinaryType)
    sizes = [
        F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) if isinstance(f.dataType, texts) else F.lit(8)
        for f in docs.schema
    ]
    return sum(sizes[1:], sizes[0]).cast("bigint")


def _order_key(docs: DataFrame, seed: int) -> Column:
    """A seeded hash of the whole record: equal in every run and under every split of the input."""
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])


def _numbered(docs: DataFrame, seed: int, repeats: int = REPEATS) -> DataFrame:
    """The records with their hash, and equal records numbered from 0.

    Equal records are interchangeable, so those that repeat are counted, by value, and written out again with their
    numbers: no group of them is gathered, however many there are. Which repeat is found from the hashes alone. While
    at most ``repeats`` hashes do, they are broadcast, and all other records stay where they are; more records are
    counted all, so texts are shuffled once for it.
    """
    names = [f"`{c}`" for c in docs.columns]
    first = F.lit(0).cast("bigint")
    placed = docs.withColumn(_AT, _order_key(docs, seed))
    counts = placed.groupBy(_AT).agg(F.count(F.lit(1)).alias("_n"))
    repeated = land(counts.where("_n > 1").select(_AT), "repeated")
    found = repeated.count()
    if not found:
        return placed.withColumn(_COPY, first)
    several = placed if found > repeats else placed.join(F.broadcast(repeated), _AT, "left_semi")
    copies = several.groupBy(*names, _AT).agg(F.count(F.lit(1)).alias(_COPY))
    copies = copies.withColumn(_COPY, F.explode(F.sequence(first, F.col(_COPY) - 1))).select(*names, _AT, _COPY)
    if found > repeats:
        return copies
    single = placed.join(F.broadcast(repeated), _AT, "left_anti").withColumn(_COPY, first)
    return single.select(*names, _AT, _COPY).union(copies)


def _bucketed(docs: DataFrame, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """The records with their bucket and its first place, and the number of rows.

    The bucket follows from the whole record and its number among equal ones, so records that share an id or a text,
    or are the same, still spread.
    """
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(_record_bytes(docs)).alias("bytes")).collect()[0]
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    placed = _numbered(docs, seed).withColumn(_BUCKET, F.pmod(F.xxhash64(F.lit(seed + 1), _AT, _COPY), F.lit(buckets)))
    sizes = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    block = sizes.withColumn("_block", F.floor(F.col(_BUCKET) / BLOCK))
    upto = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("_block").orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    blocks = block.groupBy("_block").agg(F.sum("_n").alias("_n")).select(
        "_block", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before")
    )
    firsts = block.join(blocks, "_block").select(
        _BUCKET, (F.col("_before") + F.coalesce(F.sum("_n").over(within), F.lit(0))).alias(_FIRST)
    )
    return placed.join(firsts, _BUCKET), total["n"]


def shuffled_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write ``docs`` to ``path`` as Parquet in folders ``__shard=0`` on, with ``__slot`` from 0 in each; read back.

    All columns are kept. The same table, seed and sizes give the same order, however the input is split:
    a bucket's records are sorted by their hash before they are shuffled. Equal records are interchangeable.
    Nulls count as no bytes; an empty table writes an empty table.
    """
    placed, rows = _bucketed(docs, seed, bucket_bytes)
    names = docs.columns
    schema = T.StructType(
        [*docs.schema.fields, T.StructField(_SHARD, T.IntegerType()), T.StructField(_SLOT, T.LongType())]
    )
    starts = np.array([-(-k * rows // shards) for k in range(shards + 1)], dtype=np.int64)

    def shuffle(table: pa.Table) -> pa.Table:
        bucket = table.column(_BUCKET)[0].as_py()
        first = table.column(_FIRST)[0].as_py()
        stable = np.argsort(table.column(_AT).to_numpy(), kind="stable")
        order = fisher_yates(len(stable), np.random.default_rng([seed, bucket]))
        mixed = table.select(names).take(pa.array(stable[order]))
        place = first + np.arange(len(order), dtype=np.int64)
        shard = np.searchsorted(starts, place, side="right") - 1
        return mixed.append_column(_SHARD, pa.array(shard.astype(np.int32))).append_column(
            _SLOT, pa.array(place - starts[shard])
        )

    out = placed.groupBy(_BUCKET).applyInArrow(shuffle, schema)
    out.write.partitionBy(_SHARD).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


@query("op2_external_shuffle_sharding")
def _(spark, sf):
    """Shard and slot of every document after a full shuffle into 8 shards of equal row counts."""
    written = shuffled_shards(documents(spark, sf), scratch_dir(spark, "shards"))
    text = F.coalesce("text", F.lit(""))
    return written.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(_SHARD).alias("shard"),
        F.col(_SLOT).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
