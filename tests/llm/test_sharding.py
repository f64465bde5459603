from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from framefold.llm import sharding
from framefold.llm.sharding import fisher_yates, shuffled_shards
from tests.llm.data import empty, odd


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(3)
    seen = Counter(tuple(fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())
    assert list(fisher_yates(0, rng)) == [] and list(fisher_yates(1, rng)) == [0]


def test_shards_are_even_whole_and_repeatable(spark, tmp_path):
    docs = odd(spark).union(odd(spark)).union(odd(spark))
    out = [
        shuffled_shards(d, str(tmp_path / f"o{i}"), shards=4, bucket_bytes=100_000).collect()
        for i, d in enumerate((docs, docs.repartition(5)))
    ]
    first, second = ([(r["doc_id"], r["text"], r["__shard"], r["__slot"]) for r in rows] for rows in out)
    assert Counter(first) == Counter(second)
    assert Counter(r[:2] for r in first) == Counter((r.doc_id, r.text) for r in docs.collect())
    by_shard = Counter(r[2] for r in first)
    assert len(by_shard) == 4 and max(by_shard.values()) - min(by_shard.values()) <= 1
    for shard, n in by_shard.items():
        assert sorted(r[3] for r in first if r[2] == shard) == list(range(n))
    assert shuffled_shards(empty(spark), str(tmp_path / "e")).count() == 0


def test_places_are_recomputed(spark, tmp_path):
    """Buckets, their order and the shuffle in each, from the hashes Spark gives the records."""
    docs = odd(spark).union(odd(spark))
    keyed = sharding._numbered(docs, sharding.SEED)
    size = sum(docs.agg(F.sum(sharding._record_bytes(docs))).first())
    buckets = -(-size // 100_000)
    bucket = F.pmod(F.xxhash64(F.lit(sharding.SEED + 1), "__at", "__copy"), F.lit(buckets))
    rows = defaultdict(list)
    for r in keyed.withColumn("bucket", bucket).collect():
        rows[r["bucket"]].append((r["__at"], r["doc_id"], r["text"]))
    order = []
    for b in sorted(rows):
        records = sorted(rows[b], key=lambda r: r[0])
        order += [records[i][1:] for i in fisher_yates(len(records), np.random.default_rng([sharding.SEED, b]))]
    starts = [-(-k * len(order) // 4) for k in range(5)]
    want = {(s, i): order[starts[s] + i] for s in range(4) for i in range(starts[s + 1] - starts[s])}
    out = shuffled_shards(docs, str(tmp_path / "o"), shards=4, bucket_bytes=100_000).collect()
    assert {(r["__shard"], r["__slot"]): (r["doc_id"], r["text"]) for r in out} == want and len(rows) > 3


def test_a_record_repeated_very_often_spreads(spark, tmp_path):
    docs = spark.range(100_000).select(F.lit(1).alias("doc_id"), F.lit("the same text").alias("text")).union(
        spark.range(50).select(F.col("id").cast("int"), F.lit("another"))
    )
    placed, rows = sharding._bucketed(docs, 1, 20_000)
    sizes = [r["count"] for r in placed.groupBy("__bucket").count().collect()]
    assert rows == sum(sizes) == 100_050 and max(sizes) < 1.5 * rows / len(sizes) and len(sizes) > 50
    out = shuffled_shards(docs, str(tmp_path / "o"), bucket_bytes=20_000)
    assert Counter(r["text"] for r in out.select("text").collect()) == {"the same text": 100_000, "another": 50}


def test_texts_stay_in_place_until_they_are_bucketed(spark):
    """Numbering equal records moves hashes, and of the texts only those that repeat."""
    docs = odd(spark).dropDuplicates().localCheckpoint()
    plan = sharding._numbered(docs, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    some = docs.union(docs.limit(7)).union(docs.limit(3))
    plan = sharding._numbered(some, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_copies_are_numbered_alike_however_many_repeat(spark):
    docs = odd(spark)
    docs = docs.union(docs.limit(7)).union(docs.limit(3))
    few, many = (
        Counter((r["doc_id"], r["text"], r["__copy"]) for r in sharding._numbered(docs, 1, n).collect())
        for n in (1000, 0)
    )
    rows = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert few == many == Counter((*row, k) for row, n in rows.items() for k in range(n))
