import random

import numpy as np
import pytest
import xxhash

from framefold.llm.components import connected_components
from framefold.llm.simhash_dedup import fingerprint_of, group_documents, keep_one, links
from tests.llm.data import LONG, empty, odd


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", "One", "One  TWO", "a b c", "a b c d a b c É", "x " * 5000, LONG[:20000]])
def test_fingerprint_against_plain_form(text):
    assert fingerprint_of(text) == plain(text)


def test_hash_is_that_of_spark(spark):
    got = spark.createDataFrame([("é x",)], "s string").selectExpr("xxhash64(s)").collect()[0][0]
    assert got % 2**64 == xxhash.xxh64_intdigest("é x".encode(), seed=42)


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_against_union_find(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    edges = chain + star + loose + [(5, 5), (-7, 3)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got} == {x: union.find(x) for x in nodes} and len(got) == len(nodes)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize(("distance", "direct"), [(0, 64), (1, 64), (1, 0), (2, 64), (2, 1), (2, 0)])
def test_links_connect_what_all_pairs_connect(spark, distance, direct):
    rng = random.Random(9)
    points = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            p = centre
            for b in rng.sample(range(64), rng.randrange(5)):
                p ^= 1 << b
            points.add(p)
    signed = np.array(sorted(points), dtype=np.uint64).view(np.int64).tolist()
    union = Union()
    pairs = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= distance
    }
    for a, b in pairs:
        union.join(a, b)
    found = links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), distance, direct).collect()
    mine = Union()
    for r in found:
        assert (min(r.a, r.b), max(r.a, r.b)) in pairs or distance == 2 and ((r.a ^ r.b) % 2**64).bit_count() <= 2
        mine.join(r.a, r.b)
    assert {p: union.find(p) for p in signed} == {p: mine.find(p) for p in signed}


def test_visits_are_not_broadcast_however_small_spark_takes_them(spark, tmp_path):
    """Spark takes them for as many as the fingerprints, of which there are some 60 times fewer."""
    spark.range(2000).selectExpr("xxhash64(id) AS fp").write.parquet(str(tmp_path / "classes"))
    lines = links(spark.read.parquet(str(tmp_path / "classes")))._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = {i: len(line) - len(line.lstrip(" :+-")) for i, line in enumerate(lines)}
    visits = [i for i in depth if "MapInArrow" in lines[i]]
    above = {lines[j].lstrip(" :+-").split()[0] for i in visits for j in range(i) if all(depth[k] > depth[j] for k in range(j + 1, i + 1))}
    assert visits and "SortMergeJoin" in above and "BroadcastExchange" not in above


def test_odd_documents(spark):
    rows = [(r.doc_id, r.component_id) for r in group_documents(odd(spark)).collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 5), (5, 5), (6, 5), (None, None), (7, 7), (8, 8)], key=str
    )
    kept = keep_one(odd(spark))
    assert kept.schema == odd(spark).schema
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 4, 5, 7, 8, None]
    assert group_documents(empty(spark)).count() == 0 and keep_one(empty(spark)).count() == 0
