import random
from collections import Counter

import pytest

from framefold.llm.mixing import block_quotas, mixed_ranges, mixture, source_targets
from tests.llm.data import ROWS, empty, odd


def targets_of(sizes):
    """Shares by weight; what is above twice a source is shared again until nothing is."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    fixed = {}
    while True:
        left = 1.5 * sum(sizes) - sum(fixed.values())
        free = [i for i in range(len(sizes)) if i not in fixed]
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 2 * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: 2.0 * sizes[i] for i in over}


def frame(spark, sizes):
    rows = [(f"s{i:02d}", f"{i:02d}", n) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, "_src string, source string, size bigint")


@pytest.mark.parametrize("sizes", [[100], [1000, 10, 10], [5, 5000, 700, 30, 0, 900], [3] * 7])
def test_targets(spark, sizes):
    got = [r.target for r in source_targets(frame(spark, sizes)).orderBy("place").collect()]
    assert got == pytest.approx(targets_of(sizes))


def test_quotas_are_those_of_the_highest_quotients(spark):
    rng = random.Random(4)
    for _ in range(3):
        sizes = [rng.choice([3, 40, 900, 20_000]) for _ in range(9)]
        targets = targets_of(sizes)
        rows = block_quotas(source_targets(frame(spark, sizes)), block=7, shards=4).collect()
        got = {(r["_src"], r.shard): r.upto for r in rows}
        seats = [0] * len(sizes)
        total = round(sum(targets) / 7)
        for seat in range(1, total + 1):
            best = max(range(len(sizes)), key=lambda i: (targets[i] / (2 * seats[i] + 1), -i))
            seats[best] += 1
            for shard in range(4):
                if seat == total * (shard + 1) // 4:
                    assert [got.get((f"s{i:02d}", shard), 0) for i in range(len(sizes))] == seats


def test_mixture_takes_what_ranges_say(spark):
    docs = odd(spark, ROWS + [(50 + i, "one two three four\nfive " * (i + 1), "en", f"s{i % 4}") for i in range(30)])
    ranges = mixed_ranges(docs).collect()
    assert len(ranges) == docs.count() and all(0 <= r.taken <= 2 * r["size"] for r in ranges)
    assert all((r.shard is None) == (r.taken == 0) for r in ranges)
    for source in {r.source for r in ranges}:
        own = [r for r in ranges if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 48
    words = Counter()
    for r in mixture(docs).collect():
        words[r.doc_id] += len((r.text or "").split())
        assert r.lang is None or r["size"] == 1  # clashing columns come through
    assert {k: v for k, v in words.items() if v} == {
        k: v for k, v in sum((Counter({r.doc_id: r.taken}) for r in ranges), Counter()).items() if v
    }
    assert sorted(map(str, ranges)) == sorted(map(str, mixed_ranges(docs.repartition(3)).collect()))


def test_empty_table(spark):
    assert mixed_ranges(empty(spark)).count() == 0 and mixture(empty(spark)).count() == 0
    assert mixed_ranges(odd(spark, [(1, None, "en", "s")])).collect()[0].taken == 0
