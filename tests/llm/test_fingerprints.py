import hashlib
import math
import random
from collections import Counter

import pytest
import xxhash

from framefold.llm.fingerprints import _MIX, as_text, edited, find_near, fingerprint_of, fingerprints, likeness
from tests.llm.data import ROWS, empty, odd


def test_edited_text():
    assert edited("abcde", "XY") == "abcXY" and edited("abcde", "XYZ") == "abcXY"
    assert edited("", "abc") == "" and edited("a", "b") == "a" and edited("abcd", "") == "ab"


def test_similar_texts_have_near_fingerprints():
    rng = random.Random(6)
    a = [f"w{rng.randrange(5000)}" for _ in range(400)]
    b = a[:380] + [f"w{rng.randrange(5000)}" for _ in range(20)]
    c = [f"w{rng.randrange(5000)}" for _ in range(400)]
    one, two, three = (fingerprint_of(" ".join(x)) for x in (a, b, c))
    assert likeness(one, two) > 0.85 > 0.65 > likeness(one, three)
    assert fingerprint_of(None) == fingerprint_of(" \n") == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_rows_follow_in_order_around_the_end(spark, parts):
    docs = odd(spark, ROWS + [(20 + i, f"text number {i} " * (i % 4), "en", "s") for i in range(30)])
    got = fingerprints(docs.repartition(parts)).collect()
    key = {r: h for r, h in docs.selectExpr("text", "xxhash64(text) AS h").distinct().collect()}
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, key[r[1]]))
    want = Counter()
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        t, f = text or "", following or ""
        new = edited(t, f)
        a, b, c = map(fingerprint_of, (t, new, f))
        sha = hashlib.sha256(new.encode()).hexdigest()
        want[(i, len(t), sha, as_text(a), as_text(b), likeness(a, b), likeness(a, c))] += 1
    assert Counter(tuple(r) for r in got) == want


def test_single_and_no_document(spark):
    row = fingerprints(odd(spark, [(1, "abcd", "en", "s")])).collect()[0]
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fingerprints(empty(spark)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    points = {rng.getrandbits(128) for _ in range(60)}
    for p in list(points):
        for flips in range(1, 5):
            q = p
            for b in rng.sample(range(128), flips):
                q ^= 1 << b
            points.add(q)
    points = sorted(points)
    asks = points[::5]
    rows = spark.createDataFrame([(as_text(p),) for p in points] * 2, "fingerprint string")
    got = find_near(rows, spark.createDataFrame([(as_text(p),) for p in asks], "fingerprint string"), radius)
    want = {(as_text(a), as_text(p), (a ^ p).bit_count()) for a in asks for p in points if (a ^ p).bit_count() <= radius}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_near_copies_are_found_at_the_default_radius(spark):
    rng = random.Random(3)
    points = [rng.getrandbits(128) for _ in range(40)]
    for p in points[:40]:
        for flips in (4, 11, 12, 16, 17, 18, 22):
            q = p
            for b in rng.sample(range(128), flips):
                q ^= 1 << b
            points.append(q)
    # Bits spread evenly over the blocks are the hardest.
    points += [points[0] ^ sum(1 << (i * 128 // 17) for i in range(17))]
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = [" ".join(words), " ".join("new" if i % 50 == 25 else w for i, w in enumerate(words))]
    near = [fingerprint_of(t) for t in texts]
    assert 3 < (near[0] ^ near[1]).bit_count() <= 17
    points = sorted({*points, *near})
    asks = [points[i] for i in range(0, len(points), 3)] + near
    rows = spark.createDataFrame([(as_text(p),) for p in points], "fingerprint string")
    got = find_near(rows, spark.createDataFrame([(as_text(p),) for p in asks], "fingerprint string")).collect()
    want = {(as_text(a), as_text(p), (a ^ p).bit_count()) for a in asks for p in points if (a ^ p).bit_count() <= 17}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert (as_text(near[0]), as_text(near[1])) in {(r.query, r.fingerprint) for r in got}


def test_votes_are_those_of_plain_arithmetic():
    """Term hashes vote bit by bit, each distinct term with its weight and the logarithm of its count."""
    full = (1 << 64) - 1
    salts = [int(x) for x in _MIX]

    def mixed(x, salt):
        x = ((x ^ (x >> 32)) * salts[salt]) & full
        return x ^ (x >> 29)

    rng = random.Random(4)
    texts = ["a", "a b", "a a a a", "Zoë ging 12 zoë GING"] + [" ".join(rng.choices("abcdefgh", k=n)) for n in (3, 7, 40, 300)]
    for text in texts:
        hashes = [xxhash.xxh64_intdigest(w) for w in text.lower().encode().split()]
        one = [mixed(h, 0) for h in hashes]
        two = [mixed((x + mixed(h, 1)) & full, 0) for x, h in zip(one, hashes[1:])]
        three = [mixed((x + mixed(h, 2)) & full, 1) for x, h in zip(two, hashes[2:])]
        votes = [0.0] * 128
        for terms, weight in zip((one, two, three), (0.25, 0.75, 1.0)):
            for term, n in Counter(terms).items():
                halves = [mixed(term, k) ^ (term * salts[k + 1] & full) for k in (0, 1)]
                for bit in range(128):
                    sign = 1 if halves[bit // 64] >> (bit % 64) & 1 else -1
                    votes[bit] += sign * weight * (1 + math.log(n))
        got = fingerprint_of(text)
        assert all((got >> bit & 1) == (v > 0) for bit, v in enumerate(votes) if abs(v) > 1e-3), text
