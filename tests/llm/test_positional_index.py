import hashlib
import random
import re

import numpy as np
import pytest

from framefold.llm import positional_index
from framefold.llm.common import land
from framefold.llm.positional_index import build_index, contamination, near_spans, op13, phrase_starts, search, windows
from tests.llm.data import ROWS, empty, odd

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_windows(text, n=10):
    words = words_of(text)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)) if words}


def plain_near(words, window, span):
    """Whether some stretch of at most ``span`` words holds all words of the window."""
    need = set(window)
    return any(need <= set(words[i : i + span]) for i in range(len(words))) if need <= set(words) else False


def plain_result(doc, items, near):
    doc_id, text = doc[0], doc[1]
    words = words_of(text)
    where = {}
    for i in range(len(words)):
        for n in range(1, 11):
            where.setdefault(tuple(words[i : i + n]), []).append(i) if i + n <= len(words) else None
    hit, found, close = set(), set(), set()
    for item_id, item_text in items:
        for window in plain_windows(item_text):
            for i in where.get(window, ()):
                hit.update(range(i, i + len(window)))
                found.add(str(item_id))
            if item_id not in close and plain_near(words, window, near):
                close.add(item_id)
    ids = ",".join(sorted(found))
    return (doc_id, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit), len(close))


def corpus():
    rng = random.Random(13)
    vocabulary = ["a", "the", "Of", "näh", "x1", "to", "b", "C3", "zebra", "yak", "ibis", "emu"]
    some = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, some(rng.choice((1, 3, 9, 10, 12, 30)))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "--- !!"), (7, items[7][1]), (53, items[3][1]), (54, "hello WORLD again"), (55, "word1 is number 1")]
    docs = [(100 + i, some(rng.randint(0, 90)), "en", "s") for i in range(120)]
    for i in range(60):
        text = rng.choice([t for _, t in items if t])
        if i % 3 == 0:
            shuffled = text.split()
            rng.shuffle(shuffled)
            text = " ".join(shuffled)
        docs.append((400 + i, f"{some(5)} {text.upper()} {some(4)}", "en", "s"))
    docs += docs[-3:]
    return docs + [r for r in ROWS if r[0] != 4], items


@pytest.mark.parametrize("block", [200_000, 17])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, block):
    docs, items = corpus()
    odd(spark, docs).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*i, "clash", 1) for i in items], "item_id bigint, text string, phrase string, term int").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    plain_search = search
    monkeypatch.setattr(positional_index, "search", lambda i, a, n: plain_search(i, a, n, block))
    if block == 17:
        monkeypatch.setattr(positional_index, "BROADCAST_TERMS", 3)
    got = sorted((tuple(r) for r in op13(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((plain_result(d, items, positional_index.NEAR_WORDS) for d in docs), key=repr)
    assert sum(r[5] for r in got) > 50 and any(not r[5] for r in got)
    assert any(r[6] > r[3] for r in got) and all(r[6] >= r[3] for r in got)


def test_matches_of_a_long_text(spark):
    index = land(build_index(odd(spark)), "index")
    asked = windows(spark.createDataFrame([(None, "Word5 is number, 982")], "item_id string, text string"))
    rows = search(index, asked, near=4).collect()
    assert {(r.start, r.length) for r in rows if not r.near} == {(982 * 4, 4)}
    assert {(r.start, r.length) for r in rows if r.near} == {(982 * 4, 4)}
    assert contamination(index, land(search(index, asked), "m"), asked).where("contaminated").count() == 1


def test_nothing_to_search(spark):
    items = spark.createDataFrame([(1, "no such words here")], "item_id bigint, text string")
    none = items.limit(0)
    full, bare = land(build_index(odd(spark)), "index"), land(build_index(empty(spark)), "index")
    assert bare.count() == 0 and search(bare, windows(items), 5).count() == 0
    assert search(full, windows(none), 5).count() == 0 == search(full, windows(items), 5).count()
    rows = contamination(full, search(full, windows(none), 5), windows(none)).collect()
    assert len(rows) == len(ROWS) and not any(r.contaminated for r in rows)


def test_intersections_against_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.randrange(5) for _ in range(rng.randint(1, 40))]
        lists = {t: np.flatnonzero(np.array(words) == t).astype("<u4") for t in range(5)}
        window = [rng.randrange(5) for _ in range(rng.randint(1, 4))]
        starts = [i for i in range(len(words) - len(window) + 1) if words[i : i + len(window)] == window]
        assert [s for s in phrase_starts([lists[t] for t in window]).tolist() if s >= 0] == starts
        own = sorted((lists[t] for t in dict.fromkeys(window)), key=len)
        if not len(own[0]):
            continue
        ends = np.full(len(own[0]), len(words))
        for span in (1, 3, 6):
            got = {c: (b, e) for c, b, e in near_spans(own, span, 0 * ends, ends)}
            for c in own[0].tolist():
                fits = [
                    (e - b, e, b)
                    for b in range(max(0, c - span + 1), c + 1)
                    for e in range(c + 1, min(b + span, len(words)) + 1)
                    if set(window) <= set(words[b:e])
                ]
                assert got.get(c) == ((min(fits)[2], min(fits)[1]) if fits else None)
