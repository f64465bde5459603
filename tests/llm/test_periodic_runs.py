import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

from framefold.llm.periodic_runs import op11, periodic_runs, runs_of, with_planted_runs
from framefold.llm.words import ALPHANUMERIC, UNSPACED, Words
from tests.llm.data import LONG, ROWS, empty, odd

WORD = r"[^\x20\x09-\x0D]+"


def plain_runs(words, min_words, min_periods):
    """Every maximal stretch of every period, unless a shorter period holds in it too."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    at = np.array([number[w] for w in words], int)
    found = []
    for q in range(1, len(at) // min_periods + 1):
        same = np.concatenate(([False], at[:-q] == at[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = j - i + q
            if length >= max(min_words, min_periods * q):
                own = words[i : i + length]
                if all(own[k:] != own[: length - k] for k in range(1, q)):
                    found.append((i, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_result(doc_id, text, plant=True):
    words = re.findall(WORD, text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(kept),
    )


def test_runs_of_random_sequences():
    rng = random.Random(11)
    for _ in range(400):
        words = []
        while len(words) < rng.choice((1, 5, 40, 120)):
            block = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randint(1, 9))]
            words += block * rng.choice((1, 1, 2, 4, 7))
        for min_words, min_periods in ((24, 3), (1, 2), (6, 2), (5, 4)):
            assert runs_of(np.array(words), min_words, min_periods) == plain_runs(words, min_words, min_periods)


def test_runs_of_no_word():
    assert runs_of(np.array([], np.int64)) == []


def test_one_word_repeated_very_often():
    assert runs_of(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    assert runs_of(np.arange(200_000) % 1000) == [(0, 200_000, 1000)]


def test_words_of_many_texts():
    rng = random.Random(3)
    letters = "ab Z09\t\n\x0b\x1c\x85\xa0é🙂-_/:@[`{\x7f"
    texts = [None, "", " "] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    array = pa.array(["skipped"] + texts).slice(1)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for table, fold, pattern in ((UNSPACED, False, WORD), (ALPHANUMERIC, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(array, table, fold)
        codes, known = words.encode()
        flat = [known[int(c)].as_py().decode() for c in codes]
        want = [re.findall(pattern, (t or "").translate(lower) if fold else t or "") for t in texts]
        assert [flat[a:b] for a, b in zip(words.first, words.first[1:])] == want
        keep = np.array([rng.random() < 0.7 for _ in flat], bool)
        kept = [" ".join(w for w, k in zip(flat[a:b], keep[a:b]) if k) for a, b in zip(words.first, words.first[1:])]
        assert words.joined(keep).to_pylist() == kept


def test_runs_of_documents(spark):
    repeated = [(20, "a b c " * 30, "en", "s"), (21, "x " + "go " * 24, "en", "s"), (22, "x " + "go " * 23, "en", "s")]
    rows = ROWS + repeated + [(23, LONG + " " + "tail end " * 500, "en", "s")]
    got = {r.doc_id: r for r in periodic_runs(odd(spark, rows)).collect()}
    assert [tuple(x) for x in got[20].runs] == [(0, 90, 3)] and got[20].collapsed == "a b c"
    assert [tuple(x) for x in got[21].runs] == [(1, 24, 1)] and got[22].runs == []
    assert got[1].n_words == 0 and got[1].runs == [] and got[1].collapsed == ""
    assert got[4].collapsed == LONG and got[23].collapsed.endswith(" tail end")
    assert periodic_runs(odd(spark, rows)).count() == len(rows)
    assert periodic_runs(empty(spark)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = ROWS + [(i, LONG[i : 3 * i], "en", "s") for i in range(30, 1800, 40)]
    rows += [(i, "so it goes on \n" * (i % 13), "en", "s") for i in range(2000, 2100)]
    odd(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op11(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((plain_result(r[0], r[1]) for r in rows), key=repr)
    assert any(r[1] for r in got)


def test_planted_runs_keep_other_texts(spark):
    rows = {r.doc_id: r.text for r in with_planted_runs(odd(spark)).collect()}
    assert rows[2] == "" and rows[1] is None and len(rows[4].split()) == len(LONG.split())
