import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from framefold.llm.packing import cut, default_tokenizer, encoder, pack_documents, packing_plan
from tests.llm.data import ROWS, empty, odd

TRICKY = ["", " ", "a  b", "x<|endoftext|>y <|endoftext|> z", "don't I'LL", "é́ ñ", "🙂🙂", "1 234,5\n\n\n a", " x y", "中文 words"]


@pytest.mark.parametrize("text", TRICKY)
def test_ids_are_those_of_the_tokenizers_library(text):
    path = default_tokenizer()
    assert encoder(path).ids(text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)]
    assert cut(19, 8) == [(0, 3), (3, 8), (11, 8)] and cut(16, 8) == [(0, 8), (8, 8)]


def test_plan_uses_every_piece_once_and_is_close_to_the_bound():
    rng = random.Random(1)
    for capacity in (7, 64, 2048):
        lengths = Counter(min(capacity, int(rng.expovariate(3 / capacity)) + 1) for _ in range(5000))
        plan = packing_plan(dict(lengths), capacity)
        used = Counter()
        for times, pattern in plan:
            assert sum(pattern) <= capacity and times > 0
            used.update({k: n * times for k, n in Counter(pattern).items()})
        assert used == lengths
        bound = -(-sum(k * n for k, n in lengths.items()) // capacity)
        assert sum(times for times, _ in plan) <= 1.02 * bound + 1


def test_pairs_and_triples_fill_exactly():
    assert packing_plan({6: 1, 2: 2}, 10) == [(1, [6, 2, 2])]
    assert sum(t for t, _ in packing_plan({7: 3, 1: 9}, 10)) == 3
    assert packing_plan({}, 10) == []


def test_documents_round_trip(spark):
    rows = pack_documents(odd(spark), default_tokenizer(), keep_ids=True).collect()
    assert pack_documents(empty(spark), default_tokenizer()).count() == 0
    exact = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    for doc_id, text, *_ in ROWS:
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        want[(doc_id, np.array(ids, "<u4").tobytes())] += 1
    sequences = defaultdict(list)
    parts = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[(r.doc_id, r.piece)].append(bytes(r.ids))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    got = Counter()
    for (doc_id, piece), texts in parts.items():
        if piece == 0:
            for n, text in enumerate(sorted(texts)):
                more = b""
                while parts.get((doc_id, piece + 1)) and len(texts) == 1:
                    piece += 1
                    more += parts[(doc_id, piece)][n]
                got[(doc_id, text + more)] += 1
    assert got == want
