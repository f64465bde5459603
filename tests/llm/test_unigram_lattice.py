import math
import zlib
from collections import Counter

import numpy as np
import pytest

from framefold.llm.unigram_lattice import WORD_START, Pieces, Scorer, default_vocabulary, fit, score_documents
from tests.llm.data import ROWS, empty, odd


@pytest.fixture(scope="module")
def pieces():
    return Pieces(default_vocabulary())


def segmentations(data, index):
    """Pieces of every segmentation."""
    if not data:
        yield []
    for end in range(1, len(data) + 1):
        if data[:end] in index:
            for rest in segmentations(data[end:], index):
                yield [index[data[:end]], *rest]


def test_recursions_against_all_segmentations(pieces):
    logs = pieces.first_weights()
    scorer = Scorer(pieces.trie, logs)
    index = {n: i for i, n in enumerate(pieces.names)}
    for word in (b"a", b"the", b"\xff\x00", "né".encode()):
        ways = list(segmentations(WORD_START + word, index))
        shares = np.exp([sum(logs[i] for i in way) for way in ways])
        assert math.isclose(scorer.log_likelihoods([word])[0], math.log(shares.sum()), abs_tol=1e-9)
        counts = np.zeros(len(pieces.names))
        scorer.expect([word], np.array([2.0]), counts)
        want = Counter()
        for way, share in zip(ways, shares / shares.sum()):
            for i in way:
                want[i] += 2 * share
        assert all(math.isclose(counts[i], v, abs_tol=1e-9) for i, v in want.items())


def test_words_of_many_lengths_score_as_each_alone(pieces):
    scorer = Scorer(pieces.trie, pieces.first_weights())
    words = [b"x" * n for n in (1, 5, 1, 700, 5)]
    together = scorer.log_likelihoods(words)
    assert np.allclose(together, [scorer.log_likelihoods([w])[0] for w in words])
    assert scorer.log_likelihoods([]).shape == (0,)


@pytest.mark.parametrize("head", [1, 300_000])
def test_base_scores_against_brute_force(spark, head):
    rows = [r[:2] for r in ROWS] + [(100 + i, f"hello word{i % 3} number", *()) for i in range(20)]
    docs = odd(spark, [(i, t, "en", "s") for i, t in rows])

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2

    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    got = score_documents(docs, default_vocabulary(), rounds=1, head=head).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        want[(i, held(i), len(words), sum(counts[w] > 0 for w in words), n, round(base, 4))] += 1
    assert want == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got
    )
    assert all(r.score < 0 for r in got)


def test_every_training_word_has_its_edge_wherever_it_is_looked_up(spark):
    texts = [f"often often often seldom{i}" for i in range(40)] + ["seldom1 seldom2 unheardof"]
    docs = odd(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    by_head = []
    for head in (1, 300_000):
        got = {r.doc_id: r.score for r in score_documents(docs, default_vocabulary(), rounds=1, head=head).collect()}
        by_head.append([got[i] for i in range(len(texts))])
    assert np.allclose(*by_head)
    # 33 or so words once each in some 140 tokens and the pieces that spell them: far likelier whole than spelled.
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(40) if i not in train]
    assert min(by_head[0][i] for i in train) > max(by_head[0][i] for i in held)


def test_the_vocabulary_keeps_its_order_without_words_to_fit(spark, pieces):
    none = spark.createDataFrame([], "word binary, n bigint")
    weights, _ = fit(none, 10, pieces, rounds=1)
    first = pieces.first_weights()
    assert np.allclose(np.diff(weights[:-1]), np.diff(first[:-1]))


def test_empty_table(spark):
    assert score_documents(empty(spark), default_vocabulary(), rounds=1).count() == 0
