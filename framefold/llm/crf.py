"""Linear-chain conditional random fields over words, on concatenated texts.

The words of many documents form one chain that starts anew at each document. The chain is
folded into about sqrt(n) pieces of equal length and the recursions run over all pieces at
once: first each piece's product of transition matrices, then the pieces one after the other,
then inside all pieces. The result is that of the plain recursions, for texts of any length.

A worker holds the scores of the words it knows (some 100 MB at most), the features of ``SCORED_WORDS``
new ones and one chain, which has ``CHAIN_WORDS`` words unless one text has more.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

#: Words: runs of letters of any script.
WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 18
#: Distinct words, and letters in them, that a worker remembers before it forgets all.
KNOWN_WORDS = 400_000
KNOWN_LETTERS = 16_000_000
#: Words whose features are made together.
SCORED_WORDS = 16_000
#: Words that are decoded together, unless one document has more. Posteriors do not depend on it.
CHAIN_WORDS = 50_000


def marginals(emit: np.ndarray, transition: np.ndarray, start: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Posterior label probabilities (n, K) by forward-backward; ``first`` marks the words that begin a document."""
    return expectations(emit, transition, start, first)[0]


def expectations(
    emit: np.ndarray, transition: np.ndarray, start: np.ndarray, first: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors, and with ``pairs`` the expected number of each transition (K, K) inside documents."""
    n, k = emit.shape
    total = np.zeros((k, k))
    if n == 0:
        return emit, total
    length = int(np.ceil(np.sqrt(n)))
    pieces = -(-n // length)
    padded = length * pieces
    scores = np.ones((padded, k))
    scores[:n] = np.exp(emit - emit.max(axis=1, keepdims=True))
    begins = np.ones(padded, dtype=bool)
    begins[:n] = first
    e = np.ascontiguousarray(scores.reshape(pieces, length, k).transpose(1, 0, 2))
    anew = np.ascontiguousarray(begins.reshape(pieces, length).T)
    a = np.exp(transition - transition.max())
    pi = np.exp(start - start.max())

    product = np.broadcast_to(np.eye(k), (pieces, k, k)).copy()
    for t in range(length):
        step = product @ a
        if anew[t].any():
            at = anew[t]
            step[at] = product[at].sum(axis=2, keepdims=True) * pi
        product = step * e[t][:, None, :]
        product /= product.max(axis=(1, 2), keepdims=True)
    into = np.empty((pieces, k))
    out = np.empty((pieces, k))
    vector = np.full(k, 1.0 / k)
    for c in range(pieces):
        into[c] = vector
        vector = vector @ product[c]
        vector /= vector.sum()
    vector = np.full(k, 1.0 / k)
    for c in range(pieces - 1, -1, -1):
        out[c] = vector
        vector = product[c] @ vector
        vector /= vector.sum()

    alpha = np.empty_like(e)
    now = into
    for t in range(length):
        step = now @ a
        if anew[t].any():
            step[anew[t]] = pi
        now = step * e[t]
        now /= now.sum(axis=1, keepdims=True)
        alpha[t] = now
    later = out
    posterior = np.empty_like(e)
    for t in range(length - 1, -1, -1):
        both = alpha[t] * later
        posterior[t] = both / both.sum(axis=1, keepdims=True)
        seen = later * e[t]
        if pairs:
            before = alpha[t - 1] if t else into
            joint = before[:, :, None] * a * seen[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            total += joint[~anew[t]].sum(axis=0)
        step = seen @ a.T
        if anew[t].any():
            step[anew[t]] = (seen[anew[t]] @ pi)[:, None]
        later = step / step.sum(axis=1, keepdims=True)
    return posterior.transpose(1, 0, 2).reshape(padded, k)[:n], total


def hashed(features: list[str]) -> list[int]:
    return [zlib.crc32(f.encode()) % BUCKETS for f in features]


@dataclass
class Model:
    """Weights of hashed word features, of transitions and of first labels."""

    labels: list[str]
    weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    extra: dict = field(default_factory=dict)

    def scores(self, words: list[str], features: Callable[[str], list[str]]) -> np.ndarray:
        """Emission scores (n, K) of distinct words."""
        if not words:
            return np.zeros((0, len(self.labels)))
        ids, sizes = feature_ids(words, features)
        return np.add.reduceat(self.weights[ids], np.cumsum(sizes) - sizes, axis=0).astype(np.float64)


def feature_ids(words: list[str], features: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words one after the other, and how many each word has (one at least).

    ``features`` may have a method ``ids`` that gives the same for many lower-case words at once.
    """
    lowered = [w.lower() for w in words]
    if hasattr(features, "ids"):
        return features.ids(lowered)
    each = [hashed(features(w)) for w in lowered]
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    return np.fromiter((i for ids in each for i in ids), np.int64, int(sizes.sum())), sizes


class Decoder:
    """Decodes texts with a model; keeps the emission scores of words it has met."""

    def __init__(self, model: Model, features: Callable[[str], list[str]]):
        self.model = model
        self.features = features
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((1024, len(self.model.labels)))

    def rows(self, words: list[str]) -> np.ndarray:
        known = self.known
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if fresh:
            if len(known) + len(fresh) > KNOWN_WORDS or self.letters > KNOWN_LETTERS:
                self.forget()
                known = self.known
                fresh = list(dict.fromkeys(words))
            self.letters += sum(map(len, fresh))
            at = len(known)
            while at + len(fresh) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            for k in range(0, len(fresh), SCORED_WORDS):
                some = fresh[k : k + SCORED_WORDS]
                self.table[at + k : at + k + len(some)] = self.model.scores(some, self.features)
            known.update(zip(fresh, range(at, at + len(fresh))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def decode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For groups of texts: number of texts, words in each, posteriors of all their words."""
        words: list[str] = []
        sizes: list[int] = []
        for text in texts:
            found = WORD.findall(text) if text else []
            if words and len(words) + len(found) > CHAIN_WORDS:
                yield self._chain(words, sizes)
                words, sizes = [], []
            words += found
            sizes.append(len(found))
        if sizes:
            yield self._chain(words, sizes)

    def _chain(self, words: list[str], sizes: list[int]) -> tuple[int, np.ndarray, np.ndarray]:
        counts = np.array(sizes, dtype=np.int64)
        first = np.zeros(len(words), dtype=bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        rows = self.rows(words)  # may grow the table
        return len(sizes), counts, marginals(self.table[rows], self.model.transition, self.model.start, first)


def train(
    labels: list[str],
    words: list[str],
    tags: np.ndarray,
    first: np.ndarray,
    features: Callable[[str], list[str]],
    rounds: int = 25,
    rate: float = 0.3,
    decay: float = 1e-3,
) -> Model:
    """Fit a chain to tagged words by full-batch Adam on the conditional likelihood.

    The gradient of a weight is its count under the tags minus its expected count by forward-backward.
    """
    k = len(labels)
    distinct = list(dict.fromkeys(words))
    number = {w: i for i, w in enumerate(distinct)}
    which = np.fromiter((number[w] for w in words), np.int64, len(words))
    ids, sizes = feature_ids(distinct, features)
    used, ids = np.unique(ids, return_inverse=True)
    begin = np.cumsum(sizes) - sizes
    gold = np.eye(k)[tags]
    inner = ~first[1:]
    pairs = gold[:-1][inner].T @ gold[1:][inner]
    params = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    n = max(1, len(words))
    for step in range(1, rounds + 1) if words else ():
        emit = np.add.reduceat(params[0][ids], begin, axis=0)[which]
        posterior, expected = expectations(emit, params[1], params[2], first, pairs=True)
        gap = gold - posterior
        by_word = np.stack([np.bincount(which, gap[:, j], len(distinct)) for j in range(k)], axis=1)
        spread = np.repeat(by_word, sizes, axis=0)
        found = np.stack([np.bincount(ids, spread[:, j], len(used)) for j in range(k)], axis=1)
        moved = pairs - expected
        began = gap[first].sum(axis=0)
        for p, g, m, s in zip(params, (found, moved, began), mean, square):
            g = g / n - decay * p / n
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-10)
    weights = np.zeros((BUCKETS, k), dtype=np.float32)
    weights[used] = params[0]
    return Model(labels, weights, params[1], params[2])
