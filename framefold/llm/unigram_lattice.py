"""Document likelihood under a unigram subword model, summed over all segmentations.

The pieces are those of a given vocabulary; its scores start the weights, which expectation
maximisation then fits to the training words, and stay in them as a prior. Every training word has an edge of
its own over the whole word, with its count as weight, at any frequency; the pieces, which have to spell the
words that training lacks, are fitted to each distinct training word once. Pieces do not cross white space, so
the lattice of a document is the chain of its words' lattices, and its marginal is the product of theirs: the
forward recursion of each distinct word is run once and joined to the texts that have it.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framefold.llm.common import documents, id_remainder, land, query

FOLDS = 7
HELD_OUT = 2
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Words of at least one in so many training tokens are looked up in the workers; there are no more of them than that.
HEAD = 300_000
#: Distinct words a worker gathers before it hands them on.
GATHERED = 300_000
#: Cells (words times bytes) of a table of forward sums.
CELLS = 400_000
#: Added to the expected counts for each piece, in the proportions of the first weights, so that no piece is impossible.
SMOOTHING = 0.01
WORD_START = "▁".encode()

_SCORERS: dict[str, Scorer] = {}


def tokens(text: str | None) -> list[bytes]:
    """Words of a whole text, ASCII letters lower-cased; bytes split at ASCII white space only."""
    return (text or "").encode().lower().split()


class Trie:
    """Pieces by their bytes, walked for many words at once.

    ``piece`` is the piece that ends in a state, or -1. Transitions travel as a list of (state and byte, next state);
    where they are used they stand in a table of states and the bytes that occur, some 50 MB for 32,000 pieces.
    """

    def __init__(self, names: list[bytes]):
        states: dict[bytes, int] = {b"": 0}
        ends = [-1]
        for i, name in enumerate(names):
            for end in range(1, len(name) + 1):
                if name[:end] not in states:
                    states[name[:end]] = len(ends)
                    ends.append(-1)
            ends[states[name]] = i
        self.piece = np.array(ends, dtype=np.int64)
        self.keys = np.array([states[p[:-1]] * 256 + p[-1] for p in states if p], dtype=np.int64)
        self.children = np.array([state for p, state in states.items() if p], dtype=np.int32)
        self.table: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "table": None}

    def _build(self) -> np.ndarray:
        used = np.unique(self.keys % 256)
        self.column = np.full(256, len(used))  # the last one has no transitions
        self.column[used] = np.arange(len(used))
        self.table = np.full((len(self.piece), len(used) + 1), -1, dtype=np.int32)
        self.table[self.keys // 256, self.column[self.keys % 256]] = self.children
        return self.table

    def step(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Following states, -1 where there is none."""
        table = self._build() if self.table is None else self.table
        return table[states, self.column[data]]


class Pieces:
    """The pieces of a vocabulary by their bytes; all 256 single bytes are among them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names: dict[bytes, float] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i):
                continue
            piece = model.id_to_piece(i)
            data = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.encode()
            names[data] = max(names.get(data, -math.inf), model.get_score(i))
        for b in range(256):
            names.setdefault(bytes([b]), min(names.values()))
        self.names = sorted(names)
        self.trie = Trie(self.names)
        self.scores = np.array([names[n] for n in self.names])

    def first_weights(self) -> np.ndarray:
        """Weights that fall with the vocabulary's own order of scores, as word frequencies do; the last is the end's."""
        order = np.empty(len(self.names))
        order[np.argsort(-self.scores, kind="stable")] = np.arange(1, len(self.names) + 1)
        return self.logs(np.append(1.0 / order, 0.1))

    @staticmethod
    def logs(counts: np.ndarray, others: float = 0.0) -> np.ndarray:
        """Shares of ``counts`` in their sum and ``others``, as logarithms."""
        return np.log(counts) - math.log(counts.sum() + others)


Edges = list[tuple[int, int, np.ndarray, np.ndarray]]


class Scorer:
    """Forward and backward recursions, in log space, over the lattices of many words of one length at once."""

    def __init__(self, trie: Trie, logs: np.ndarray):
        self.trie = trie
        self.logs = logs

    def groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of words of one length, and their bytes after the word mark."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        limits = np.flatnonzero(np.diff(lengths[order])) + 1
        for same in np.split(order, limits) if len(words) else ():
            size = max(1, CELLS // (int(lengths[same[0]]) + len(WORD_START) + 1))
            for at in range(0, len(same), size):
                part = same[at : at + size]
                data = b"".join([WORD_START + words[i] for i in part.tolist()])
                yield part, np.frombuffer(data, np.uint8).reshape(len(part), -1).astype(np.int64)

    def forward(self, data: np.ndarray) -> tuple[Edges, np.ndarray]:
        """Edges (start, end, words that have one, their pieces) in order of start, and the forward sums."""
        m, n = data.shape
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0.0
        edges: Edges = []
        for start in range(n):
            rows = np.arange(m)
            state = np.zeros(m, dtype=np.int64)
            for end in range(start + 1, n + 1):
                state = self.trie.step(state, data[rows, end - 1])
                alive = state >= 0
                rows, state = rows[alive], state[alive]
                if not len(rows):
                    break
                piece = self.trie.piece[state]
                whole = piece >= 0
                if whole.any():
                    which, piece = rows[whole], piece[whole]
                    reached = alpha[start, which] + self.logs[piece]
                    alpha[end, which] = np.logaddexp(alpha[end, which], reached)
                    edges.append((start, end, which, piece))
        return edges, alpha

    def log_likelihoods(self, words: list[bytes]) -> np.ndarray:
        """Natural logarithms of the sums over all segmentations of each word into pieces."""
        out = np.zeros(len(words))
        for part, data in self.groups(words):
            out[part] = self.forward(data)[1][-1]
        return out

    def expect(self, words: list[bytes], times: np.ndarray, counts: np.ndarray) -> None:
        """Add the expected number of each piece in ``times`` occurrences of the words."""
        for part, data in self.groups(words):
            edges, alpha = self.forward(data)
            beta = np.full(alpha.shape, -np.inf)
            beta[-1] = 0.0
            n_times = times[part]
            shares = []
            for start, end, which, piece in reversed(edges):
                value = self.logs[piece] + beta[end, which]
                beta[start, which] = np.logaddexp(beta[start, which], value)
                shares.append(np.exp(alpha[start, which] + value - alpha[-1, which]) * n_times[which])
            pieces = [piece for *_, piece in reversed(edges)]
            counts += np.bincount(np.concatenate(pieces), np.concatenate(shares), len(counts))


def _scorer(key: str, shared: Broadcast) -> Scorer:
    """One scorer per worker while the weights stay."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(*shared.value)
    return _SCORERS[key]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts of ``docs``: every word, with its occurrences in rows where ``training`` holds.

    Workers hand on sums of at most ``GATHERED`` words, added up after the shuffle.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text, training in zip(batch.column(0), batch.column(1).to_pylist()):
                words = tokens(text.as_py())
                if training:
                    counts.update(words)
                else:
                    for word in words:
                        counts.setdefault(word, 0)
                if len(counts) >= GATHERED:
                    yield rows()
                    counts.clear()
        yield rows()

    return (
        docs.select("text", "training")
        .mapInArrow(gather, "word binary, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def fit(
    counts: DataFrame, texts: int, pieces: Pieces, others: float = 0.0, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Log weights of the pieces and, last, of the end of a text, fitted to ``counts`` of words that the pieces spell;
    the sum that the weights are shares of. ``others`` is the number of training tokens with an edge of their own.
    The prior has the proportions of the vocabulary's own weights, so these stay where there are few words.

    Each round sends one row per piece and task, and brings one per piece to the driver: the vocabulary bounds both.
    """
    logs = pieces.first_weights()
    size = len(pieces.names)
    prior = np.exp(logs) * (SMOOTHING * size)
    for _ in range(max(1, rounds)):
        shared = counts.sparkSession.sparkContext.broadcast((pieces.trie, logs))  # bounded by the vocabulary
        key = uuid.uuid4().hex

        def expect(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            scorer = _scorer(key, shared)
            sums = np.zeros(size)
            for batch in batches:
                scorer.expect(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float), sums)
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "n"])

        rows = (
            counts.mapInArrow(expect, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        )
        expected = prior.copy()
        for row in rows:
            expected[row["piece"]] += row["n"]
        expected[size] += texts
        logs = Pieces.logs(expected, others)
    return logs, float(expected.sum() + others)


def _likelihoods(counts: DataFrame, trie: Trie, weights: np.ndarray, mass: float) -> DataFrame:
    """``word, n, log``: the natural logarithm of each word's marginal, its own edge of ``n`` in ``mass`` included."""
    shared = counts.sparkSession.sparkContext.broadcast((trie, weights))  # bounded by the vocabulary
    key = uuid.uuid4().hex
    log_mass = math.log(mass) if mass else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)
        for batch in batches:
            logs = scorer.log_likelihoods(batch.column(0).to_pylist())
            n = batch.column(1).to_numpy().astype(float)
            own = np.log(n, out=np.full(len(n), -np.inf), where=n > 0) - log_mass
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.logaddexp(logs, own))], names=["word", "n", "log"]
            )

    return counts.select("word", "n").mapInArrow(run, "word binary, n bigint, log double")


def score_documents(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Trained on the rows outside the held-out fold, repeated rows as often as they occur. ``score`` is the
    log10 probability of the text: its words' marginals and the end's. ``base_score`` is that of a word unigram with
    one added to every count. A null or empty text has the end as its only token. Words that are frequent in
    training are looked up in a broadcast table of at most ``head`` words; counts and marginals of all others are
    joined, keyed by word and so spread evenly. ``head`` says where a word is looked up and changes no result.
    """
    spark = docs.sparkSession
    pieces = Pieces(vocabulary)
    in_training = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    texts = docs.where(in_training).count()
    counts = land(word_counts(docs.select("text", in_training.alias("training"))), "words")
    trained = counts.where("n > 0")
    total = trained.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]
    n_train = total["n"] + texts
    distinct = total["v"] + (texts > 0)
    weights, mass = fit(trained.select("word", F.lit(1).alias("n")), texts, pieces, total["n"], rounds)
    likely = land(_likelihoods(counts, pieces.trie, weights, mass), "likelihoods")
    is_often = (F.col("n") > 0) & (F.col("n") * head >= n_train)
    # At most head rows, because counts sum to n_train.
    table = {bytes(r["word"]): (r["n"], r["log"]) for r in likely.where(is_often).collect()}
    seldom = likely.where(~is_often)
    shared_head = spark.sparkContext.broadcast(table)
    ln10 = math.log(10)
    end = float(weights[-1]) / ln10

    def main(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_head.value
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(2):
                score, logs, seen, n = 0.0, 0.0, 0, 0
                for word, times in Counter(tokens(text.as_py())).items():
                    n += times
                    found = known.get(word)
                    if found is not None:
                        seen += times
                        logs += times * math.log10(found[0] + 1)
                        score += times * found[1]
                rows.append((n, seen, logs, score / ln10 + end))
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "text_hash", "n_words", "head_known", "head_logs", "head_score"],
            )

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_head.value
        for batch in batches:
            keys: list[int] = []
            words: list[bytes] = []
            times: list[int] = []
            for text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter([w for w in tokens(text.as_py()) if w not in known])
                keys += [text_hash] * len(found)
                words += found.keys()
                times += found.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(words, pa.binary()), pa.array(times, pa.int32())],
                names=["text_hash", "word", "times"],
            )

    hashed = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text")
    rows = land(
        hashed.mapInArrow(
            main,
            "doc_id bigint, text_hash bigint, n_words bigint, head_known bigint, head_logs double, head_score double",
        ),
        "scores",
    )
    tail = (
        hashed.select("text_hash", "text")
        .mapInArrow(rest, "text_hash bigint, word binary, times int")
        .join(seldom, "word")
        .groupBy("text_hash")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"),
            F.sum(F.col("times") * F.col("log")).alias("score"),
        )
    )
    copies = rows.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies"))
    # Equal texts were read once for each copy and have the same words.
    tail = tail.join(copies, "text_hash").select(
        "text_hash",
        F.expr("known div copies").alias("known"),
        (F.col("logs") / F.col("copies")).alias("logs"),
        (F.col("score") / F.col("copies") / ln10).alias("tail_score"),
    )
    zero = F.lit(0).cast("bigint")
    n_tokens = F.col("n_words") + 1
    base = (
        F.col("head_logs")
        + F.coalesce("logs", F.lit(0.0))
        + math.log10(texts + 1)
        - n_tokens * math.log10(n_train + distinct + 1)
    )
    return rows.join(tail, "text_hash", "left").select(
        "doc_id",
        (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("head_known") + F.coalesce("known", zero) + int(texts > 0)).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )


def default_vocabulary() -> str:
    """The public piece vocabulary installed on this machine; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_unigram_lattice_scores")
def _(spark, sf):
    """Marginal log10 probability of every document, and that of a word unigram."""
    return score_documents(documents(spark, sf), default_vocabulary())
