"""Language of every word, and of whole documents, by a linear-chain CRF.

Features of a word are the word itself (the learned lexicon), its affixes and its letter n-grams.
The chain is learned on sequences of several documents in mixed order, so that it also learns to
change the language within a text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, id_remainder, land, query
from framefold.llm.crf import BUCKETS, WORD, Decoder, Model, hashed, train
from framefold.llm.words import pieces

#: Documents of each language that are learned from at most.
SAMPLE = 150
#: Chosen ids of all languages up to which they are broadcast to find their texts; more are joined by shuffling.
CHOSEN_IDS = 100_000
FOLDS = 3
HELD_OUT = 1
ROUNDS = 15
#: Documents in one training sequence.
SEQUENCE = 3
UNKNOWN = "und"
#: Share of a document's words that its language must have for the document to stay.
LEAST_SHARE = 0.5
#: Lengths of affixes and n-grams.
GRAMS = (1, 2, 3)
#: Bits of a code point.
LETTER_BITS = 21
#: Letters of the words whose features are made together; those of a longer word are made by themselves.
LETTERS_TOGETHER = 1 << 18

_DECODERS: dict[str, Decoder] = {}


class WordFeatures:
    """Lexicon, affixes of 1 to 3 letters and n-grams of 1 to 3 letters."""

    def __call__(self, word: str) -> list[str]:
        parts = ["bias", "w" + word]
        for n in GRAMS:
            if len(word) > n:
                parts += [f"p{word[:n]}", f"s{word[-n:]}"]
        for n in GRAMS:
            parts += dict.fromkeys(f"n{word[i : i + n]}" for i in range(len(word) - n + 1))
        return parts

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The features of many lower-case words as numbers, in the order above, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        total = np.concatenate(([0], np.cumsum(lengths)))
        parts = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        at = 0
        while at < len(words):
            end = max(at + 1, int(np.searchsorted(total, total[at] + LETTERS_TOGETHER, "right")) - 1)
            if lengths[at] > LETTERS_TOGETHER:
                alone = np.array(hashed(self(words[at])), np.int64)
                parts.append((alone, np.array([len(alone)])))
            else:
                parts.append(_ids(words[at:end], lengths[at:end]))
            at = end
        return tuple(map(np.concatenate, zip(*parts)))


features = WordFeatures()


def _ids(words: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``WordFeatures.ids`` by arrays over all letters; each different n-gram is hashed once."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = ends[word_of] - np.arange(len(letters))

    # An n-gram is one number of 21 bits a letter; words hold no letter 0.
    code = np.zeros(len(letters), np.int64)
    following = np.concatenate((letters, np.zeros(max(GRAMS), np.int64)))
    places, codes = [], []
    for n in GRAMS:
        code = code | following[n - 1 : n - 1 + len(letters)] << LETTER_BITS * (n - 1)
        places.append(np.flatnonzero(left >= n))
        codes.append(code[places[-1]])
    grams, different = _numbered(np.concatenate(codes))
    split = [different >> LETTER_BITS * (n - 1) & (1 << LETTER_BITS) - 1 for n in GRAMS]
    texts = np.stack(split, axis=1).astype(np.uint32).view(f"U{max(GRAMS)}").ravel().tolist()
    encoded = [text.encode() for text in texts]

    def hashes(kind: bytes, items: list[bytes]) -> np.ndarray:
        before = zlib.crc32(kind)
        return np.fromiter((zlib.crc32(item, before) % BUCKETS for item in items), np.int64, len(items))

    of = word_of[np.concatenate(places)]
    repeats, _ = _numbered(of * max(1, len(different)) + grams)
    new = np.diff(np.maximum.accumulate(repeats), prepend=-1) > 0
    affixes = 2 * np.clip(lengths - 1, 0, max(GRAMS))
    sizes = 2 + affixes + np.bincount(of[new], minlength=len(words))
    start = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int64)
    rest = np.ones(len(out), bool)

    def put(at: np.ndarray, ids: np.ndarray) -> None:
        out[at] = ids
        rest[at] = False

    put(start, hashes(b"bias", [b""]))
    put(start + 1, hashes(b"w", [word.encode() for word in words]))
    prefixes, suffixes = hashes(b"p", encoded), hashes(b"s", encoded)
    before = 0
    for n, place in zip(GRAMS, places):
        longer = np.flatnonzero(lengths > n)
        put(start[longer] + 2 * n, prefixes[grams[before + np.searchsorted(place, begins[longer])]])
        put(start[longer] + 2 * n + 1, suffixes[grams[before + np.searchsorted(place, ends[longer] - n)]])
        before += len(place)
    out[rest] = hashes(b"n", encoded)[grams[new][np.argsort(of[new], kind="stable")]]
    return out, sizes


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each value, in the order in which values first occur, and the different values."""
    flat = pa.array(values).dictionary_encode()
    return flat.indices.to_numpy(), flat.dictionary.to_numpy()


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """(text, lang) of at most ``sample`` documents of each language, one row for each id chosen.

    Ids are chosen first, by their hash, so other texts do not move. Of rows that repeat an id and language the one
    with the smallest text hash counts.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    )
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("n", F.dense_rank().over(by_hash)).where(F.col("n") <= sample)
    few = land(ids.select("doc_id", "lang").distinct(), "chosen-ids")
    if few.count() <= CHOSEN_IDS:
        few = F.broadcast(few)
    rows = (
        known.select("doc_id", "lang", "text")
        .join(few, ["doc_id", "lang"])
        .groupBy("doc_id", "lang")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    return [(r["text"], r["lang"]) for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id", "lang").collect()]


def fit(rows: list[tuple[str, str]], rounds: int = ROUNDS) -> Model:
    """Train on a bounded sample; ``start`` and transitions are learned with the words."""
    labels = sorted({lang for _, lang in rows})
    sequences = [(WORD.findall(text), labels.index(lang)) for text, lang in rows]
    sequences = [(words, tag) for words, tag in sequences if words]
    order = np.random.default_rng(0).permutation(len(sequences))
    sequences = [sequences[i] for i in order]
    words = [w.lower() for ws, _ in sequences for w in ws]
    tags = np.array([tag for ws, tag in sequences for _ in ws], dtype=np.int64)
    sizes = np.array([len(ws) for ws, _ in sequences], dtype=np.int64)
    first = np.zeros(len(words), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[::SEQUENCE]] = True
    return train(labels, words, tags, first, features, rounds)


def decoder_of(key: str, shared: Broadcast) -> Decoder:
    """One decoder per worker, kept from task to task while the model stays."""
    if key not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[key] = Decoder(shared.value, features)
    return _DECODERS[key]


def document_shares(counts: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Mean posterior of each document's words (documents, K); zeros without words."""
    out = np.zeros((len(counts), posterior.shape[1]))
    has = counts > 0
    if has.any():
        out[has] = np.add.reduceat(posterior, (np.cumsum(counts) - counts)[has], axis=0) / counts[has, None]
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_hash, lang_pred, score, shares`` of every row.

    ``shares`` gives the languages that hold at least 5 % of the words. ``lang_pred`` is the one with the most,
    ``und`` with score 0 if the text is null or has no letter, or if no language could be learned. Repeated rows get
    equal results; other columns than ``doc_id`` and ``text`` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # hashed weights for each language
    key = uuid.uuid4().hex
    labels = model.labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(key, shared)
        for batch in pieces(batches, "text"):
            texts = batch.column(2).to_pylist()
            langs: list[str] = []
            scores: list[float] = []
            parts: list[list[tuple[str, float]]] = []
            for _, counts, posterior in decoder.decode(texts) if labels else ():
                for n, share in zip(counts.tolist(), document_shares(counts, posterior)):
                    best = int(share.argmax())
                    langs.append(labels[best] if n else UNKNOWN)
                    scores.append(float(min(1.0, share[best])) if n else 0.0)
                    parts.append([(labels[j], float(share[j])) for j in np.flatnonzero(share >= 0.05)])
            if not labels:
                langs, scores, parts = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(parts, pa.map_(pa.string(), pa.float64())),
                ],
                names=["doc_id", "text_hash", "lang_pred", "score", "shares"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, lang_pred string, score double, shares map<string, double>"
    )


def keep_known(docs: DataFrame, model: Model, least: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text has letters and one language for at least ``least`` of its words.

    Null texts and texts without a letter go. If no language could be learned, only those go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # hashed weights for each language
    key = uuid.uuid4().hex
    learned = bool(model.labels)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = batch.column(at).to_pylist()
            if learned:
                decoder = decoder_of(key, shared)
                kept = [
                    (counts > 0) & (document_shares(counts, p).max(axis=1) >= least)
                    for _, counts, p in decoder.decode(texts)
                ]
                mask = np.concatenate(kept) if kept else np.zeros(0, dtype=bool)
            else:
                mask = np.array([bool(t and WORD.search(t)) for t in texts], dtype=bool)
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def word_spans(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Runs of words of one language, (start, end, lang) in code points."""
    _, _, posterior = next(Decoder(model, features).decode([text]))
    spans: list[tuple[int, int, str]] = []
    for found, tag in zip(WORD.finditer(text), posterior.argmax(axis=1).tolist()):
        lang = model.labels[tag]
        if spans and spans[-1][2] == lang:
            spans[-1] = (spans[-1][0], found.end(), lang)
        else:
            spans.append((found.start(), found.end(), lang))
    return spans


@query("op8_crf_language_id")
def _(spark, sf):
    """Language of every document by a CRF over words, learned outside the held-out fold."""
    docs = documents(spark, sf)
    return identify(docs, fit(training_rows(docs))).select(
        "doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
