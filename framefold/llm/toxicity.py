"""Toxic spans by a linear-chain CRF over words, and document scores from its marginals.

Labels exist for whole documents. Words of toxic documents are tagged toxic if they, or an affix of
theirs, occur in several toxic and in almost no clean documents of the training sample; a
first model then re-tags the toxic documents, so that the final one also learns from context.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framefold.llm.common import documents, id_remainder, query
from framefold.llm.crf import WORD, Decoder, Model, train

#: Clean and toxic documents that are learned from at most, those with the smallest hashes of their id.
SAMPLE = (2400, 800)
#: Of these, clean and toxic ones whose words the chain is fitted to: those with the smallest hashes that have words.
CHAIN_SAMPLE = (600, 400)
#: Toxic documents in which a word or affix must occur to tag words, and how much rarer it must be in clean ones.
LEAST_DOCUMENTS = 3
RATIO = 25.0
FOLDS = 5
HELD_OUT = 0
ROUNDS = 12
TAGS = ["clean", "toxic"]

_DECODERS: dict[str, Decoder] = {}


def decoder_of(key: str, shared: Broadcast) -> Decoder:
    """One decoder per worker, kept from task to task while the model stays."""
    if key not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[key] = Decoder(shared.value, features)
    return _DECODERS[key]


def features(word: str) -> list[str]:
    """The word, and prefixes and suffixes of 4 and 5 letters."""
    parts = ["bias", "w" + word]
    for n in (4, 5):
        if len(word) > n:
            parts += [f"p{word[:n]}", f"s{word[-n:]}"]
    return parts


def training_rows(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> list[tuple[str, int]]:
    """(text, label) of at most ``sample`` labelled documents of the labels 0 and 1, outside the held-out fold.

    Ids are chosen first, so texts of other documents do not move. Null labels are no labels; a document
    with both labels counts as toxic. Of rows that repeat an id the one with the smallest text hash counts. Rows come
    in the order of the ids' hashes.
    """
    chosen = (
        labels.where("toxic is not null")
        .where(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    parts = [
        chosen.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample[label]) for label in (0, 1)
    ]
    few = parts[0].union(parts[1])  # ids, at most sum(sample)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(few), "doc_id")
        .groupBy("doc_id")
        .agg(F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0))).alias("text"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
    )
    return [(r["text"] or "", r["toxic"]) for r in rows.collect()]


def toxic_features(sample: list[tuple[list[str], int]], least: int = LEAST_DOCUMENTS, ratio: float = RATIO) -> set[str]:
    """Features of words that stand for toxic documents."""
    seen = (Counter(), Counter())
    size = [0, 0]
    for words, label in sample:
        size[label] += 1
        seen[label].update({f for w in set(words) for f in features(w)})
    rarer = ratio * size[1] / max(1, size[0])
    return {f for f, n in seen[1].items() if n >= max(least, rarer * (seen[0][f] + 1))}


def fit(rows: list[tuple[str, int]], rounds: int = ROUNDS) -> Model:
    """Train on a bounded sample; without toxic or without clean documents the model knows only the label's share."""
    sample = [([w.lower() for w in WORD.findall(text)], label) for text, label in rows]
    marks = toxic_features(sample)
    left = list(CHAIN_SAMPLE)
    chain = []
    for ws, y in sample:
        if ws and left[y]:
            left[y] -= 1
            chain.append((ws, y))
    sample = chain
    words = [w for ws, _ in sample for w in ws]
    label = np.array([y for ws, y in sample for _ in ws], dtype=np.int64)
    first = np.zeros(len(words), dtype=bool)
    sizes = np.array([len(ws) for ws, _ in sample], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    first[begin] = True
    marked = {w: any(f in marks for f in features(w)) for w in set(words)}
    tags = label * np.fromiter((marked[w] for w in words), np.int64, len(words))
    model = train(TAGS, words, tags, first, features, rounds)
    if len(words):
        # Words of toxic documents that the model takes for toxic, tagged or not, are the tags of the second fit.
        toxic = Decoder(model, features)
        posterior = np.concatenate([p for _, _, p in toxic.decode([" ".join(ws) for ws, _ in sample])])[:, 1]
        tags = label * ((posterior >= 0.5) | (tags == 1))
        model = train(TAGS, words, tags, first, features, rounds)
    peaks = []
    for _, counts, posterior in Decoder(model, features).decode([text for text, _ in rows]):
        peaks.append(peak(counts, posterior[:, 1] if len(posterior) else np.zeros(0)))
    model.extra["platt"] = platt(np.concatenate(peaks) if peaks else np.zeros(0), np.array([y for _, y in rows]))
    return model


def peak(counts: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Log-odds of the likeliest toxic word of each document; documents without words have the least."""
    out = np.zeros(len(counts))
    has = counts > 0
    if has.any():
        out[has] = np.maximum.reduceat(posterior, (np.cumsum(counts) - counts)[has])
    out = np.clip(out, 1e-6, 1 - 1e-6)
    return np.log(out / (1 - out))


def platt(x: np.ndarray, y: np.ndarray, rounds: int = 500) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic calibration, with classes weighed by their rows."""
    slope, offset = 0.5, 0.0
    for _ in range(rounds if len(x) else 0):
        gap = y - 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        slope = max(0.0, slope + 0.05 * float((gap * x).mean()))
        offset += 0.2 * float(gap.mean())
    return slope, offset


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, spans`` of every row; spans are (start, end, score) in code points.

    A span is a run of words with a posterior of at least one half. Null and empty texts have no spans and
    the score of a text without toxic words. Repeated rows get equal results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of hashed weights, of one size always
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(key, shared)
        slope, offset = decoder.model.extra["platt"]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores: list[float] = []
            spans: list[list[dict]] = []
            at = 0
            for n, counts, posterior in decoder.decode(texts):
                toxic = posterior[:, 1] if len(posterior) else np.zeros(0)
                peaks = peak(counts, toxic)
                scores += (1 / (1 + np.exp(-np.clip(slope * peaks + offset, -30, 30)))).tolist()
                begin = np.cumsum(counts) - counts
                for text, top, b, c in zip(texts[at : at + n], peaks.tolist(), begin.tolist(), counts.tolist()):
                    spans.append(toxic_spans(text, toxic[b : b + c]) if top >= 0 else [])
                at += n
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(spans, kind),
                ],
                names=["doc_id", "score", "predicted", "spans"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run,
        "doc_id bigint, score double, predicted int, spans array<struct<start: bigint, end: bigint, score: double>>",
    )


def toxic_spans(text: str, posterior: np.ndarray) -> list[dict]:
    """Runs of toxic words as one span each, with the highest posterior of the run."""
    out: list[dict] = []
    before = False
    for found, p in zip(WORD.finditer(text), posterior.tolist()):
        if p >= 0.5:
            if before:
                out[-1]["end"] = found.end()
                out[-1]["score"] = max(out[-1]["score"], p)
            else:
                out.append({"start": found.start(), "end": found.end(), "score": p})
        before = p >= 0.5
    return out


@query("op6_crf_toxicity")
def _(spark, sf):
    """Toxicity score of every document by a CRF learned outside the held-out fold."""
    docs = documents(spark, sf)
    model = fit(training_rows(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    return score_documents(docs, model).select(
        "doc_id",
        (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        "predicted",
        F.size("spans").alias("n_spans"),
    )
