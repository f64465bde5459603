"""Alignment of the tokens of two tokenizers over whole texts, and how often which ids meet.

Both tokenizers encode the whole text. Where tokens of both end at the same byte and the next token of
both is marked by a space stands an anchor; anchors split a text into windows of a few tokens, mostly a
word. A window's alignment depends on its ids alone, so a piece of texts aligns each different window once,
up to ``MEMO`` of them together by arrays.

Counts over the corpus are gathered by chunks: a chunk is a bounded stretch of texts of one task, with the
distinct id pairs it links, numbered from 0. Only a chunk's distinct pairs are shuffled to be counted, one
row for each chunk however often a pair stands in it; its texts keep the numbers of their pairs and meet
the counts again in a co-group by chunk. Nothing is broadcast by hint and no pair is a hot key.

A worker holds a piece of ``PIECE_BYTES`` of text (or one longer text, at some 100 bytes for each byte of
it), and at most ``CHUNK_PAIRS`` pairs and those of one more piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query
from framefold.llm.packing import encoder
from framefold.llm.words import pieces

PIECE_BYTES = 1 << 20
#: Different windows aligned at a time.
MEMO = 300_000
CHUNK_PAIRS, CHUNK_TEXTS = 200_000, 20_000
#: Low bits of a link's key hold the pair, high bits the text's place in its piece.
PAIR_BITS = 40

# Fixed value: how piece vocabularies write a space.
SPACE_MARK = "▁"

ALIGNED = (
    "doc_id bigint, chunk string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "links binary, times binary, pair_a array<int>, pair_b array<int>, pair_n array<bigint>"
)

_TOKENIZERS: dict[tuple[str, str], "TokenizerPair"] = {}


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the tokens, where each token starts and how long it is."""
    sizes = np.array([len(x) for x in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


def _spell(ids: list[list[int]], table: tuple[np.ndarray, np.ndarray, np.ndarray], texts: list[bytes]) -> bool:
    """Whether the tokens of each text spell it."""
    data, starts, sizes = table
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
    size = sizes[flat]
    total = np.concatenate(([0], np.cumsum(size)))
    ends = total[np.cumsum([len(x) for x in ids])]
    if not np.array_equal(ends, np.cumsum([len(t) for t in texts])):
        return False
    spelled = data[np.arange(total[-1]) + np.repeat(starts[flat] - total[:-1], size)]
    return spelled.tobytes() == b"".join(texts)


class TokenizerPair:
    """A byte-level BPE file (A) and a piece model (B), with the bytes of their tokens."""

    def __init__(self, byte_level: str, piece_model: str):
        import sentencepiece

        self.a = encoder(byte_level).fast
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.bytes_a = [self._token(i) for i in range(self.a.n_vocab)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.spaced_a = np.array([x.startswith(b" ") for x in self.bytes_a])
        self.spaced_b = np.array([x.startswith(b" ") for x in self.bytes_b])
        self.spelled_a, self.spelled_b = _table(self.bytes_a), _table(self.bytes_b)
        # Ids as windows hold them, three times: inside a side of a group, closing the side, and closing the window.
        numbers = [*map(str, range(len(self.bytes_a))), *map(str, range(len(self.bytes_b)))]
        closing = ["|"] * len(self.bytes_a) + [";"] * len(self.bytes_b)
        texts = [n + "," for n in numbers] + [n + c for n, c in zip(numbers, closing)] + numbers
        self.written = pa.array(texts, pa.large_string())

    def _token(self, i: int) -> bytes:
        try:
            return self.a.decode_single_token_bytes(i)
        except KeyError:  # an id without a token of text
            return b""

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each text; none where the text is empty or the tokens' bytes are not a space and the text."""
        spaced = [" " + t if t else "" for t in texts]
        all_a = self.a.encode_ordinary_batch(spaced, num_threads=1)
        all_b = self.b.encode(texts, num_threads=1)
        raw = [t.encode() for t in spaced]
        if not all(_spell(ids, table, raw) for ids, table in ((all_a, self.spelled_a), (all_b, self.spelled_b))):
            for k, text in enumerate(raw):
                if not all(_spell(ids, table, [text]) for ids, table in (([all_a[k]], self.spelled_a), ([all_b[k]], self.spelled_b))):
                    all_a[k], all_b[k] = [], []
        return all_a, all_b

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids of ``a`` and of ``b`` stand before the end of each window; both spell the same bytes.

        Texts may follow one another: each starts with a marked token.
        """
        at_a, at_b = self.shared(a, b)
        inner = at_b + 1 < len(b)
        marked = ~inner
        marked[inner] = self.spaced_a[a[at_a[inner] + 1]] & self.spaced_b[b[at_b[inner] + 1]]
        return at_a[marked] + 1, at_b[marked] + 1

    def shared(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and in ``b`` of the tokens that end together; both spell the same bytes."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        token_a = np.full(int(ends_a[-1]) + 1 if len(a) else 1, -1)
        token_a[ends_a] = np.arange(len(a))
        token_a = token_a[ends_b]
        at_b = np.flatnonzero(token_a >= 0)
        return token_a[at_b], at_b

    def windows(self, a: np.ndarray, b: np.ndarray, anchors: tuple[np.ndarray, np.ndarray] | None = None) -> pa.Array:
        """The id tuples between anchors as little-endian unsigned 32-bit ids, those of B raised by the ids of A."""
        to_a, to_b = anchors or self.anchors(a, b)
        from_a, from_b = (np.concatenate(([0], to[:-1])) if len(to) else to for to in (to_a, to_b))
        ids = np.empty(len(a) + len(b), "<u4")
        ids[np.arange(len(a)) + np.repeat(from_b, to_a - from_a)] = a
        ids[np.arange(len(b)) + np.repeat(to_a, to_b - from_b)] = b + len(self.bytes_a)
        places = 4 * np.concatenate(([0], to_a + to_b))
        return pa.Array.from_buffers(pa.large_binary(), len(to_a), [None, pa.py_buffer(places), pa.py_buffer(ids)])

    def unpacked(self, window: bytes) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The ids of A and of B of a window."""
        ids, n_a = np.frombuffer(window, "<u4").tolist(), len(self.bytes_a)
        cut = next(k for k, i in enumerate(ids) if i >= n_a)
        return tuple(ids[:cut]), tuple(i - n_a for i in ids[cut:])

    def align(self, windows: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Of each window the groups as text and how many links it has; all links, one a group, as ``a * n_b + b``."""
        _, places, data = windows.buffers()
        bounds = np.frombuffer(places, np.int64)[windows.offset : windows.offset + len(windows) + 1] // 4
        ids = np.frombuffer(data, "<u4")[bounds[0] : bounds[-1]].astype(np.int64)
        bounds = bounds - bounds[0]
        of_b, n_a, n_b = ids >= len(self.bytes_a), len(self.bytes_a), len(self.bytes_b)
        a, b = ids[~of_b], ids[of_b] - n_a
        before_b = np.concatenate(([0], np.cumsum(of_b)))[bounds]
        at_a, at_b = self.shared(a, b)
        links = a[at_a] * n_b + b[at_b]
        # A group's ids of A stand behind all ids of earlier groups, its ids of B behind its ids of A.
        from_b = np.concatenate(([0], at_b[:-1] + 1))
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        a[at_a] += n_a + n_b
        b[at_b] += n_a + n_b
        b[before_b[1:] - 1] += n_a + n_b
        word = np.empty(len(ids), np.int64)
        word[np.arange(len(a)) + np.repeat(from_b, in_a)] = a
        word[np.arange(len(b)) + np.repeat(at_a + 1, in_b)] = b + n_a
        _, places, data = self.written.take(pa.array(word)).buffers()
        places = np.frombuffer(places, np.int64)[bounds]
        groups = pa.Array.from_buffers(pa.large_string(), len(windows), [None, pa.py_buffer(places), data])
        return groups, np.diff(np.searchsorted(at_b, before_b)), links

    def aligned(self, all_a: list[list[int]], all_b: list[list[int]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """For texts one after the other: their groups as text, how many links each has, and all links.

        Equal windows of the texts are aligned once.
        """
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (all_a, all_b))
        anchors = self.anchors(a, b)
        found = self.windows(a, b, anchors).dictionary_encode()
        number = found.indices.to_numpy(zero_copy_only=False)
        different = found.dictionary
        known = [self.align(different.slice(k, MEMO)) for k in range(0, len(different), MEMO)]
        groups = pa.concat_arrays([pa.array([], pa.large_string()), *(g for g, _, _ in known)]).take(pa.array(number))
        size, links = (np.concatenate([np.empty(0, np.int64), *(x[k] for x in known)]) for k in (1, 2))
        sizes, begin = size[number], (np.cumsum(size) - size)[number]
        total = np.concatenate(([0], np.cumsum(sizes)))
        links = links[np.arange(total[-1]) + np.repeat(begin - total[:-1], sizes)]
        texts = np.concatenate(([0], np.searchsorted(anchors[1], np.cumsum([len(x) for x in all_b]), "right")))
        listed = pa.ListArray.from_arrays(pa.array(texts, pa.int32()), groups)
        joined = pc.binary_join(listed, pa.scalar(";", pa.large_string()))
        return joined.cast(pa.string()), np.diff(total[texts]), links


def tokenizer_pair(byte_level: str, piece_model: str) -> TokenizerPair:
    """One pair per worker and files."""
    key = byte_level, piece_model
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = TokenizerPair(byte_level, piece_model)
    return _TOKENIZERS[key]


def planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes, low bytes first: small numbers compress to about a byte."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    flat = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T)
    return flat.view("<u4").ravel().astype(np.int64)


class _Chunk:
    """The distinct pairs of a stretch of texts, numbered in order of appearance, with their links."""

    def __init__(self, name: str):
        self.name = name
        self.number: dict[int, int] = {}
        self.total = np.zeros(1024, np.int64)
        self.texts = 0

    def add(self, pairs: np.ndarray, links: np.ndarray) -> np.ndarray:
        """Numbers of distinct pairs that have so many links."""
        number = self.number
        ids = np.fromiter((number.setdefault(p, len(number)) for p in pairs.tolist()), np.int64, len(pairs))
        while len(number) > len(self.total):
            self.total = np.concatenate((self.total, np.zeros_like(self.total)))
        self.total[ids] += links
        return ids

    def row(self, n_b: int) -> pa.RecordBatch:
        pairs = np.fromiter(self.number, np.int64, len(self.number))
        values = {"chunk": self.name, "pair_a": pairs // n_b, "pair_b": pairs % n_b, "pair_n": self.total[: len(pairs)]}
        return _batch({k: [v] for k, v in values.items()}, 1)


def _batch(columns: dict[str, list | np.ndarray | pa.Array], rows: int) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "chunk": pa.string(), "groups": pa.string(), "links": pa.binary(), "times": pa.binary()}
    kinds |= {"pair_a": pa.list_(pa.int32()), "pair_b": pa.list_(pa.int32()), "pair_n": pa.list_(pa.int64())}
    names = [c.split()[0] for c in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [
            v if isinstance(v := columns.get(c, [None] * rows), pa.Array) else pa.array(v, kinds.get(c, pa.int64()))
            for c in names
        ],
        names=names,
    )


def align_documents(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """One row for each row of ``docs``, and one for each chunk of them; land it before using it twice.

    A text's row has ``doc_id, chunk, n_a, n_b, n_groups, n_links``, its ``groups`` as text (ids of A, ``|``, ids
    of B, groups joined by ``;``) and, for ``with_pair_counts``, the numbers of its linked pairs in ``links`` and
    ``times``. A chunk's row has no counts but its pairs, in ``pair_a, pair_b, pair_n``. A encodes a space and the
    text; B adds the space itself. Special tokens' strings are plain text. Texts that are null or empty, or whose
    tokens of A or B do not spell a space and the text, have zeros and empty ``groups``. Repeated rows give repeated
    results and count each time; an empty table gives no row. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(byte_level, piece_model)
        n_b = len(pair.bytes_b)
        task, serial = TaskContext.get().partitionId(), 0
        chunk = _Chunk(f"{task}-0")
        for batch in pieces(batches, "text", PIECE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            all_a, all_b = pair.encode(texts)
            groups, sizes, links = pair.aligned(all_a, all_b)
            key = np.repeat(np.arange(len(texts)) << PAIR_BITS, sizes) + links
            key, times = np.unique(key, return_counts=True)
            pairs, place = np.unique(key & ((1 << PAIR_BITS) - 1), return_inverse=True)
            number = chunk.add(pairs, np.bincount(place, times, len(pairs)).astype(np.int64))[place]
            doc = key >> PAIR_BITS
            order = np.lexsort((number, doc))
            number, times, cuts = number[order], times[order], np.searchsorted(doc, np.arange(1, len(texts)))
            yield _batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "chunk": [chunk.name] * len(texts),
                    "n_a": [len(a) for a in all_a],
                    "n_b": [len(b) for b in all_b],
                    "n_groups": sizes,  # each shared end closes a group and links its last tokens
                    "n_links": sizes,
                    "groups": groups,
                    "links": [planes(np.diff(x, prepend=0)) for x in np.split(number, cuts)],
                    "times": [planes(x) for x in np.split(times, cuts)],
                },
                len(texts),
            )
            chunk.texts += len(texts)
            if len(chunk.number) >= CHUNK_PAIRS or chunk.texts >= CHUNK_TEXTS:
                yield chunk.row(n_b)
                serial += 1
                chunk = _Chunk(f"{task}-{serial}")
        if chunk.texts:
            yield chunk.row(n_b)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ALIGNED)


def _chunk_pairs(aligned: DataFrame) -> DataFrame:
    """``chunk, no, a, b, n``: every distinct pair of every chunk."""
    return (
        aligned.where(F.col("pair_n").isNotNull())
        .select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("no", "pair"))
        .select("chunk", "no", F.col("pair.pair_a").alias("a"), F.col("pair.pair_b").alias("b"), F.col("pair.pair_n").alias("n"))
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each id pair in the corpus, and whether no other pair of ``b`` has more."""
    counts = _chunk_pairs(aligned).groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy("b"))  # at most one row for each id of A
    return counts.withColumn("best", F.col("count") == most)


def with_pair_counts(aligned: DataFrame, keep: list[str]) -> DataFrame:
    """The texts' columns ``keep`` with ``n_best`` and ``count_sum``; ``aligned`` is a landed result of ``align_documents``."""
    numbered = _chunk_pairs(aligned).join(pair_counts(aligned), ["a", "b"]).select(F.col("chunk").alias("of"), "no", "count", "best")
    texts = aligned.where(F.col("n_a").isNotNull()).select("chunk", "links", "times", *keep)

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        no = right.column("no").to_numpy()
        count, best = np.zeros(len(no), np.int64), np.zeros(len(no), np.int64)
        count[no] = right.column("count").to_numpy()
        best[no] = right.column("best").to_numpy()
        n_best, count_sum = [], []
        for links, times in zip(left.column("links").to_pylist(), left.column("times").to_pylist()):
            at, n = np.cumsum(from_planes(links)), from_planes(times)
            n_best.append(int(best[at] @ n))
            count_sum.append(int(count[at] @ n))
        out = left.select(keep)
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keep).schema.fields)
    return (
        texts.groupBy("chunk")
        .cogroup(numbered.groupBy("of"))
        .applyInArrow(add, f"{schema}, n_best bigint, count_sum bigint")
    )


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(documents(spark, sf_dir), *default_tokenizers())
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).when(F.col("n_groups") == 0, "")
    aligned = land(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    return with_pair_counts(aligned, columns).select(*columns[:-1], "n_best", "count_sum", "groups_sha256")
