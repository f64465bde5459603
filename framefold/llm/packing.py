"""Best-fit packing of tokenized documents into fixed-capacity sequences.

Only piece *lengths* decide how pieces combine, and there are at most ``capacity``
lengths. So the corpus is reduced to a histogram of lengths, the packing plan is
made on that histogram, with multiplicities, and the pieces then look up their
place by their rank within their length. Neither the plan nor its cost grows with
the corpus; no piece passes the driver.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query

CAPACITY = 2048
#: Parts in which the pieces of one length are ranked.
SALTS = 256

# Fixed value: the pattern that splits text before merges in byte-level BPE vocabularies of this kind.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

_ENCODERS: dict[str, TextEncoder] = {}


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies spell bytes as printable characters; the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextEncoder:
    """Token ids of whole texts for one byte-level BPE file.

    The vocabulary, merges and special tokens are those of the file. Ordinary text goes
    through the faster merge loop of tiktoken, fed with the same vocabulary; a text that
    holds a special token's string goes through the tokenizers library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        symbol = _byte_of_symbol()
        ranks = {
            bytes(symbol[c] for c in token): i
            for token, i in spec["model"]["vocab"].items()
            if token not in self.special
        }
        self.fast = tiktoken.Encoding(
            "byte_level", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.exact = Tokenizer.from_file(path)

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def encoder(path: str) -> TextEncoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole capacities, what is over comes first."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``.

    A document is the ids of its whole text followed by ``end_id``; a null text counts as empty, so
    every document has at least one piece. Repeated rows give repeated pieces. ``ids`` are
    little-endian unsigned 32-bit integers. Other columns of ``docs`` are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            blobs = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.ids(text.as_py() or "")
                ids.append(end_id)
                data = np.array(ids, "<u4").tobytes()
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(part))):
                        column.append(value)
                    if keep_ids:
                        blobs.append(part)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(v, t) for v, t in zip(rows, types)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(blobs, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        encode, PIECES + (", ids binary" if keep_ids else "")
    )


class _Complements:
    """Which single, pair or triple of available lengths sums exactly to a gap.

    Sums are the hash key. A witness found for a sum is kept and checked against the
    counts when used; a sum without one never gets one, because counts only fall.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.pairs: dict[int, tuple[int, int] | None] = {}
        self.triples: dict[int, tuple[int, int, int] | None] = {}

    def enough(self, combo: tuple[int, ...]) -> bool:
        return all(self.counts[length] >= n for length, n in Counter(combo).items())

    def pair(self, total: int) -> tuple[int, int] | None:
        if total < 2:
            return None
        known = self.pairs.get(total, ())
        if known is None or (known and self.enough(known)):
            return known
        have = self.counts[1:total] > 0
        both = have & have[::-1]
        if total % 2 == 0 and self.counts[total // 2] < 2:
            both[total // 2 - 1] = False
        found = np.flatnonzero(both)
        a = int(found[-1]) + 1 if len(found) else 0
        self.pairs[total] = (a, total - a) if a else None
        return self.pairs[total]

    def triple(self, total: int) -> tuple[int, int, int] | None:
        if total < 3:
            return None
        known = self.triples.get(total, ())
        if known is None or (known and self.enough(known)):
            return known
        result = None
        for a in (np.flatnonzero(self.counts[1 : total - 1])[::-1] + 1).tolist():
            # Take one of length a away while its pair is looked for; a failure then proves nothing lasting.
            self.counts[a] -= 1
            rest = self.pairs.get(total - a, ())
            if rest == () or (rest and not self.enough(rest)):
                rest = _Complements(self.counts).pair(total - a)
            self.counts[a] += 1
            if rest:
                result = (a, *rest)
                break
        self.triples[total] = result
        return result

    def fill(self, gap: int) -> tuple[int, ...] | None:
        if self.counts[gap] > 0:
            return (gap,)
        return self.pair(gap) or self.triple(gap)


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Patterns ``(number of sequences, lengths in each)`` that use up ``histogram`` (length to count).

    From the longest length down, its gap to ``capacity`` is filled exactly by one, two or three
    available lengths as often as the counts allow; what no combination completes is placed best
    fit, longest first. Both steps work on whole counts, never on single pieces.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[tuple[int, list[int]]] = []
    index = _Complements(counts)
    residual: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while counts[length]:
            if length == capacity:
                combo: tuple[int, ...] = ()
            else:
                counts[length] -= 1
                found = index.fill(capacity - length)
                counts[length] += 1
                if found is None:
                    residual[length] = int(counts[length])
                    counts[length] = 0
                    break
                combo = found
            need = Counter((length, *combo))
            times = int(min(counts[k] // n for k, n in need.items()))
            for k, n in need.items():
                counts[k] -= times * n
            patterns.append((times, [length, *combo]))
    return patterns + _best_fit(residual, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit, longest first, with open sequences grouped by their gap."""
    open_by_gap: dict[int, list[list]] = {}
    done: list[tuple[int, list[int]]] = []

    def put(times: int, lengths: list[int], gap: int) -> None:
        if gap:
            open_by_gap.setdefault(gap, []).append([times, lengths])
        else:
            done.append((times, lengths))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            gap = min((g for g in open_by_gap if g >= length), default=0)
            if gap:
                times, lengths = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
                each = min(gap // length, max(1, left // times))
                if times * each > left:
                    put(times - left, lengths, gap)
                    times, each = left, 1
            else:
                each = min(capacity // length, left)
                times, lengths, gap = left // each, [], capacity
            put(times, lengths + [length] * each, gap - each * length)
            left -= times * each
    for groups in open_by_gap.values():
        done += [(times, lengths) for times, lengths in groups]
    return done


def _places(patterns: list[tuple[int, list[int]]]) -> tuple[np.ndarray, ...]:
    """Runs of equal lengths within a pattern, sorted by (length, first rank that they take)."""
    taken: Counter = Counter()
    runs = []
    base = 0
    for times, lengths in patterns:
        offset = 0
        for length, each in Counter(lengths).items():
            runs.append((length, taken[length], base, offset, each))
            taken[length] += times * each
            offset += length * each
        base += times
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    return tuple(table.T)


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id, piece, length`` (1 to ``capacity``).

    ``pieces`` is read twice and should be landed. Sequences are gapless from offset 0 and hold at most
    ``capacity``; ids run from 0. Repeated pieces are placed each for itself; an empty table stays empty.
    A length that holds much of the data is ranked in ``salts`` parts, whose counts (at most ``capacity``
    times ``salts`` rows) give each part's first rank.
    """
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    lengths, firsts, bases, offsets, eachs = _places(packing_plan(histogram, capacity))
    keys = (lengths << 48) | firsts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            run = np.searchsorted(keys, (length << 48) | rank, side="right") - 1
            nth = rank - firsts[run]
            sequence = bases[run] + nth // eachs[run]
            offset = offsets[run] + nth % eachs[run] * length
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first_rank = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    columns = pieces.columns
    ranked = (
        salted.join(first_rank, ["length", "_salt"])
        .withColumn("_rank", F.col("_first") + F.row_number().over(within) - 1)
        .select(*columns, F.col("_rank").cast("bigint"))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack whole documents; the pieces are landed once, because packing reads them twice."""
    return pack(land(token_pieces(docs, tokenizer, capacity, keep_ids=keep_ids), "pieces"), capacity)


def default_tokenizer() -> str:
    """The public byte-level vocabulary installed on this machine and the executors'."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_best_fit_packing")
def _(spark, sf):
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    return pack_documents(documents(spark, sf), default_tokenizer())
