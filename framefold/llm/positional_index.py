"""A distributed positional inverted index of a corpus, and exact phrase and proximity search in it.

The index is a table of segments. A segment covers the documents of a few megabytes of text of one task and
holds, for each term, the sorted word positions at which the term stands in the segment, in one row; and one
row for each document with its first position. The index is written where the text is read: no posting is
shuffled to build it, and no term's list is longer than a segment.

A search cuts the test texts into windows of words. The index's directory (segment, term, occurrences) tells
which terms the corpus has and how often; a window with an unknown term is dropped, and the others are looked
up in the segments that hold their rarest term only. There their lists, shifted by the term's place in the
window, are intersected from the shortest to the longest until one is empty. Only lists of test terms travel,
co-grouped by segment with the windows asked there, in blocks of ``BLOCK_WINDOWS`` windows.

The set of test terms is broadcast while it has at most ``BROADCAST_TERMS`` terms (a few megabytes, counted
before); a larger one is joined by shuffling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query
from framefold.llm.words import ALPHANUMERIC, Words, pieces

WINDOW_WORDS = 10
#: Words within which all words of a window must stand, in any order, to be near.
NEAR_WORDS = 15
BROADCAST_TERMS = 200_000
BLOCK_WINDOWS = 200_000

INDEX = "segment string, term string, n bigint, positions binary, doc_no int, doc_id bigint, n_words bigint, first bigint"
MATCHES = "segment string, doc_no int, phrase string, near boolean, start bigint, length bigint"


def build_index(docs: DataFrame) -> DataFrame:
    """The index of every row of ``docs``; land it, as segments are named by the task that writes them.

    Rows with a ``term`` hold its occurrences ``n`` in the segment and their ``positions`` (little-endian unsigned
    32-bit, ascending); the others one document each: its number in the segment, ``doc_id``, number of words and
    ``first`` position. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null and empty texts are
    documents without words; repeated rows are documents of their own; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        schema = pa.schema(
            [("segment", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("positions", pa.binary())]
            + [("doc_no", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("first", pa.int64())]
        )
        for serial, batch in enumerate(pieces(batches, "text")):
            segment = f"{task}-{serial}"
            words = Words(batch.column("text"), ALPHANUMERIC, fold=True)
            codes, terms = words.encode()
            n = np.bincount(codes, minlength=len(terms))
            positions = np.argsort(codes, kind="stable").astype("<u4")
            bounds = np.concatenate(([0], np.cumsum(4 * n)))
            lists = pa.Array.from_buffers(
                pa.large_binary(), len(terms), [None, pa.py_buffer(bounds), pa.py_buffer(positions)]
            )
            for rows, columns in (
                (batch.num_rows, {
                    "doc_no": np.arange(batch.num_rows), "doc_id": batch.column("doc_id"),
                    "n_words": np.diff(words.first), "first": words.first[:-1],
                }),
                (len(terms), {"term": terms.cast(pa.large_string()), "n": n, "positions": lists}),
            ):
                columns["segment"] = [segment] * rows
                arrays = [
                    _column(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, INDEX)


def _column(values, kind: pa.DataType) -> pa.Array:
    return (values if isinstance(values, pa.Array) else pa.array(values)).cast(kind)


def windows(items: DataFrame, words: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, phrase``: each item's distinct windows of ``words`` words, joined by spaces.

    An item of fewer words, but not none, is one window. ``item_id`` is text, empty where it was null.
    """

    schema = pa.schema([("item_id", pa.string()), ("phrase", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            split = Words(batch.column("text"), ALPHANUMERIC, fold=True)
            codes, known = split.encode()
            terms = known.cast(pa.large_string()).to_pylist()
            for k, item in enumerate(batch.column("item_id").to_pylist()):
                own = [terms[c] for c in codes[split.first[k] : split.first[k + 1]]]
                phrases = dict.fromkeys(" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1)) if own)
                yield pa.RecordBatch.from_pydict({"item_id": [item] * len(phrases), "phrase": list(phrases)}, schema)

    keyed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return keyed.mapInArrow(run, "item_id string, phrase string").distinct()


def phrase_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Positions at which terms with these position lists follow one another, from the shortest list on."""
    starts = None
    for k in sorted(range(len(lists)), key=lambda k: len(lists[k])):
        if starts is None:
            starts = lists[k].astype(np.int64) - k
        else:
            starts = starts[_among(starts + k, lists[k])]
        if not len(starts):
            break
    return starts


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    found = at < len(ordered)
    found[found] = ordered[at[found]] == values[found]
    return found


def near_spans(lists: list[np.ndarray], span: int, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int, int]]:
    """For each occurrence of the rarest term the smallest stretch with all terms, as (occurrence, start, end).

    ``lists`` are those of different terms, the rarest first; stretches have at most ``span`` words and lie
    between ``low`` and ``high`` of the occurrence's document. Of several smallest the first counts. An occurrence
    without one is left out.
    """
    at = np.arange(len(lists[0]))
    centre = lists[0].astype(np.int64)
    for other in lists[1:]:
        right = np.searchsorted(other, np.maximum(centre - span + 1, low)[at])
        inside = right < len(other)
        inside[inside] = other[right[inside]] < np.minimum(centre + span, high)[at][inside]
        at = at[inside]
        if not len(at):
            return []
    found = []
    for k in at.tolist():
        c = int(centre[k])
        first, last = max(c - span + 1, int(low[k])), min(c + span, int(high[k]))
        close = [x[np.searchsorted(x, first) : np.searchsorted(x, last)].astype(np.int64) for x in lists]
        close[0] = np.array([c])
        ends = np.unique(np.concatenate(close))
        ends = ends[ends >= c]
        begin = np.full(len(ends), c)
        for x in close[1:]:
            before = np.searchsorted(x, ends, "right") - 1
            begin = np.minimum(begin, np.where(before >= 0, x[np.maximum(before, 0)], -(1 << 40)))
        best = int(np.argmin(ends - begin))
        if ends[best] - begin[best] < span:
            found.append((c, int(begin[best]), int(ends[best]) + 1))
    return found


def _matcher(near: int | None):
    """Searches one segment for the windows asked there."""

    def search(postings: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in MATCHES.split(", ")}
        columns = {c: postings.column(c).to_pylist() for c in ("term", "positions", "doc_no", "first", "n_words")}
        docs = sorted((f, f + n, d) for t, f, n, d in zip(*(columns[c] for c in ("term", "first", "n_words", "doc_no"))) if t is None and n)
        first, end, number = (np.array(x, np.int64) for x in zip(*docs)) if docs else (np.zeros(0, np.int64),) * 3
        lists = {t: np.frombuffer(p, "<u4") for t, p in zip(columns["term"], columns["positions"]) if t is not None}

        def add(phrase: str, is_near: bool, starts: np.ndarray, stops: np.ndarray) -> None:
            doc = np.searchsorted(first, starts, "right") - 1
            whole = stops <= end[doc]
            doc, starts, stops = doc[whole], starts[whole], stops[whole]
            out["doc_no"] += number[doc].tolist()
            out["start"] += (starts - first[doc]).tolist()
            out["length"] += (stops - starts).tolist()
            out["phrase"] += [phrase] * len(doc)
            out["near"] += [is_near] * len(doc)

        for phrase in asked.column("phrase").to_pylist():
            terms = phrase.split(" ")
            if any(t not in lists for t in terms):
                continue
            starts = phrase_starts([lists[t] for t in terms])
            starts = starts[starts >= 0]
            add(phrase, False, starts, starts + len(terms))
            if near is not None:
                distinct = sorted((lists[t] for t in dict.fromkeys(terms)), key=len)
                doc = np.searchsorted(first, distinct[0], "right") - 1
                spans = near_spans(distinct, near, first[doc], end[doc])
                if spans:
                    _, begin, stop = (np.array(x, np.int64) for x in zip(*dict.fromkeys((0, b, s) for _, b, s in spans)))
                    add(phrase, True, begin, stop)
        segments = asked.column("segment").to_pylist()
        out["segment"] = [segments[0] if segments else None] * len(out["start"])
        kinds = [pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return search


def search(index: DataFrame, asked: DataFrame, near: int | None = None, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``segment, doc_no, phrase, near, start, length`` of every match of the windows ``asked`` (column ``phrase``).

    Exact matches (``near`` false) are all places where the window's words follow one another in a document. With
    ``near``, also the smallest stretches of at most so many words that hold all different words of the window in any
    order, one for each occurrence of the window's rarest word in the segment, equal ones once. ``start`` counts words
    of the document from 0. ``index`` is a landed result of ``build_index``. No window or no document: no rows.
    """
    phrases = land(asked.select("phrase").distinct(), "windows")
    n_phrases = phrases.count()
    parts = phrases.select("phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term"))
    terms = land(parts.select("term").distinct(), "terms")
    if terms.count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)  # at most BROADCAST_TERMS rows
    directory = index.where(F.col("term").isNotNull()).select("segment", "term", "n").join(terms, "term", "left_semi")
    total = directory.groupBy("term").agg(F.sum("n").alias("total"))
    rarest = (
        parts.join(total, "term", "left")
        .groupBy("phrase")
        .agg(F.min_by("term", F.struct("total", "term")).alias("term"), F.count_if(F.col("total").isNull()).alias("unknown"))
        .where("unknown = 0")
        .select("phrase", "term")
    )
    blocks = max(1, -(-n_phrases // block))
    wanted = directory.join(rarest, "term").select(
        F.col("segment").alias("segment"), F.pmod(F.xxhash64("phrase"), F.lit(blocks)).cast("int").alias("block"), "phrase"
    )
    lists = index.where(F.col("term").isNotNull()).join(terms, "term", "left_semi")
    heads = index.where(F.col("term").isNull() & (F.col("n_words") > 0))
    columns = ["segment", "term", "positions", "doc_no", "first", "n_words"]
    postings = lists.select(*columns).unionByName(heads.select(*columns))
    postings = postings.select(
        F.col("segment").alias("of"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"), *columns[1:]
    )
    return postings.groupBy("of", "part").cogroup(wanted.groupBy("segment", "block")).applyInArrow(_matcher(near), MATCHES)


def contamination(index: DataFrame, matches: DataFrame, asked: DataFrame) -> DataFrame:
    """For each document: ``doc_id, n_words, n_hit, items, n_near, contaminated``.

    ``n_hit`` counts words inside exact matches, each once; ``items`` are the ids of the items with such a match, sorted
    as text; ``n_near`` the number of items with a near match. ``matches`` is a landed result of ``search`` and ``asked``
    the table of ``windows`` that was searched. Every row of the indexed table gives one row.
    """
    doc = ["segment", "doc_no"]
    exact = matches.where(~F.col("near")).withColumn("stop", F.col("start") + F.col("length"))
    earlier = Window.partitionBy(*doc).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.greatest("start", F.coalesce(F.max("stop").over(earlier), "start"))
    covered = exact.withColumn("fresh", F.greatest(F.col("stop") - begin, F.lit(0))).groupBy(*doc).agg(F.sum("fresh").alias("n_hit"))
    found = matches.join(asked, "phrase").groupBy(*doc, "near", "item_id").agg(F.lit(1).alias("one")).groupBy(*doc).agg(
        F.array_sort(F.collect_list(F.when(~F.col("near"), F.col("item_id")))).alias("items"),
        F.count_if("near").alias("n_near"),
    )
    return (
        index.where(F.col("term").isNull())
        .select(*doc, "doc_id", "n_words")
        .join(covered, doc, "left")
        .join(found, doc, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


@query("op13_benchmark_decontamination")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = land(build_index(documents(spark, sf_dir)), "index")
    asked = land(windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "asked")
    matches = land(search(index, asked, NEAR_WORDS), "matches")
    return contamination(index, matches, asked).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )
