"""Quality rules: word statistics of a document, and lines that recur across documents of a host.

Lines are normalised and hashed; a line found in more distinct documents of its host than
the limit allows is removed, and a document that loses too much of itself is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framefold.llm.common import documents, land, query

#: A line is frequent in more than this many distinct documents of a host ...
LINE_DOCUMENTS = 20
#: ... and in more than this share of the host's documents.
LINE_SHARE = 0.002
#: A document is depleted if fewer than this share of its words stays after frequent lines are removed.
KEPT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\r\x0b\x0c"
_WORD = re.compile("[^\x20\x09-\x0d]")

STATISTICS = (
    "doc_id bigint, text_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    total = 0
    covered = 0  # up to this word all are settled
    for at, window in enumerate(windows):
        if seen[window] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def word_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; null counts as empty."""
    data = (text or "").encode()
    words = data.split()  # bytes split at ASCII white space only
    chars = len(data.translate(None, _SPACES.encode()).decode())
    symbols = sum(map(data.count, (s.encode() for s in SYMBOLS)))
    lines = [line for line in (text or "").split("\n") if _WORD.search(line)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _host_key(host: str) -> Column:
    """A null host is one host of its own."""
    return F.xxhash64(F.col(host).isNull(), F.col(host).cast("string"))


def text_statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """The word statistics of every row; ``text_key`` names its host and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [word_statistics(t.as_py()) for t in batch.column(2)]
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], names=[c.split()[0] for c in STATISTICS.split(", ")]
            )

    return docs.select(
        F.col("doc_id").cast("bigint"), F.xxhash64(_host_key(host), "text").alias("text_key"), "text"
    ).mapInArrow(run, STATISTICS)


def _normalised(line: Column) -> Column:
    """Lower case, each run of digits as one 0, white space as single blanks."""
    digits = F.regexp_replace(F.lower(line), "[0-9]+", "0")
    return F.trim(F.regexp_replace(digits, "[\\x20\\x09-\\x0D]+", " "))


def host_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """``host, line, text_key, words``: every line with a word; ``line`` hashes the host and the normalised line."""
    each = docs.select(
        _host_key(host).alias("host"),
        F.xxhash64(_host_key(host), "text").alias("text_key"),
        F.explode(F.split("text", "\n")).alias("text_line"),
    )
    words = F.size(F.filter(F.split("text_line", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    return each.select(
        "host", F.xxhash64("host", _normalised(F.col("text_line"))).alias("line"), "text_key", words.alias("words")
    ).where("words > 0")


def frequent_lines(
    docs: DataFrame, host: str = "source", documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE
) -> DataFrame:
    """``line``: hashes of the lines in more than ``documents`` distinct documents of a host and in more
    than ``share`` of them. Documents with equal texts are one document here, so copies alone make no line frequent.
    """
    texts = host_lines(docs, host).select("host", "line", "text_key").distinct()
    counts = texts.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > documents)
    sizes = (
        docs.select(_host_key(host).alias("host"), F.xxhash64(_host_key(host), "text").alias("text_key"))
        .distinct()
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    return counts.join(sizes, "host").where(F.col("n") > F.col("size") * share).select("line")


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    documents: int = LINE_DOCUMENTS,
    share: float = LINE_SHARE,
    kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """Every row's word statistics, ``lost_words`` (words of its frequent lines), ``base_failed`` and ``kept``.

    A document fails the base if it has under 50 words or over half of them in repeated windows; it is
    depleted if less than ``kept_share`` of its words stays without its frequent lines. A null text has no
    words, so it fails; repeated rows get equal results; other columns than ``doc_id``, ``text`` and
    ``host`` are not read.
    """
    rows = land(text_statistics(docs, host), "statistics")
    frequent = land(frequent_lines(docs, host, documents, share), "frequent-lines")
    lost = (
        host_lines(docs, host)
        .join(frequent, "line")
        .groupBy("text_key")
        .agg(F.sum("words").alias("all_lost"))
        .join(rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("rows")), "text_key")
        # Equal texts of a host are exploded once for each row and lose the same.
        .select("text_key", F.expr("all_lost div rows").alias("lost_words"))
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stays = F.col("n_words") - F.col("lost_words") >= kept_share * F.col("n_words")
    return (
        rows.join(lost, "text_key", "left")
        .withColumn("lost_words", F.coalesce("lost_words", F.lit(0).cast("bigint")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & stays)
    )


def without_lines(docs: DataFrame, frequent: DataFrame, host: str = "source") -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``; all else stays, a null text stays null.

    ``frequent`` is one row per line, often few but without a bound, so it is joined with the exploded lines
    and only the texts that hold one are rebuilt, by line number.
    """
    keyed = docs.withColumn("_key", F.xxhash64(_host_key(host), "text"))
    each = keyed.select(_host_key(host).alias("_host"), "_key", F.posexplode(F.split("text", "\n")).alias("_at", "_line"))
    hit = (
        each.withColumn("line", F.xxhash64("_host", _normalised(F.col("_line"))))
        .join(frequent, "line")
        .select("_key", "_at")
        .distinct()
        .groupBy("_key")
        .agg(F.collect_list("_at").alias("_gone"))
    )
    lines = F.split("text", "\n")
    rest = F.filter(lines, lambda _, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    return keyed.join(hit, "_key", "left").withColumn("text", text).select(*docs.columns)


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SQL = f"""
WITH d AS (SELECT doc_id, source, text, {_WORDS} AS ws FROM documents),
 s AS (SELECT doc_id, source, text, len(ws) AS n_words, length(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols FROM d),
 win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c
         FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
 rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
         FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win WHERE c > 1) GROUP BY doc_id),
 raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM documents),
 lines AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words,
            trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS norm
            FROM raw),
 worded AS (SELECT * FROM lines WHERE words > 0),
 dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
 size AS (SELECT source, count(DISTINCT coalesce(text, chr(0))) AS size FROM documents GROUP BY source),
 freq AS (SELECT w.source, norm FROM worded w JOIN size z ON w.source IS NOT DISTINCT FROM z.source GROUP BY w.source, norm, z.size
          HAVING count(DISTINCT text) > {LINE_DOCUMENTS} AND count(DISTINCT text) > z.size * {LINE_SHARE}),
 lost AS (SELECT doc_id, sum(words) AS lost FROM worded w JOIN freq f ON w.source IS NOT DISTINCT FROM f.source AND w.norm = f.norm
          GROUP BY doc_id),
 a AS (SELECT s.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
        FROM s LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - lost >= {KEPT_SHARE} * n_words AS kept
FROM a"""


@query("op3_line_frequency_rules", SQL)
def _(spark, sf):
    """Word statistics of every document and whether it stays under the base and the line rule."""
    return quality_rules(documents(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
